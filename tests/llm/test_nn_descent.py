import numpy as np
import pytest

from flowlab.llm import nn_descent
from flowlab.sources.storage import durable

SCHEMA = "vec_id bigint, embedding array<float>, id string, vector string, n_links string, component string"


def brute(rows, threshold=0.9):
    """(id, links, smallest id reachable) by all pairs."""
    def usable(i, v):
        return i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)

    good = [k for k, (i, v) in enumerate(rows) if usable(i, v)]
    near = {k: [] for k in range(len(rows))}
    for a in good:
        for b in good:
            x, y = (np.array(rows[k][1], np.float64) for k in (a, b))
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                near[a].append(b)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        out.append((i, len(near[k]), min(ids, default=None)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def made(seed: int, clusters: list[int], alone: int, dim: int = 24) -> list:
    r = np.random.default_rng(seed)
    rows = []
    for size in clusters:
        centre = r.standard_normal(dim)
        rows += [centre + 0.25 * r.standard_normal(dim) for _ in range(size)]
    rows += list(r.standard_normal((alone, dim)))
    r.shuffle(rows)
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [5.0, 0.1]), (4, [0.0, 0.0]), (5, None), (6, []),
        (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 0.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]),
        (11, [2.0, 0.0, 0.0]), (12, [-1.0, 0.0]), (13, [1e-30, 0.0]), (14, [3e38, 0.0]), (15, [0.0, 1.0]),
    ]
    found = nn_descent.near_duplicates(frame(spark, rows)).collect()
    got = [(r.id, r.n_links, r.component_id) for r in found]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert all(r.kept == (None if r.id is None else r.id == r.component_id) for r in found)


def test_recall_against_all_pairs(spark):
    """Pairs, and groups larger than a list, a sample and a run."""
    rows = made(3, [2] * 60 + [5] * 10 + [40, 300], 900)
    settings = nn_descent.Settings(run=64)
    found = {r.id: r for r in nn_descent.near_duplicates(frame(spark, rows), settings=settings).collect()}
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    true = (units @ units.T >= 0.9).sum(axis=1) - 1
    links = np.array([found[i].n_links for i in range(len(rows))])
    assert (links <= true).all()
    assert links.sum() >= 0.98 * true.sum()
    assert np.mean(links[true > 0] / true[true > 0]) >= 0.95
    assert found[0].recall >= 0.9


def test_lists_are_enlarged_only_when_saturated(spark):
    pairs = [("a", f"x{i}", 0.95) for i in range(30)] + [("b", f"x{i}", 0.5 - i / 100) for i in range(30)]
    rows = spark.createDataFrame(pairs, "a string, b string, cosine double")
    found = nn_descent.lists(rows, nn_descent.Settings()).groupBy("a").count().collect()
    assert {r.a: r["count"] for r in found} == {"a": 30, "b": 10}


def test_reruns_agree(spark):
    rows = made(5, [3] * 20 + [30], 100)
    one, other = (
        sorted(map(tuple, nn_descent.near_duplicates(frame(spark, rows).repartition(n)).collect())) for n in (1, 3)
    )
    assert [r[:4] for r in one] == [r[:4] for r in other]


def test_unit_rows_do_not_overflow():
    rows = nn_descent.unit_rows(np.array([1e300, 1e300, 1e-300, 0.0]), 2)
    assert rows == pytest.approx(np.array([[0.5**0.5, 0.5**0.5], [1.0, 0.0]]))


def test_empty(spark):
    assert nn_descent.near_duplicates(frame(spark, [(1, [1.0])]).filter("false")).collect() == []


def test_audit_goes_on_until_links_were_seen(spark):
    """Two linked vectors among 600: a sample of 10 sees no link, and none is no recall of 1."""
    r = np.random.default_rng(8)
    alone = r.standard_normal((600, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*alone, alone[0] * 1.01 + 0.01])]
    settings = nn_descent.Settings(audited=10)
    points = durable(nn_descent.classes(frame(spark, rows), "vec_id", "embedding"), "points")
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert nn_descent.audit(points, none, settings) == 0.0
    assert nn_descent.audit(points, spark.createDataFrame([(0, 600), (600, 0)], "a bigint, b bigint"), settings) == 1.0
    assert nn_descent.audit(points.filter("id < 600"), none, settings) is None
    found = nn_descent.near_duplicates(frame(spark, rows[:600]), settings=settings)
    assert found.filter("recall IS NULL AND n_links = 0").count() == 600


def test_below_the_floor_all_are_compared(spark):
    """One attempt that finds a small part of a large group's links is not the result."""
    rows = made(11, [250], 150)
    settings = nn_descent.Settings(audited=50, audited_linked=10, audits=1, rounds=1, orders=1, run=8, saturated_sample=4)
    found = {r.id: r for r in nn_descent.near_duplicates(frame(spark, rows), settings=settings).collect()}
    assert [found[i].n_links for i, _ in rows] == [n for _, n, _ in brute(rows)]
    assert found[0].recall == 1.0


def test_samples_grow_with_saturated_lists(spark):
    """Around a vector with 400 links about 40 are compared, in tiles that together hold all their pairs."""
    r = np.random.default_rng(12)
    centre = r.standard_normal(24)
    rows = [(i, [float(x) for x in centre + 0.05 * r.standard_normal(24)]) for i in range(401)]
    points = durable(nn_descent.classes(frame(spark, rows), "vec_id", "embedding"), "points")
    star = spark.range(1, 401).selectExpr("0L AS a", "id AS b", "0.95D AS cosine", "cast(id AS int) AS place")
    for tile in (512, 16):
        settings = nn_descent.Settings(saturated_sample=4, tile=tile)
        pairs = {(p.a, p.b) for p in nn_descent.refine(points, star, 1, settings).collect() if 0 not in (p.a, p.b)}
        members = {a for a, _ in pairs}
        assert 25 <= len(members) <= 60
        assert len(pairs) == len(members) * (len(members) - 1)
    assert nn_descent.refine(points, star, 1, settings, 1).select("a").distinct().count() > 60
