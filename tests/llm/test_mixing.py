import hashlib
import re

import pytest

from flowlab.llm import mixing
from tests.llm.edge import CLASHES, ROWS, edge_docs, no_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_rounds(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """Shares, cuts and reshares until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total >= most * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in free}
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= above
    return target


def draw(doc_id) -> float:
    text = f"42:{'' if doc_id is None else doc_id}"
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def expected(rows) -> list[tuple]:
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sizes: dict = {}
    for r, n in zip(rows, size, strict=True):
        sizes[r[3]] = sizes.get(r[3], 0) + n
    target = targets_by_rounds(sizes)
    out = []
    for r, n in zip(rows, size, strict=True):
        total = sizes[r[3]]
        rate = target[r[3]] / total if total else 0.0
        out.append((r[0], n, total, target[r[3]], int(rate) + (draw(r[0]) < rate - int(rate))))
    return out


def test_edges_equal_rounds(spark):
    found = mixing.plan(edge_docs(spark)).select("doc_id", "size", "source_size", "target", "copies").collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[4])
    for a, e in zip(sorted(map(tuple, found), key=key), sorted(expected(ROWS), key=key), strict=True):
        assert a[:3] == e[:3] and a[4] == e[4]
        assert a[3] == pytest.approx(e[3], rel=1e-12)


@pytest.mark.parametrize("sizes", [[5, 1000, 3, 3, 3, 70], [0, 0], [10], [1, 1, 1, 10**6], [0, 5, 0, 9]])
def test_targets(spark, sizes):
    by = {f"s{i}": n for i, n in enumerate(sizes)}
    rows = spark.createDataFrame(list(by.items()), "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert found == pytest.approx(targets_by_rounds(by))
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes))


def test_mix_repeats_rows_with_their_columns(spark):
    docs = edge_docs(spark)
    rows = mixing.mix(docs).collect()
    assert rows[0].asDict().keys() == set(docs.columns)
    assert all(r[c] == f"other {c}" for r in rows for c in CLASHES)
    counts: dict = {}
    for r in rows:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    wanted: dict = {}
    for doc_id, *_, copies in expected(ROWS):
        wanted[doc_id] = wanted.get(doc_id, 0) + copies
    assert counts == {k: n for k, n in wanted.items() if n}


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', int(id % 50)) AS text", "concat('s', id % 4) AS source")
    found = mixing.plan(docs).groupBy("source").agg({"target": "max", "size": "max"})
    taken = {r[0]: r[1] for r in mixing.plan(docs).selectExpr("source", "size * copies AS t").groupBy("source").sum("t").collect()}
    for r in found.collect():
        assert taken[r.source] == pytest.approx(r["max(target)"], rel=0.1)


def test_same_mix_whatever_the_layout(spark):
    docs = edge_docs(spark)
    one, other = (mixing.mix(d).select("doc_id", "text").collect() for d in (docs, docs.repartition(7)))
    assert sorted(map(str, one)) == sorted(map(str, other))


def test_empty(spark):
    assert mixing.plan(no_docs(spark)).collect() == mixing.mix(no_docs(spark)).collect() == []
