from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.operators import quantiles, ranking, sketches
from flowlab.operators.quantiles import exact_quantiles

P = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def by_brute_force(values, p):
    kept = sorted(v for v in values if v is not None and v == v)
    return kept[max(1, int(np.ceil(round(p * len(kept), 9)))) - 1]


def columns():
    pick = random.Random(5)
    n = 3000
    return {
        "even": [pick.random() for _ in range(n)],
        "hot": [0.0 if pick.random() < 0.6 else pick.gauss(0, 1e6) for _ in range(n)],
        "gaps": [pick.choice([None, float("nan"), float(pick.randrange(50))]) for _ in range(n)],
        "tail": [10 ** (12 * pick.random()) for _ in range(n)],
        "few": [float(i) if i < 3 else None for i in range(n)],
    }


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_equals_brute_force_on_any_layout(spark, partitions):
    data = columns()
    rows = spark.createDataFrame(list(zip(*data.values(), strict=True)), ", ".join(f"{c} double" for c in data))
    found = {(r[0], r[1]): r[2] for r in exact_quantiles(rows.repartition(partitions), list(data), P).collect()}
    assert found == {(c, p): by_brute_force(v, p) for c, v in data.items() for p in P}


def test_holds_when_the_sketch_is_wrong(spark, monkeypatch):
    """A bracket that misses the rank is noticed by the count and replaced by the whole range."""
    rows = spark.range(500).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(quantiles, "sketched_quantiles", lambda df, cols, ps: {"x": [400.0] * len(ps)})
    found = {r[1]: r[2] for r in exact_quantiles(rows, ["x"], [0.1, 0.9]).collect()}
    assert found == {0.1: 49.0, 0.9: 449.0}


@pytest.mark.parametrize("partitions", [1, 40])
def test_default_bounds_stay_inside_the_error(spark, monkeypatch, partitions):
    """Sketches merged in several steps; ranks checked against the sorted values."""
    monkeypatch.setattr(sketches, "FAN_IN", 3)
    rows = spark.range(200_000).select(F.pow(F.rand(7), F.lit(3)).alias("x"), (F.col("id") % 5).alias("few"))
    rows = rows.repartition(partitions)
    values = {c: np.sort([float(r[0]) for r in rows.select(c).collect()]) for c in rows.columns}
    for column, found in quantiles.approximate_quantiles(rows, rows.columns, [0.01, 0.5, 0.99], 0.002).items():
        for p, v in zip([0.01, 0.5, 0.99], found, strict=True):
            low, high = (np.searchsorted(values[column], v, side) / len(values[column]) for side in ("left", "right"))
            assert low <= p + 0.002 and high >= p - 0.002


def test_empty_table_and_empty_column(spark):
    rows = spark.createDataFrame([(None, 1.0)], "none double, x double")
    assert [tuple(r) for r in exact_quantiles(rows, ["none", "x"], [0.5]).collect()] == [("x", 0.5, 1.0)]
    assert exact_quantiles(rows.limit(0), ["none", "x"], [0.5]).isEmpty()


def test_column_groups_do_not_change_the_result(spark, monkeypatch):
    rows = spark.range(300).select(*((F.col("id") * i).cast("double").alias(f"c{i}") for i in range(1, 6)))
    names = rows.columns
    whole = sorted(exact_quantiles(rows, names, [0.1, 0.9]).collect())
    monkeypatch.setattr(quantiles, "BRACKETS_PER_SCAN", 3)
    assert sorted(exact_quantiles(rows, names, [0.1, 0.9]).collect()) == whole


@pytest.mark.parametrize("cuts", [[], [5.0], [-1.0, 3.0, 3.5, 400.0], [float(i) for i in range(40)]])
@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_for_any_cut_points(spark, cuts, descending):
    pick = random.Random(3)
    data = [(g, float(v), pick.randrange(5)) for g in "ab" for v in pick.sample(range(60), 30)]
    rows = spark.createDataFrame(data, "g string, v double, w bigint").repartition(3)
    found = ranking.running_totals(rows, ["g"], "v", ["w"], cuts, descending, peek=["w"]).collect()
    assert len(found) == len(data)
    for g in "ab":
        mine = sorted((r for r in found if r["g"] == g), key=lambda r: r["v"], reverse=descending)
        weights = [r["w"] for r in mine]
        assert [r["w_so_far"] for r in mine] == list(np.cumsum(weights))
        assert [r["w_next"] for r in mine] == weights[1:] + [None]


def test_cut_points_are_balanced_and_deduplicated(spark):
    rows = spark.range(10000).select(F.when(F.col("id") < 4000, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    cuts = ranking.cut_points(rows, "v", 10)
    assert cuts == sorted(set(cuts)) and len(cuts) <= 9
    sizes = ranking.with_bucket(rows.filter("v > 0"), "v", cuts).groupBy(ranking.BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 1500


def test_errors_beyond_sketches_are_kept_by_exact_quantiles(spark):
    assert sketches.SIZE < sketches.size_for(0.001) <= sketches.LARGEST
    assert sketches.size_for(1e-4) is None and sketches.size_for(0) is None and sketches.size_for(1e-9) is None
    rows = spark.range(50_000).select(
        (F.col("id") * 7919 % 50_000).cast("double").alias("x"), F.lit(None).cast("double").alias("nothing")
    )
    wanted = {r.probability: r.value for r in exact_quantiles(rows, ["x"], [0.01, 0.5, 0.99]).collect()}
    for error in (1e-4, 1e-5, 0):
        found = quantiles.approximate_quantiles(rows, ["x", "nothing"], [0.01, 0.5, 0.99], error)
        assert found == {"x": [wanted[0.01], wanted[0.5], wanted[0.99]], "nothing": []}
