from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowlab.functions.keys import in_percent
from flowlab.operators import profile
from flowlab.plans.inputs import flows

NAN = float("nan")


@pytest.fixture
def odd(spark):
    """Constant, all-NULL, NaN and ordinary columns."""
    rows = [("a", 1.0, None, NAN, float(i)) for i in range(4)] + [("b", 1.0, None, 2.0, 10.0), (None, 1.0, None, 3.0, -5.0)]
    return spark.createDataFrame(rows, "label string, same double, none double, some double, x double")


def test_ranges_leave_out_nan_and_empty_columns(odd):
    assert profile.fit_ranges(odd, ["same", "none", "some", "x"]) == {
        "same": (1.0, 1.0),
        "some": (2.0, 3.0),
        "x": (-5.0, 10.0),
    }


def test_minmax_of_constant_and_empty_columns_is_zero(odd):
    rows = profile.minmax_scaled(odd, ["same", "none", "x"]).collect()
    assert {r["same"] for r in rows} == {0.0} and {r["none"] for r in rows} == {0.0}
    assert min(r["x"] for r in rows) == 0.0 and max(r["x"] for r in rows) == 1.0


def test_class_means_equal_means_of_scaled_rows(odd):
    names = ["same", "some", "x"]
    direct = profile.minmax_scaled(odd, names).groupBy("label").avg(*names)
    expected = {r[0]: list(r[1:]) for r in direct.collect()}
    for label, *means in profile.minmax_class_means(odd, "label", names).collect():
        for got, want in zip(means, expected[label], strict=True):
            assert (got is None and want is None) or got == pytest.approx(want or 0.0, abs=1e-6)


def test_histogram_counts_every_positive_value_once(odd):
    counts = profile.log_histogram(odd, ["same", "none", "some", "x"], bins=5)
    totals = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg({"count": "sum"}).toDF("feature", "n").collect()}
    assert totals == {"same": 6, "some": 2, "x": 4}
    assert counts.filter("feature = 'same' AND count > 0").first()["bin"] == 2
    assert counts.filter("feature = 'x'").count() == 5


def test_histogram_without_positive_values(spark):
    assert profile.log_histogram(spark.createDataFrame([(-1.0,), (None,)], "x double"), ["x"]).count() == 0


def test_profile_in_several_column_groups(spark, monkeypatch, odd):
    whole = sorted(profile.null_profile(odd, odd.columns).collect())
    monkeypatch.setattr(profile, "STATISTICS_PER_SCAN", 2)
    assert sorted(profile.null_profile(odd, odd.columns).collect()) == whole
    assert [tuple(r) for r in profile.null_profile(odd, odd.columns, top=1).collect()] == [("none", 6)]


def test_describe_of_empty_column(odd):
    stats = {r["stat"]: r["value"] for r in profile.describe_long(odd, ["none"]).collect()}
    assert stats == {"count": 0.0, "mean": None, "stddev": None, "min": None, "max": None}


def test_describe_of_empty_table(odd):
    assert profile.describe_long(odd.limit(0), ["x"]).filter("stat = 'count'").first()["value"] == 0.0


def test_shares_add_up(odd):
    rows = profile.class_share(odd, "label").collect()
    assert math.isclose(sum(r["percent"] for r in rows), 100, abs_tol=0.02)
    assert {r["label"] for r in profile.class_share(odd, "label", without="A").collect()} == {"b"}


def test_published_shares(spark):
    counts = spark.createDataFrame([("BENIGN", 133770), ("ATTACK", 651813)], "label string, n int")
    rows = counts.selectExpr("label", "explode(sequence(1, n))")
    assert {r["label"]: r["percent"] for r in profile.class_share(rows, "label").collect()} == {
        "BENIGN": 17.03,
        "ATTACK": 82.97,
    }


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_hash_choice_ignores_the_layout(spark, sf_dir, partitions):
    rows = flows(spark, sf_dir)
    chosen = profile.hash_sample(rows.repartition(partitions), "flow_id", 10)
    assert chosen.exceptAll(profile.hash_sample(rows, "flow_id", 10)).isEmpty()
    assert rows.repartition(partitions).filter(in_percent("flow_id", 80)).count() == 4812


def test_infinities_are_counted_and_in_no_range(spark):
    values = [1.0, 3.0, 5.0, float("inf"), float("-inf"), float("nan"), None]
    rows = spark.createDataFrame([(v, "a") for v in values], "x double, label string")
    assert profile.fit_ranges(rows, ["x"]) == {"x": (1.0, 5.0)}
    assert [tuple(r) for r in profile.infinite_counts(rows, ["x"]).collect()] == [("x", 2)]
    scaled = [r.x for r in profile.minmax_scaled(rows, ["x"]).collect()]
    assert scaled == [0.0, 0.5, 1.0, None, None, None, None]
    assert profile.minmax_class_means(rows, "label", ["x"]).first().x == 0.5
    bins = {r.bin: r["count"] for r in profile.log_histogram(rows, ["x"], bins=2).collect()}
    assert bins == {0: 1, 1: 2}


def test_null_profile_leaves_no_column_out(spark):
    rows = spark.range(2).select(*(F.lit(None).cast("int").alias(f"c{i}") for i in range(40)))
    assert profile.null_profile(rows, rows.columns).count() == 40


def test_reconciled_rules_equal_reconciled_tables(spark):
    rows = spark.range(100)
    rules = [("all", F.lit(True)), ("some", F.col("id") > 9), ("few", F.col("id") > 95)]
    tables = [(name, rows.filter(rule)) for name, rule in rules]
    assert sorted(profile.reconcile_rules(rows, rules).collect()) == sorted(profile.reconcile(tables).collect())


def test_reconcile_of_an_empty_first_stage(spark):
    rows = profile.reconcile([("raw", spark.range(0)), ("cleaned", spark.range(0))]).orderBy("position").collect()
    assert [(r["rows"], r["removed"], r["removed_percent"]) for r in rows] == [(0, None, None), (0, 0, None)]
