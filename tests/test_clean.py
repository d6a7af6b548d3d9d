from __future__ import annotations

import re

import math

import pytest
from pyspark.sql import functions as F

from flowlab.functions.values import number
from flowlab.operators import clean
from flowlab.plans.inputs import flows

TEXTS = ["1.5", "Infinity", "-Infinity", "inf", "-inf", "INF", "NaN", "abc", "", None, "-3"]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "x string")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sentinels_and_bad_text_become_null(spark, texts, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = [r[0] for r in texts.select(number("x")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert values[0] == 1.5 and values[-1] == -3.0
    assert values[1:5] == [None] * 4
    assert math.isinf(values[5]) and math.isnan(values[6])
    assert values[7:10] == [None] * 3


def test_strict_nulls_every_spelling(texts):
    assert [r[0] for r in texts.select(number("x", strict=True)).collect()] == [1.5] + [None] * 9 + [-3.0]


def test_cast_failures_counts_only_bad_text(texts):
    assert [tuple(r) for r in clean.cast_failures(texts.withColumn("label", F.lit("a"))).collect()] == [("x", 2)]


def test_null_rows_go_by_default_and_stay_on_request(spark):
    rows = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (None, -1.0), (-1.0, 1.0), (float("nan"), 0.0)], "duration double, bytes_rate double"
    )
    assert clean.drop_impossible(rows).count() == 2
    assert clean.drop_impossible(rows, keep_nulls=True).count() == 3
    assert clean.drop_impossible(rows.select(F.col("duration").alias("other"))).count() == 5


def test_negative_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "typed")
    spark.range(10).select(F.col("id").cast("double").alias("duration"), F.lit("a").alias("label")).write.parquet(path)
    plan = clean.drop_impossible(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(duration,0.0)" in plan


def test_labels(spark):
    rows = spark.createDataFrame([(" Benign ",), ("web_xss",), ("My Web App",), (None,), ("DoS_Hulk",)], "label string")
    assert [r[0] for r in clean.standardise_labels(rows).collect()] == [
        "BENIGN",
        "WEB_ATTACK",
        "WEB_ATTACK",
        None,
        "DOS_HULK",
    ]


def test_cleaning_cleaned_rows_changes_nothing(spark, sf_dir):
    once = clean.clean_flows(flows(spark, sf_dir))
    twice = clean.clean_flows(once)
    assert twice.schema == once.schema
    assert twice.exceptAll(once).isEmpty() and twice.count() == once.count()


def test_identifiers_stay_text_unless_told_otherwise(spark, sf_dir):
    rows = flows(spark, sf_dir)
    assert dict(clean.cast_measures(rows).dtypes)["flow_id"] == "string"
    as_numbers = clean.cast_measures(rows, ids=())
    assert dict(as_numbers.dtypes)["flow_id"] == "double"
    assert as_numbers.filter("flow_id IS NOT NULL").isEmpty()


@pytest.mark.parametrize("slots", [1, 3, 2**20])
def test_dedup_equals_distinct(spark, monkeypatch, slots):
    """With a slot for every repeated digest, and with slots so few that all are marked."""
    monkeypatch.setattr(clean, "SLOTS", slots)
    nan = float("nan")
    unique = [(i, float(i), None if i % 3 else "x") for i in range(200)]
    hot = [(7, nan, None)] * 150
    swapped = [(None, 1.0, "x"), (1, None, "x"), (None, None, None), (None, None, None), (1, 0.0, "z"), (1, -0.0, "z")]
    rows = spark.createDataFrame(unique + hot + swapped + unique[:20], "a int, b double, c string").repartition(5)

    def key(r):
        return tuple(str(v) for v in r)

    found = sorted(map(key, clean.drop_duplicate_rows(rows).collect()))
    expected = sorted(map(key, rows.distinct().collect()))
    assert len(found) == len(expected) == 200 + 1 + 3 + 1
    assert {k for k in found if "0.0" not in k} == {k for k in expected if "0.0" not in k}


@pytest.mark.parametrize("repeated", [0, 20, 2000])
def test_dedup_has_one_plan(spark, repeated):
    rows = spark.range(20_000).unionByName(spark.range(repeated)).withColumn("x", F.col("id") * 2)
    found = clean.drop_duplicate_rows(rows)
    plan = re.sub(r"#\d+L?|\[[^]]*\]|flowlab-\w+|\d+", "", found._jdf.queryExecution().optimizedPlan().toString())
    assert found.count() == rows.distinct().count() == 20_000
    assert plan == PLANS.setdefault("dedup", plan)


PLANS: dict[str, str] = {}


def test_dedup_of_nothing(spark):
    assert clean.drop_duplicate_rows(spark.createDataFrame([], "a int, b string")).count() == 0


def test_clean_with_dedup_drops_the_second_load(spark, sf_dir):
    rows = flows(spark, sf_dir)
    twice = rows.unionByName(rows)
    assert clean.clean_flows(twice, deduplicate=True).count() == clean.clean_flows(rows).count()
