from __future__ import annotations

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlab.operators import features
from flowlab.plans.catalog import cleaned

NAN = float("nan")


def test_missing_label_is_an_attack(spark):
    rows = spark.createDataFrame([("BENIGN",), ("X",), (None,)], "label string")
    assert [r["label"] for r in features.binary_target(rows).collect()] == [0.0, 1.0, 1.0]


def test_derived_features_need_their_inputs(spark):
    rows = spark.createDataFrame([(1.0, 5.0)], "duration double, fwd_packets_count double")
    assert features.add_derived(rows).columns == ["duration", "fwd_packets_count", "log_duration"]


def test_derived_rules(spark):
    shape = "fwd_packets_count double, bwd_packets_count double, fwd_total_payload_bytes double, bwd_total_payload_bytes double, total_payload_bytes double, duration double"
    rows = spark.createDataFrame(
        [(4.0, 2.0, 10.0, 2.0, 999.0, 1.0), (0.0, 0.0, 1.0, 1.0, 999.0, -1.0), (1.0, None, None, 1.0, 999.0, NAN)], shape
    )
    full, zero, null = features.add_derived(rows).collect()
    assert full["total_packets"] == 6.0 and full["total_payload_bytes"] == 12.0
    assert full["avg_payload_per_packet"] == 2.0 and full["fwd_bwd_packet_ratio"] == 2.0
    assert full["log_duration"] == pytest.approx(math.log(2))
    assert zero["avg_payload_per_packet"] == 0.0 and zero["fwd_bwd_packet_ratio"] == 0.0 and zero["log_duration"] == 0.0
    assert null["total_packets"] is None and null["total_payload_bytes"] is None
    assert null["avg_payload_per_packet"] == 0.0 and math.isnan(null["log_duration"])


def test_no_numeric_column_is_an_error(spark):
    with pytest.raises(ValueError, match="numeric"):
        features.numeric_columns(spark.createDataFrame([("a", 1.0)], "x string, label double"))


def test_sketch_error_must_stay_below_the_quantile(spark):
    with pytest.raises(ValueError, match="rel_error"):
        features.fit_caps(spark.range(10), ["id"], rel_error=0.01)


def test_caps_cut_and_skip_constant_and_empty_columns(spark):
    rows = spark.range(1000).select(
        F.col("id").cast("double").alias("x"), F.lit(1.0).alias("same"), F.lit(None).cast("double").alias("none")
    )
    for exact in (False, True):
        caps = features.fit_caps(rows, ["x", "same", "none"], exact=exact)
        assert list(caps) == ["x"]
        assert caps["x"] == pytest.approx((9, 989), abs=0 if exact else 3)


def test_capping_twice_changes_nothing_and_keeps_nulls(spark):
    rows = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 3.0, 99.0, None)], "x double")
    once = features.apply_caps(rows, {"x": (0.0, 10.0)})
    assert [r[0] for r in once.collect()] == [0.0, 0.0, 3.0, 10.0, None]
    assert features.apply_caps(once, {"x": (0.0, 10.0)}).collect() == once.collect()


def test_nan_is_missing_and_not_the_upper_bound(spark):
    rows = spark.createDataFrame([(float(i), "BENIGN") for i in range(200)] + [(NAN, "BENIGN")], "x double, label string")
    table = features.feature_table(rows, exact=True)
    assert table.filter("x = 0.0").count() == 1  # the NaN; small values are capped at 1.0
    assert table.agg(F.min("x"), F.max("x"), F.count_if(F.isnan("x"))).first() == (0.0, 197.0, 0)


def test_bounds_can_come_from_the_training_rows(spark, sf_dir):
    rows = features.engineered(cleaned(spark, sf_dir))
    caps = features.fit_caps(rows.filter("duration < 20"), ["duration"], exact=True)
    assert features.feature_table(cleaned(spark, sf_dir), caps).agg(F.max("duration")).first()[0] == 19.0


def test_assembled_vector_holds_the_columns(spark, sf_dir):
    table = features.feature_table(cleaned(spark, sf_dir))
    names = features.numeric_columns(table)
    ready = features.assemble(table)
    assert ready.columns == ["flow_id", "features", "label", "label_original"]
    back = ready.select("flow_id", *(vector_to_array("features")[i].alias(n) for i, n in enumerate(names)))
    assert back.exceptAll(table.select("flow_id", *names)).isEmpty()


def test_constant_columns_are_named(spark):
    rows = spark.range(3).select("id", F.lit(2.0).alias("same"))
    assert features.constant_columns(rows, ["id", "same"]) == ["same"]
