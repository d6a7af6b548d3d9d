from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.operators import quality
from flowlab.plans import stages
from flowlab.plans.inputs import flows
from flowlab.sources import tables


def test_report_names_every_fault(spark):
    raw = spark.createDataFrame(
        [("f1", "1", "x", None), ("f2", "Infinity", "2", "Benign"), ("f3", None, "y", None)],
        "flow_id string, a string, b string, label string",
    )
    table = spark.createDataFrame(
        [(None, 2.0, 1.0), (None, 2.0, float("inf")), (None, 2.0, 3.0)], "empty double, same double, wild double"
    )
    found = {tuple(r) for r in quality.quality_report(raw, table, table.columns).collect()}
    assert found == {
        ("cast_failed", "b", 2),
        ("label_missing", "label", 2),
        ("all_null", "empty", 3),
        ("constant", "same", 3),
        ("infinite", "wild", 1),
    }


def test_nothing_wrong(spark):
    raw = spark.createDataFrame([("f1", "1", "a")], "flow_id string, a string, label string")
    table = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert [tuple(r) for r in quality.quality_report(raw, table, ["x"]).collect()] == [("label_missing", "label", 0)]


def test_raw_rows_are_read_once_for_cleaning_and_counts(spark, sf_dir, tmp_path):
    rows = flows(spark, sf_dir).withColumn("note", F.concat(F.lit("n"), "flow_id"))
    rows.write.parquet(str(tmp_path / "raw"))
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    def raw():
        stored = spark.read.parquet(str(tmp_path / "raw"))
        return stored.mapInArrow(count, stored.schema)

    folder = str(tmp_path / "work")
    cleaned, counts = stages.prepare_counted(spark, raw, folder)
    assert (cleaned.status, counts.status) == ("written", "written")
    stages.report_quality(spark, raw, folder)
    assert passed.value == rows.count()
    counted = {tuple(r) for r in tables.read_table(spark, counts.path).collect()}
    assert counted == {tuple(r) for r in quality.counted_raw(rows).collect()}
    reported = tables.read_table(spark, f"{folder}/quality").filter("check IN ('cast_failed', 'label_missing')")
    assert {tuple(r) for r in reported.collect()} == {tuple(r) for r in quality.raw_quality(rows).collect()}
    assert ("cast_failed", "note", rows.count()) in counted


def test_counts_missing_after_a_cut_are_made_up_for(spark, sf_dir, tmp_path):
    folder, raw = str(tmp_path), lambda: flows(spark, sf_dir)
    stages.prepare_cleaned(spark, raw, folder)
    cleaned, counts = stages.prepare_counted(spark, raw, folder)
    assert (cleaned.status, counts.status) == ("skipped", "written")
    counted = {tuple(r) for r in tables.read_table(spark, counts.path).collect()}
    assert counted == {tuple(r) for r in quality.counted_raw(raw()).collect()}
