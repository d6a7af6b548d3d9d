"""What must not grow with the table: shuffles, stored rows and broadcasts of the flow library's steps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from flowlab.functions.values import number
from flowlab.operators import clean, models, tuning
from flowlab.plans import catalog, stages
from flowlab.plans.inputs import flows
from flowlab.sources import exports, flow_csv
from flowlab.sources.storage import exists
from flowlab.streaming import ingest


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_cleaning_stage_does_not_shuffle(spark, sf_dir, tmp_path, monkeypatch):
    plans, write = [], stages.write_table

    def watched(df, *others):
        plans.append(plan_of(df))
        return write(df, *others)

    monkeypatch.setattr(stages, "write_table", watched)
    stages.prepare_cleaned(spark, lambda: flows(spark, sf_dir), str(tmp_path))
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_the_forest_stores_no_number_per_row_and_tree():
    assert not models.estimator_rf(0).getCacheNodeIds()


def test_training_rows_are_shuffled_once_and_not_kept(spark, monkeypatch):
    rows = spark.range(60).selectExpr("CAST(id AS STRING) flow_id", "id AS features", "CAST(id % 2 AS DOUBLE) label")
    seen = []
    monkeypatch.setitem(models.TRAINERS, "probe", lambda df: seen.append((df, df.storageLevel.useMemory, df.columns)))
    models.fit_named("probe", rows)
    assert seen[0][1:] == (True, ["features", "label"])
    assert not seen[0][0].storageLevel.useMemory


def test_a_fold_stores_only_what_settings_read_and_drops_it(spark, monkeypatch):
    rows = spark.range(400).selectExpr("CAST(id AS STRING) flow_id", "CAST(id AS DOUBLE) a", "CAST(id * 7 % 11 AS DOUBLE) b", "CAST(id % 2 AS DOUBLE) label")
    dropped, discard = [], tuning.discard

    def watched(spark, path):
        dropped.append((path, spark.read.parquet(path).columns))
        discard(spark, path)

    monkeypatch.setattr(tuning, "discard", watched)
    pipeline = models.from_features(["a", "b"], models.estimator_lr(0, maxIter=1))
    found = tuning.fold_outcomes(rows, pipeline, tuning.settings_grid(regParam=[0.0, 0.5]), folds=2)
    assert found.groupBy("model").agg(F.sum("count").alias("n")).filter("n = 400").count() == 2
    assert [sorted(c) for _, c in dropped] == [["features", "flow_id", "fold", "label"]] * 2
    assert not any(exists(spark, path) for path, _ in dropped)


def test_marks_of_repeated_rows_are_few(spark, monkeypatch):
    """One row per bitmap and not one per repeated digest."""
    stored, durable = {}, clean.durable

    def watched(df, name):
        stored[name] = durable(df, name)
        return stored[name]

    monkeypatch.setattr(clean, "durable", watched)
    rows = spark.range(12_000).unionByName(spark.range(6_000))
    assert clean.drop_duplicate_rows(rows).count() == 12_000
    assert stored["marked"].count() <= clean.SLOTS // 32_768 == 4_096


def test_lines_that_are_in_order_do_not_carry_their_file(spark, tmp_path):
    lines = spark.createDataFrame([("1,2",), ("3",), ("4,5",)], "value string")
    exports.write_lines(lines.coalesce(1), str(tmp_path / "raw"), "a,b")
    rows, bad = flow_csv.quarantine_flows(spark, str(tmp_path / "raw"), str(tmp_path / "parsed"))
    assert sorted(map(tuple, rows.collect())) == [("1", "2"), ("4", "5")]
    assert [r.text for r in bad.collect()] == ["3"] and "raw" in bad.first().file
    stored = spark.read.parquet(str(tmp_path / "parsed")).filter(~F.col(flow_csv.QUARANTINED))
    assert stored.filter(F.col(flow_csv.FILE).isNotNull()).isEmpty()


def test_strict_numbers_read_their_text_twice(spark):
    """A filter on them repeats the whole expression, and what made the text with it."""
    rows = spark.range(1).select(F.concat(F.lit("1e"), F.col("id").cast("string")).alias("x"))
    plan = rows.filter(number("x", strict=True) >= 0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(") == 1 + plan.count("try_cast(concat(") <= 3
    texts = ["Infinity", "-Infinity", "inf", "-inf", "INF", "+infinity", "NaN", "nan", "x", None, "-1", " 2 ", "1e400", "-0"]
    found = spark.createDataFrame([(t,) for t in texts], "x string").select("x", number("x", strict=True).alias("v")).collect()
    assert [(r.x, r.v) for r in found if r.v is not None] == [("-1", -1.0), (" 2 ", 2.0), ("-0", 0.0)]


def test_raw_scores_are_made_once_as_a_table_and_streamed_in_small_methods(spark, sf_dir, monkeypatch):
    stored, limits, durable, start = [], [], catalog.durable, DataStreamWriter.start

    def storing(df, name):
        stored.append(name)
        return durable(df, name)

    def starting(writer, *others, **more):
        limits.append(spark.conf.get(ingest.METHOD_SETTING))
        return start(writer, *others, **more)

    monkeypatch.setattr(catalog, "durable", storing)
    monkeypatch.setattr(DataStreamWriter, "start", starting)
    kept = spark.conf.get(ingest.METHOD_SETTING)
    spark.conf.set(ingest.METHOD_SETTING, "65535")
    try:
        found = catalog.raw_stream_score(spark, sf_dir).collect()
        assert limits == ["8000"] * 3 and spark.conf.get(ingest.METHOD_SETTING) == "65535"
    finally:
        spark.conf.set(ingest.METHOD_SETTING, kept)
    assert stored == ["batch", "counts", "counts", "counts"]
    assert {r.run for r in found} == {1, 2, 3} and all(r["rows"] == r.as_batch for r in found)
