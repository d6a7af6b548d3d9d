from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlab.operators import models
from flowlab.plans import stages
from flowlab.plans.inputs import flows
from flowlab.sources import flow_csv, storage, tables
from flowlab.streaming.ingest import ingest_new_files
from flowlab.streaming.scoring import score_new_files

QUICK = {
    models.MODEL_LR: {"maxIter": 3},
    models.MODEL_MLP: {"maxIter": 5},
    models.MODEL_RF: {"numTrees": 4, "maxDepth": 4},
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("stages"))


@pytest.fixture(scope="module")
def first_run(spark, sf_dir, folder):
    return stages.run_stages(spark, lambda: flows(spark, sf_dir), folder, settings=QUICK)


def test_first_run_writes_every_stage(spark, first_run):
    rows = {s.name: s.rows for s in first_run}
    assert {s.status for s in first_run} == {"written"}
    assert rows["cleaned"] == rows["ml_ready"] == 5208
    assert rows["metrics"] == 15 and rows["confusion"] <= 12
    assert all(done for _, done in stages.stage_status(spark, [s.path for s in first_run]))


def test_second_run_skips_every_stage(spark, first_run, folder):
    def no_input():
        raise AssertionError("a finished stage must not read its input")

    assert {s.status for s in stages.run_stages(spark, no_input, folder, settings=QUICK)} == {"skipped"}


@pytest.mark.parametrize("name", list(models.TRAINERS))
def test_predictions_keep_rows_and_rules(spark, first_run, folder, name):
    test = models.split(tables.read_table(spark, f"{folder}/ml_ready"))[1]
    scored = stages.read_predictions(spark, folder, [name])
    assert scored.columns == [
        "model", "flow_id", "label", "label_original", "features", "rawPrediction", "probability", "prediction", models.SCORE,
    ]
    assert scored.select("flow_id").exceptAll(test.select("flow_id")).isEmpty() and scored.count() == test.count()
    p = vector_to_array(F.col("probability"))
    broken = (F.abs(p[0] + p[1] - 1) > 1e-9) | (F.col(models.SCORE) != p[1]) | ((p[1] > p[0]).cast("double") != F.col("prediction"))
    assert scored.filter(broken).isEmpty()


def test_training_again_gives_the_same_cells(spark, first_run, folder):
    ready = tables.read_table(spark, f"{folder}/ml_ready")
    for name in models.TRAINERS:
        again = models.fit_and_predict(name, ready, **QUICK[name]).groupBy("label", "prediction").count()
        before = tables.read_table(spark, f"{folder}/comparison/confusion").filter(F.col("model") == name)
        assert sorted(again.collect()) == sorted(before.select("label", "prediction", "count").collect())


def test_missing_input_fails_before_any_work(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="absent"):
        stages.materialize(spark, "x", str(tmp_path / "x"), lambda: 1 / 0, needs=[str(tmp_path / "absent")])


def test_half_written_stage_is_done_again(spark, tmp_path):
    path = tmp_path / "x"
    path.mkdir()
    (path / "part-0.parquet").write_text("cut short")
    assert not storage.complete(spark, str(path))
    stage = stages.materialize(spark, "x", str(path), lambda: spark.range(5))
    assert (stage.status, stage.rows) == ("written", 5) and spark.read.parquet(str(path)).count() == 5


def test_other_settings_redo_a_stage_and_what_follows(spark, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")

    def run(**settings):
        made = stages.materialize(spark, "first", first, lambda: spark.range(5), settings=settings)
        return made.status, stages.materialize(spark, "second", second, lambda: spark.read.parquet(first), [first]).status

    assert run(rate=1) == ("written", "written")
    assert run(rate=1) == ("skipped", "skipped")
    assert run(rate=2) == ("written", "written")
    assert run(rate=2) == ("skipped", "skipped")


def test_options_reach_the_tables(spark, sf_dir, tmp_path):
    def prepared(name, **options):
        chosen = stages.Options(**options)
        done = stages.prepare(spark, lambda: flows(spark, sf_dir), str(tmp_path / name), chosen)
        return done, tables.read_table(spark, done[1].path)

    (plain, _), ready = prepared("plain")
    (kept, _), _ = prepared("kept", keep_nulls=True)
    assert kept.rows > plain.rows
    _, narrow = prepared("narrow", exclude=("duration", "log_duration"), caps_from="train")
    assert models.feature_width(narrow) == models.feature_width(ready) - 2
    again = stages.prepare(spark, lambda: flows(spark, sf_dir), str(tmp_path / "plain"), stages.Options(strict=True))
    assert [s.status for s in again] == ["written", "written"]


def test_exports_cover_every_finished_stage(spark, first_run, folder):
    names = stages.export(spark, folder)
    assert {n for n in names if n.startswith("samples/")} == {
        "samples/cleaned", "samples/ml_ready", *(f"samples/{stages.slug(m)}" for m in models.TRAINERS)
    }
    assert {"reports_csv/metrics", "reports_json/confusion", "reports_csv/quality"} <= set(names)
    for name in names:
        read = spark.read.option("header", True).csv if "json" not in name else spark.read.json
        assert read(f"{folder}/exports/{name}").count() > 0, name


def test_slug_rules_agree(spark):
    from flowlab.operators.metrics import slug

    rows = spark.createDataFrame([(m,) for m in models.TRAINERS], "model string")
    assert all(r[1] == stages.slug(r[0]) for r in rows.select("model", slug(F.col("model"))).collect())


def test_layer_sizes():
    assert models.layer_sizes(127) == [127, 63, 31, 2]
    assert models.layer_sizes(14) == [14, 32, 16, 2]
    assert models.layer_sizes(1000) == [1000, 128, 64, 2]


def test_feature_width_with_and_without_metadata(spark, first_run, folder):
    ready = tables.read_table(spark, f"{folder}/ml_ready")
    assert models.feature_width(ready) == 14
    rows = [tuple(r) for r in ready.select("features").limit(2).collect()]
    assert models.feature_width(spark.createDataFrame(rows, ["features"])) == 14


def test_scaled_training_rows_have_unit_deviation(spark):
    from flowlab.operators.features import assemble

    rows = spark.range(100).select(
        F.col("id").cast("string").alias("flow_id"), F.col("id").cast("double").alias("x"), F.lit(3.0).alias("same"), F.lit(0.0).alias("label")
    )
    vectors = assemble(rows, ["x", "same"])
    scaled = models.unit_deviation(vectors).transform(vectors).select(vector_to_array("scaled_features").alias("v"))
    deviation, constant = scaled.agg(F.stddev_samp(F.col("v")[0]), F.max(F.col("v")[1])).first()
    assert deviation == pytest.approx(1.0) and constant == 0.0


def test_split_keeps_every_row_once(spark, sf_dir):
    rows = flows(spark, sf_dir)
    train, test = models.split(rows)
    assert train.count() == 4812 and train.unionByName(test).exceptAll(rows).isEmpty()
    assert train.count() + test.count() == rows.count()


def test_null_keys_are_in_exactly_one_part(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("flow_id"), "id")
    train, test = models.split(rows)
    assert train.count() + test.count() == 1000
    assert train.unionByName(test).select("id").distinct().count() == 1000


def test_ingest_fails_on_reordered_columns(spark, tmp_path):
    source, landing, memory = (tmp_path / n for n in ("source", "landing", "memory"))
    source.mkdir()
    (source / "a.csv").write_text("label,flow_id,duration\nBenign,f1,x2\n")
    schema = flow_csv.text_schema(["flow_id", "duration", "label"])
    with pytest.raises(StreamingQueryException):
        ingest_new_files(spark, str(source), schema, str(landing), str(memory))


def test_ingest_lands_every_file_once(spark, tmp_path):
    source, landing, memory = (str(tmp_path / n) for n in ("source", "landing", "memory"))
    schema = flow_csv.text_schema(["flow_id", "label"])

    def lot(first, count, files):
        rows = spark.range(first, first + count, 1, files).select(F.col("id").cast("string").alias("flow_id"), F.lit("a").alias("label"))
        rows.write.mode("append").option("header", True).csv(source)

    lot(0, 30, 3)
    assert ingest_new_files(spark, source, schema, landing, memory) == 30
    assert ingest_new_files(spark, source, schema, landing, memory) == 0
    lot(30, 50, 5)
    assert ingest_new_files(spark, source, schema, landing, memory, files_per_batch=2) == 50
    landed = spark.read.parquet(landing)
    assert landed.count() == 80 and landed.select("flow_id").distinct().count() == 80


def test_tables_and_landings_take_little_room(spark, folder, first_run, tmp_path):
    """Stages, predictions and landed rows are stored by the library's own compression, not Spark's default."""
    landing = str(tmp_path / "landing")
    ready = tables.read_table(spark, f"{folder}/ml_ready")
    model = models.train_lr(ready.select("features", "label"), maxIter=1)
    score_new_files(spark, model, "m", f"{folder}/ml_ready", landing, str(tmp_path / "memory"))
    for path in (f"{folder}/cleaned", f"{folder}/ml_ready", stages.predictions_table(folder), landing):
        files = tables.files_of(spark.read.parquet(path))
        assert files and all(f.endswith(".zstd.parquet") for f in files)
