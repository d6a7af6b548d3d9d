"""The named queries: each takes (spark, folder of the given tables) and returns a DataFrame.

Queries that need files to read (CSV, stages, ingest) first let Spark write them from the given
tables into the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.functions.derived import LOGS, OVER_TOTALS, RATIOS, TOTALS
from flowlab.functions.keys import in_percent
from flowlab.functions.values import no_negative
from flowlab.operators import clean, features, metrics, models, multiclass, profile, quality, tuning, weights
from flowlab.operators.capping import OutlierCaps
from flowlab.operators.quantiles import approximate_quantiles, exact_quantiles
from flowlab.plans import stages
from flowlab.plans.inputs import SCORED_LIFTS, classed, flows, scored, table
from flowlab.sources import exports, flow_csv, tables
from flowlab.sources.storage import durable, new_folder
from flowlab.streaming.ingest import ingest_new_files
from flowlab.streaming.scoring import score_new_files, score_raw_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BASELINE = next(iter(SCORED_LIFTS))
CAPPED = (0.01, 0.99)
LOG_DIGITS = 6


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_flows(flows(spark, sf_dir))


@lru_cache(maxsize=8)
def _new_stage_folder(application: str, sf_dir: str, spark: SparkSession) -> str:
    return new_folder(spark, "stages")


def stage_folder(spark: SparkSession, sf_dir: str) -> str:
    """One folder of finished stages per session and data set, shared by the queries that use them."""
    return _new_stage_folder(spark.sparkContext.applicationId, sf_dir, spark)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned flows as a finished stage: for queries that scan them several times."""
    folder = stage_folder(spark, sf_dir)
    stage, _ = stages.prepare_counted(spark, lambda: flows(spark, sf_dir), folder)
    return tables.read_table(spark, stage.path)


def explored(df: DataFrame) -> list[str]:
    return [c for c in profile.EXPLORED if c in df.columns]


def rounded_logs(df: DataFrame) -> DataFrame:
    """Logarithms rounded: their last digit is the math library's."""
    return df.withColumns({d.name: F.round(d.name, LOG_DIGITS) for d in LOGS if d.name in df.columns})


# ---- cleaning ------------------------------------------------------------------------------


@query
def clean_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(cleaned(spark, sf_dir), "label")


@query
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir)


@query
def clean_rows_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_flows(flows(spark, sf_dir), keep_nulls=True)


@query
def clean_rows_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_flows(flows(spark, sf_dir), keep_nulls=True, strict=True)


@query
def clean_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table with one class loaded a second time, without the copies."""
    rows = flows(spark, sf_dir)
    return clean.drop_duplicate_rows(rows.unionByName(rows.filter("label = 'Heartbleed'")))


@query
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With no identifiers declared, the text key is the column that fails to cast."""
    return clean.cast_failures(flows(spark, sf_dir), ids=())


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(cleaned(spark, sf_dir))


# ---- profile -------------------------------------------------------------------------------


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.cast_measures(flows(spark, sf_dir))
    return profile.null_profile(typed, clean.measure_columns(typed), top=20)


@query
def sentinel_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows(spark, sf_dir)
    return profile.sentinel_profile(rows, clean.measure_columns(rows))


@query
def describe_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.cast_measures(flows(spark, sf_dir), strict=True)
    return profile.describe_long(typed, explored(typed))


@query
def summary_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closing check of feature engineering, over the finished features."""
    table_ = features.feature_table(stored(spark, sf_dir), exact=True)
    checked = [c for c in features.CHECKED if c in table_.columns]
    return profile.describe_long(table_, checked, digits=4).withColumn("value", F.round("value", 4))


@query
def binary_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(features.binary_target(cleaned(spark, sf_dir)), "label", largest_first=False)


@query
def class_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_share(cleaned(spark, sf_dir), "label")


@query
def attack_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.attack_share(flows(spark, sf_dir), "label", digits=1)


@query
def sampled_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.estimated_distribution(flows(spark, sf_dir), "label", "flow_id")


@query
def stage_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each stage; all stages only leave rows out, so one scan of the raw table counts them."""
    typed = clean.cast_measures(flows(spark, sf_dir))
    kept = no_negative([c for c in clean.NON_NEGATIVE if c in typed.columns])
    test = ~in_percent("flow_id", models.TRAIN_PERCENT)
    rules = [("raw", F.lit(True)), ("cleaned", kept), ("ml_ready", kept), ("test", kept & test)]
    return profile.reconcile_rules(typed, rules)


@query
def minmax_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.cast_measures(flows(spark, sf_dir))
    names = explored(typed)
    return profile.minmax_scaled(typed, names).select("flow_id", "label", *names)


@query
def minmax_label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.cast_measures(flows(spark, sf_dir))
    return profile.minmax_class_means(typed, "label", explored(typed))


@query
def log_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, smallest and largest log of every explored measure."""
    typed = clean.cast_measures(flows(spark, sf_dir))
    return (
        profile.log_values(typed, explored(typed))
        .groupBy("feature")
        .agg(
            F.count("*").alias("rows"),
            F.round(F.min("value"), LOG_DIGITS).alias("low"),
            F.round(F.max("value"), LOG_DIGITS).alias("high"),
        )
    )


@query
def log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.cast_measures(flows(spark, sf_dir))
    return profile.log_histogram(typed, explored(typed))


@query
def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(in_percent("flow_id", models.TRAIN_PERCENT), "train").otherwise("test")
    return flows(spark, sf_dir).groupBy(part.alias("part")).count()


def _some_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("fwd_packets_count") != "7", F.col("flow_id"))
    return flows(spark, sf_dir).withColumn("flow_id", key)


@query
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, rows, without_key): every row is in one part, also those whose key is NULL."""
    train, test = models.split(_some_null_keys(spark, sf_dir))
    parts = train.select(F.lit("train").alias("part"), "flow_id").union(test.select(F.lit("test"), "flow_id"))
    return parts.groupBy("part").agg(
        F.count("*").alias("rows"), F.count_if(F.col("flow_id").isNull()).alias("without_key")
    )


# ---- a second domain: the event table ------------------------------------------------------


@query
def events_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(table(spark, sf_dir, "events"), "event_type")


@query
def events_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_share(table(spark, sf_dir, "events"), "event_type", without="error")


@query
def events_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.describe_long(table(spark, sf_dir, "events"), ["user_id", "value"])


@query
def events_minmax_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.minmax_class_means(table(spark, sf_dir, "events"), "event_type", ["user_id", "value"])


@query
def events_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.log_histogram(table(spark, sf_dir, "events"), ["user_id", "value"])


@query
def events_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_quantiles(table(spark, sf_dir, "events"), ["user_id", "value"], [0.01, 0.5, 0.99])


# ---- features ------------------------------------------------------------------------------


@query
def feature_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_derived(cleaned(spark, sf_dir), TOTALS).select("flow_id", *(d.name for d in TOTALS))


@query
def feature_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = features.add_derived(cleaned(spark, sf_dir), TOTALS, RATIOS, OVER_TOTALS)
    return derived.select("flow_id", *(d.name for d in (*RATIOS, *OVER_TOTALS)))


@query
def feature_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = features.add_derived(cleaned(spark, sf_dir), LOGS)
    return rounded_logs(derived.select("flow_id", *(d.name for d in LOGS)))


@query
def quantile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(spark, sf_dir)
    return exact_quantiles(rows, clean.measure_columns(rows), list(CAPPED))


def _bounds_within(spark: SparkSession, sf_dir: str, error: float) -> DataFrame:
    """(column, probability, within): the bounds' true ranks, held against the allowed error.

    A value fills the ranks from the share of rows below it to the share of rows up to it.
    """
    rows = stored(spark, sf_dir)
    names = clean.measure_columns(rows)
    rows = features.nan_to_null(rows, names)
    found = approximate_quantiles(rows, names, list(CAPPED), error)
    pairs = [(c, p, v) for c, values in found.items() for p, v in zip(CAPPED, values, strict=True)]
    counted = rows.agg(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(p).alias("probability"),
                (
                    (F.count_if(F.col(c) < v) / F.count(c) <= p + error)
                    & (F.count_if(F.col(c) <= v) / F.count(c) >= p - error)
                ).alias("within"),
            ).alias(f"b{i}")
            for i, (c, p, v) in enumerate(pairs)
        )
    )
    return counted.select(F.inline(F.array(*(f"b{i}" for i in range(len(pairs))))))


@query
def approx_bounds_within_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounds_within(spark, sf_dir, 0.001)


@query
def approx_bounds_beyond_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error that the largest sketch cannot keep."""
    return _bounds_within(spark, sf_dir, 0.0001)


@query
def winsorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(spark, sf_dir)
    names = clean.measure_columns(rows)
    rows = features.nan_to_null(rows, names)
    return features.apply_caps(rows, features.fit_caps(rows, names, exact=True)).select("flow_id", *names)


@query
def ml_ready_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_logs(features.feature_table(stored(spark, sf_dir), exact=True))


def _array_columns(vector: str, names: list[str]) -> list[Column]:
    values = vector_to_array(F.col(vector))
    return [values[i].alias(n) for i, n in enumerate(names)]


@query
def vector_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table through the vector column and back."""
    table_ = features.feature_table(stored(spark, sf_dir), exact=True)
    names = features.numeric_columns(table_)
    vectors = features.assemble(table_, names)
    return rounded_logs(vectors.select("flow_id", "label", "label_original", *_array_columns("features", names)))


@query
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows divided by the standard deviations of the training rows."""
    table_ = features.feature_table(stored(spark, sf_dir), exact=True)
    names = features.numeric_columns(table_)
    train, test = models.split(features.assemble(table_, names))
    scaled = models.unit_deviation(train).transform(test)
    columns = scaled.select("flow_id", *_array_columns("scaled_features", names))
    return columns.withColumns({n: F.round(n, LOG_DIGITS) for n in names})


# ---- model comparison on the scored table --------------------------------------------------


@query
def confusion_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(scored(spark, sf_dir)).orderBy("model", "label", "prediction")


@query
def confusion_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_dense(metrics.confusion(scored(spark, sf_dir)))


@query
def confusion_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = metrics.confusion_normalised(metrics.confusion(scored(spark, sf_dir)))
    return cells.withColumn("share", F.round("share", 6))


@query
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_class = metrics.class_metrics(metrics.confusion(scored(spark, sf_dir)))
    return per_class.withColumns({m: F.round(m, 9) for m in ("precision", "recall", "f1")})


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metrics_long(scored(spark, sf_dir), "score")


@query
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir).withColumn("value", F.round("value", 9))


@query
def metrics_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metrics_wide(_metrics(spark, sf_dir), digits=9)


@query
def metrics_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four digits, with the model's short name and file name."""
    wide = metrics.metrics_wide(_metrics(spark, sf_dir), digits=4)
    return wide.withColumn("short_name", metrics.short_name(F.col("model"))).withColumn(
        "slug", metrics.slug(F.col("model"))
    )


@query
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_model(_metrics(spark, sf_dir)).withColumn("value", F.round("value", 9))


@query
def best_per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_per_metric(_metrics(spark, sf_dir)).withColumn("value", F.round("value", 9))


@query
def metric_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = metrics.metric_delta(_metrics(spark, sf_dir), BASELINE)
    return deltas.withColumns({c: F.round(c, 9) for c in ("value", "baseline", "change")})


@query
def model_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.model_counts(scored(spark, sf_dir))


@query
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metrics.roc_points(scored(spark, sf_dir), "score")
    return points.withColumns({c: F.round(c, 9) for c in ("tpr", "fpr")})


@query
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc_exact(scored(spark, sf_dir), "score").withColumn("auc_roc", F.round("auc_roc", 12))


@query
def auc_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, near): the thinned curve's area lies within 0.001 of the exact one."""
    rows = scored(spark, sf_dir)
    both = metrics.auc_binned(rows, "score").join(metrics.auc_exact(rows, "score"), "model")
    return both.select("model", (F.abs(F.col("auc_binned") - F.col("auc_roc")) < 0.001).alias("near"))


@query
def score_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with and without a usable score, where some scores are NULL and some NaN."""
    score = F.col("score").cast("double")
    odd = F.when(F.col("score") % 50 == 0, None).when(F.col("score") % 50 == 1, float("nan")).otherwise(score)
    rows = scored(spark, sf_dir).withColumn("score", odd)
    area = metrics.auc_exact(rows, "score").withColumn("auc_roc", F.round("auc_roc", 12))
    return metrics.score_coverage(rows, "score").join(area, "model")


@query
def recall_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.recall_by_class(scored(spark, sf_dir), "line_class")
    return found.withColumn("recall", F.round("recall", 9))


# ---- files, stages, ingest -----------------------------------------------------------------


@query
def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus"]
    return tables.read_table(spark, f"{sf_dir}/lineitem.parquet", columns).groupBy(*columns).count()


@query
def file_union_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and test rows in two directories, read as one table."""
    folder = new_folder(spark, "union")
    for name, part in zip(("train", "test"), models.split(cleaned(spark, sf_dir)), strict=True):
        tables.write_table(part, f"{folder}/{name}")
    return tables.read_table(spark, [f"{folder}/train", f"{folder}/test"])


@query
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows written in one directory per class and read back."""
    path = new_folder(spark, "cleaned")
    tables.write_table(cleaned(spark, sf_dir), path, ["label"])
    return tables.read_table(spark, path)


@query
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty flow table through CSV files and the cleaning rules."""
    path = new_folder(spark, "raw")
    exports.write_csv(flows(spark, sf_dir), path)
    return clean.clean_flows(flow_csv.read_flows(spark, path))


@query
def header_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose header pads names and repeats one: the first of equal names is the column."""
    folder = new_folder(spark, "padded")
    lines = flows(spark, sf_dir).select(
        F.concat_ws(",", F.concat(F.lit(" "), "flow_id"), F.concat("duration", F.lit("  ")), F.coalesce("label", F.lit("")), F.lit("other"))
        .alias("value"),
        (F.col("bwd_packets_count") == "0").alias("first"),
    )
    headers = ((" flow_id ,duration,  label, duration ", "first"), ("flow_id, duration ,label,duration", "not first"))
    for number, (header, which) in enumerate(headers):
        exports.write_lines(lines.filter(which).select("value"), f"{folder}/{number}", header)
    return flow_csv.read_flows(spark, f"{folder}/*")


@query
def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(quarantined, line, named): every line of files in which some lines lack a field or have one too
    many; ``named`` tells that a quarantined line knows its file."""
    folder = new_folder(spark, "faulty")
    fields = F.concat_ws(",", "flow_id", "duration", "fwd_packets_count")
    line = (
        F.when(F.col("bwd_packets_count") == "0", F.concat_ws(",", "flow_id", "duration"))
        .when(F.col("fwd_packets_count") == "7", F.concat(fields, F.lit(",more")))
        .otherwise(fields)
    )
    header = "flow_id,duration,fwd_packets_count"
    exports.write_lines(flows(spark, sf_dir).select(line.alias("value")), f"{folder}/raw", header)
    rows, bad = flow_csv.quarantine_flows(spark, f"{folder}/raw", f"{folder}/parsed")
    good = rows.select(F.lit(False).alias("quarantined"), F.concat_ws(",", *rows.columns).alias("line"), F.lit(None).cast("boolean").alias("named"))
    return good.unionByName(
        bad.select(F.lit(True).alias("quarantined"), F.col("text").alias("line"), F.col("file").contains(folder).alias("named"))
    )


@query
def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class report as JSON and as CSV; the rows of both."""
    folder = new_folder(spark, "report")
    counts = profile.distribution(cleaned(spark, sf_dir), "label")
    exports.write_json(counts, f"{folder}/json", one_file=True)
    exports.write_csv(counts, f"{folder}/csv", one_file=True)
    shape = "label string, count bigint"
    json = spark.read.schema(shape).json(f"{folder}/json").withColumn("format", F.lit("json"))
    csv = spark.read.schema(shape).option("header", True).csv(f"{folder}/csv").withColumn("format", F.lit("csv"))
    return json.unionByName(csv)


@query
def sample_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["label", "flow_id", "duration", "no_such_column", "bytes_rate"]
    return exports.sample_rows(cleaned(spark, sf_dir), 50, "flow_id", columns)


@query
def schema_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.schema_with_counts(clean.cast_measures(flows(spark, sf_dir))).drop("nullable")


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, added): files arrive in two lots; the third run finds nothing new."""
    folder = new_folder(spark, "ingest")
    rows = flows(spark, sf_dir)
    source, landing, memory = (f"{folder}/{n}" for n in ("source", "landing", "checkpoint"))
    added = []
    for lot in (*models.split(rows), None):
        if lot is not None:
            lot.write.mode("append").option("header", True).csv(source)
        added.append(ingest_new_files(spark, source, rows.schema, landing, memory))
    return spark.createDataFrame(list(enumerate(added, 1)), "run int, added bigint")


@query
def resumable_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, status, rows): the second run finds the marker and writes nothing."""
    path = new_folder(spark, "cleaned")
    report = []
    for run in (1, 2):
        stage = stages.materialize(spark, "cleaned", path, lambda: cleaned(spark, sf_dir))
        report.append((run, stage.status, tables.read_table(spark, path).count()))
    return spark.createDataFrame(report, "run int, status string, rows bigint")


@query
def tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(input, found, rows): a missing input is reported and does not stop the job."""
    schema = table(spark, sf_dir, "lineitem").schema
    report = []
    for name in ("lineitem", "no_such_table"):
        rows, found = tables.read_if_present(spark, f"{sf_dir}/{name}.parquet", schema)
        report.append((name, found, rows.count()))
    return spark.createDataFrame(report, "input string, found boolean, rows bigint")


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks; with no identifiers declared, the text key is the column that fails to cast."""
    made = features.engineered(cleaned(spark, sf_dir)).withColumns(
        {"nothing": F.lit(None).cast("double"), "same": F.lit(1.5), "endless": F.when(F.col("duration") > 40, float("inf")).otherwise(0.0)}
    )
    return quality.quality_report(flows(spark, sf_dir), made, features.numeric_columns(made), ids=())


@query
def stage_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(export, rows) of the readable copies of the prepared stages, read back."""
    folder = new_folder(spark, "exported")
    raw = lambda: flows(spark, sf_dir)
    stages.prepare(spark, raw, folder)
    stages.report_quality(spark, raw, folder)
    names = stages.export(spark, folder, models=())
    counts = [
        (spark.read.option("header", True).csv(f"{folder}/exports/{n}") if "json" not in n else spark.read.json(f"{folder}/exports/{n}"))
        .agg(F.lit(n).alias("export"), F.count("*").alias("rows"))
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def observed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows and their faults, counted by the job that wrote the cleaned rows."""
    folder = new_folder(spark, "counted")
    _, counts = stages.prepare_counted(spark, lambda: flows(spark, sf_dir).withColumn("note", F.col("flow_id")), folder)
    return tables.read_table(spark, counts.path)


@query
def rescored_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, rows, called, files_kept): one model of the table of predictions is scored anew; the files of
    the others stay, and reading one model reads its partition only."""
    path = new_folder(spark, "predictions")
    rows = scored(spark, sf_dir)
    tables.replace_partitions(rows, path, ["model"])

    def files() -> dict[str, list[str]]:
        kept = spark.read.parquet(path)
        return {m: tables.files_of(kept.filter(F.col("model") == m)) for m in SCORED_LIFTS}

    before, chosen = files(), list(SCORED_LIFTS)[1]
    again = rows.filter(F.col("model") == chosen).withColumn("prediction", (F.col("score") >= 300).cast("double"))
    tables.replace_partitions(again, path, ["model"], gather=False)
    after = files()
    same = F.lit(None).cast("boolean")
    for m in SCORED_LIFTS:
        same = F.when(F.col("model") == m, F.lit(before[m] == after[m])).otherwise(same)
    return (
        spark.read.parquet(path)
        .groupBy("model")
        .agg(F.count("*").alias("rows"), F.sum("prediction").cast("bigint").alias("called"))
        .withColumn("files_kept", same)
    )


# ---- several classes and class weights -----------------------------------------------------


def _classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, multiclass.StringIndexerModel]:
    """Rows of several classes with the predictions and scores of a made-up classifier; its index has not
    seen one class."""
    rows = classed(spark, sf_dir)
    index = multiclass.class_index(rows.filter("label_original <> 'Other'"))
    number = len(index.labels)
    found = multiclass.indexed(rows, index).withColumn("label", F.col(multiclass.INDEX))
    places = F.array(*map(F.lit, range(number)))
    scores = F.transform(places, lambda c: (F.col("base") + c * 131) % 1000 + F.when(c == F.col("label"), 300).otherwise(0))
    prediction = ((F.col("label") + F.col("shift")) % number).cast("double")
    return found.select(F.lit("made up").alias("model"), "label", prediction.alias("prediction"), scores.alias("probability")), index


@query
def class_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(class_index, class): most frequent first, then the unseen."""
    index = multiclass.class_index(classed(spark, sf_dir).filter("label_original <> 'Other'"))
    return multiclass.class_names(index, spark)


@query
def multiclass_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = multiclass.evaluate(*_classified(spark, sf_dir))
    return report.withColumns({m: F.round(m, 9) for m in ("precision", "recall", "f1", "auc_roc")})


@query
def multiclass_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = multiclass.evaluate(*_classified(spark, sf_dir))
    macro = multiclass.macro_metrics(report)
    return macro.withColumns({m: F.round(m, 9) for m in ("precision", "recall", "f1", "auc_roc")})


@query
def multiclass_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, index = _classified(spark, sf_dir)
    return multiclass.confusion_matrix(metrics.confusion(rows), index.labels)


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weights.class_weights(cleaned(spark, sf_dir))
    return found.withColumn("weight", F.round("weight", 9))


@query
def weighted_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the scored table by rows and by weights that even out the two labels."""
    cells = weights.weighted_confusion(weights.with_class_weights(scored(spark, sf_dir)))
    return cells.withColumn("weight", F.round("weight", 6))


# ---- trained models ------------------------------------------------------------------------


def _stage_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = stage_folder(spark, sf_dir)
    stages.prepare(spark, lambda: flows(spark, sf_dir), folder)
    return folder


def _predictions(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    folder = _stage_folder(spark, sf_dir)
    for name in names:
        stages.score(spark, folder, name)
    return stages.read_predictions(spark, folder, names)


def _scores(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Per class of the test rows: how many were scored, with a probability between 0 and 1, and a
    prediction that is a class; and whether the model is hardly worse than always naming one class."""
    rows = _predictions(spark, sf_dir, [name])
    in_unit = F.col(models.SCORE).between(0, 1)
    per_class = rows.groupBy("model", "label").agg(
        F.count("*").alias("rows"),
        F.count_if(in_unit).alias("in_unit"),
        F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("classes"),
        F.count_if(F.col("prediction") == F.col("label")).alias("hits"),
    )
    everywhere = Window.partitionBy("model")  # two rows
    total = F.sum("rows").over(everywhere)
    fair = F.sum("hits").over(everywhere) / total >= F.max("rows").over(everywhere) / total - 0.05
    return per_class.select("model", "label", "rows", "in_unit", "classes", fair.alias("fair"))


@query
def score_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, models.MODEL_LR)


@query
def score_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, models.MODEL_MLP)


@query
def score_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, models.MODEL_RF)


@query
def prediction_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model and class: the scored rows, and how many keep the rules of a prediction."""
    rows = _predictions(spark, sf_dir, list(models.TRAINERS))
    p = vector_to_array(F.col("probability"))
    return rows.groupBy("model", "label_original", "label").agg(
        F.count("*").alias("rows"),
        F.count_if(F.abs(p[0] + p[1] - 1) < 1e-9).alias("sums_to_one"),
        F.count_if((p[1] > p[0]).cast("double") == F.col("prediction")).alias("follows_probability"),
    )


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small forest's importances: one per feature, none negative, together one."""
    ready = tables.read_table(spark, f"{_stage_folder(spark, sf_dir)}/ml_ready")
    train = models.split(ready)[0].select("features", "label")
    forest = models.train_rf(train, numTrees=5, maxDepth=4)
    names = features.numeric_columns(features.engineered(stored(spark, sf_dir)))
    return models.feature_importance(forest, names, spark).agg(
        F.count("*").alias("features"),
        F.count_if(F.col("importance") >= 0).alias("valid"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
    )


@query
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, rows, as_batch): rows scored as a stream of files equal rows scored as a table."""
    source = f"{_stage_folder(spark, sf_dir)}/ml_ready"
    ready, folder = tables.read_table(spark, source), new_folder(spark, "scored-stream")
    model = models.train_lr(models.split(ready)[0].select("features", "label"), maxIter=2)
    score_new_files(spark, model, models.MODEL_LR, source, f"{folder}/rows", f"{folder}/checkpoint")
    batch = models.predict(model, ready, models.MODEL_LR).select("flow_id", F.col(models.SCORE).alias("expected"))
    streamed = spark.read.parquet(f"{folder}/rows").join(batch, "flow_id", "left")
    return streamed.groupBy("label").agg(
        F.count("*").alias("rows"), F.count_if(F.col(models.SCORE) == F.col("expected")).alias("as_batch")
    )


@query
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, rows, as_counted, area): the compared metrics of the trained models follow from their
    stored confusion counts, and the areas are shares."""
    names = list(models.TRAINERS)
    _predictions(spark, sf_dir, names)
    folder = _stage_folder(spark, sf_dir)
    stages.compare(spark, folder, names)
    wide = metrics.metrics_wide(tables.read_table(spark, f"{folder}/comparison/metrics"))
    cells = metrics.confusion_dense(tables.read_table(spark, f"{folder}/comparison/confusion"))
    rows = F.expr("tn + fp + fn + tp")

    def ratio(top: str, bottom: str) -> Column:
        return F.expr(f"CASE WHEN {bottom} > 0 THEN ({top}) / ({bottom}) ELSE 0 END")

    def harmonic(one: Column, other: Column) -> Column:
        return F.when(one + other > 0, 2 * one * other / (one + other)).otherwise(0.0)

    no, yes = F.expr("tn + fp") / rows, F.expr("fn + tp") / rows
    p0, p1, r0, r1 = ratio("tn", "tn + fn"), ratio("tp", "tp + fp"), ratio("tn", "tn + fp"), ratio("tp", "fn + tp")
    closed = {
        "accuracy": F.expr("tn + tp") / rows,
        "precision": no * p0 + yes * p1,
        "recall": F.expr("tn + tp") / rows,
        "f1": no * harmonic(p0, r0) + yes * harmonic(p1, r1),
    }
    equal = reduce(lambda a, b: a & b, (F.abs(F.col(m) - v) < 1e-9 for m, v in closed.items()))
    return wide.join(cells, "model").select(
        "model", rows.alias("rows"), equal.alias("as_counted"), F.col("auc_roc").between(0, 1).alias("area")
    )


# ---- saved, tuned and weighted models ------------------------------------------------------


def _quick_pipeline(spark: SparkSession, sf_dir: str, exact: bool = False) -> tuple[DataFrame, models.Pipeline]:
    """Engineered rows, and the unfitted pipeline from caps to classifier over their columns."""
    made = features.engineered(stored(spark, sf_dir))
    return made, models.from_features(features.numeric_columns(made), models.estimator_lr(0, maxIter=3), exact=exact)


@query
def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, rows, as_fitted): test rows that a model read back from its files scores as the fitted one."""
    ready = tables.read_table(spark, f"{_stage_folder(spark, sf_dir)}/ml_ready")
    model = models.fit_named(models.MODEL_LR, ready, maxIter=5)
    path = new_folder(spark, "model")
    models.save_model(model, path)
    test = models.split(ready)[1]
    both = models.predict(model, test, "fitted").select("flow_id", "label", F.col(models.SCORE).alias("fitted"))
    again = models.predict(models.load_model(path), test, "saved").select("flow_id", models.SCORE)
    return both.join(again, "flow_id").groupBy("label").agg(
        F.count("*").alias("rows"), F.count_if(F.col(models.SCORE) == F.col("fitted")).alias("as_fitted")
    )


@query
def saved_pipeline_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capped columns of the test rows, made by a pipeline read back from its files, whose caps were
    fitted on the training rows."""
    made, pipeline = _quick_pipeline(spark, sf_dir, exact=True)
    names = features.numeric_columns(made)
    train, test = models.split(made)
    path = new_folder(spark, "pipeline")
    models.save_model(pipeline.fit(train), path)
    rows = models.load_model(path).transform(test)
    return rounded_logs(rows.select("flow_id", *_array_columns("features", names)))


@query
def fold_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fold, column, low, high): the caps that each fold of a cross validation learns from the others."""
    made = tuning.with_fold(features.engineered(stored(spark, sf_dir)))
    names = features.numeric_columns(made, ("label", "label_original", tuning.FOLD))
    rows = []
    for fold in range(tuning.FOLDS):
        caps = OutlierCaps(inputCols=names, exact=True).fit(made.filter(F.col(tuning.FOLD) != fold)).caps
        rows += [(fold, c, *bounds) for c, bounds in caps.items()]
    found = spark.createDataFrame(rows, "fold int, column string, low double, high double")
    return found.withColumns({b: F.round(b, LOG_DIGITS) for b in ("low", "high")})


@query
def validation_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fold, label, rows) of the validation parts: every row is in one, rows without a key too."""
    return tuning.with_fold(_some_null_keys(spark, sf_dir)).groupBy("fold", "label").agg(F.count("*").alias("rows"))


@query
def tuned_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fold, setting, rows, in_unit, best_mean): every setting is scored on every row once, its metrics are
    shares, and the chosen setting's mean is the largest."""
    made, pipeline = _quick_pipeline(spark, sf_dir)
    train = durable(models.split(made)[0], "training")
    grid = tuning.settings_grid(regParam=[0.0, 0.3], elasticNetParam=[0.0])
    found = tuning.cross_validate(train, pipeline, grid)
    rows = found.outcomes.groupBy("fold", F.col("model").alias("setting")).agg(F.sum("count").alias("rows"))
    shares = found.results.groupBy("fold", "setting").agg(F.count_if(F.col("value").between(0, 1)).alias("in_unit"))
    means = tuning.setting_means(found.results).agg(F.max("mean").alias("most"), F.max_by("mean", F.col("setting") == tuning.setting_name(found.best)).alias("chosen")).first()
    return rows.join(shares, ["fold", "setting"]).withColumn("best_mean", F.lit(means.most == means.chosen))


@query
def multiclass_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(class, rows, as_counted, area): test rows of each class that a multinomial model was scored on; the
    report follows from the stored counts, and areas are shares."""
    ready = tables.read_table(spark, f"{_stage_folder(spark, sf_dir)}/ml_ready")
    train, test = models.split(ready)
    index = multiclass.class_index(train)
    model = multiclass.fit_classes(train, index, multiclass.multinomial(maxIter=3))
    report, cells = multiclass.evaluate(multiclass.predict_classes(model, test, index, "multinomial"), index)
    named = multiclass.class_names(index, spark).withColumnRenamed("class", "name")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    counted = cells.join(named, cells["label"] == named[multiclass.INDEX]).groupBy("name").agg(F.sum("count").alias("n"), F.sum(hit).alias("right"))
    equal = (F.col("n") == F.col("rows")) & (F.col("right") == F.col("hits")) & (F.abs(F.col("right") / F.col("n") - F.col("recall")) < 1e-12)
    return report.join(counted, report["class"] == counted["name"]).select(
        "class", "rows", equal.alias("as_counted"), F.coalesce(F.col("auc_roc").between(0, 1), F.lit(True)).alias("area")
    )


@query
def raw_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, label, rows, as_batch): raw CSV files scored as a stream, in two lots and a restart without new
    files, by a saved pipeline; every row scores as in a table."""
    folder = new_folder(spark, "raw-stream")
    raw = flows(spark, sf_dir)
    made, pipeline = _quick_pipeline(spark, sf_dir)
    models.save_model(pipeline.fit(models.split(made)[0]), f"{folder}/model")
    model, counts = models.load_model(f"{folder}/model"), []
    batch = models.predict(model, made, "saved").select("flow_id", F.col(models.SCORE).alias("expected"))
    batch = durable(batch, "batch")  # each run is compared with it
    for run, lot in enumerate((*models.split(raw, percent=50), None), 1):
        if lot is not None:
            lot.write.mode("append").option("header", True).csv(f"{folder}/source")
        score_raw_files(spark, model, "saved", f"{folder}/source", raw.schema, f"{folder}/rows", f"{folder}/checkpoint")
        streamed = spark.read.parquet(f"{folder}/rows")
        counts.append(
            streamed.join(batch, "flow_id", "left")
            .groupBy(F.lit(run).alias("run"), "label")
            .agg(F.count("*").alias("rows"), F.count_if(F.col(models.SCORE) == F.col("expected")).alias("as_batch"))
        )
        counts[-1] = durable(counts[-1], "counts")
    return reduce(DataFrame.unionByName, counts)
