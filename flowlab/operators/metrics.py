"""Comparing any number of scored models in one pass, grouped by a ``model`` column.

A scored table has ``model, label, prediction`` and a score for the positive class. Everything
but the ROC curve comes from the confusion counts: four rows per model after one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators.ranking import cut_points, default_buckets, running_totals
from flowlab.sources.storage import durable

# The names and the order of the reported metrics.
METRICS = ("accuracy", "precision", "recall", "f1", "auc_roc")


def confusion(scored: DataFrame) -> DataFrame:
    """(model, label, prediction, count); cells without rows are absent."""
    return scored.groupBy(
        "model", F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")
    ).count()


def confusion_dense(cells: DataFrame) -> DataFrame:
    """(model, tn, fp, fn, tp), an absent cell as 0."""

    def cell(label: float, prediction: float) -> Column:
        hit = (F.col("label") == label) & (F.col("prediction") == prediction)
        return F.sum(F.when(hit, F.col("count")).otherwise(0))

    return cells.groupBy("model").agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_normalised(cells: DataFrame) -> DataFrame:
    """Adds ``share``: each cell divided by the model's largest cell."""
    largest = F.max("count").over(Window.partitionBy("model"))
    return cells.withColumn("share", F.col("count") / largest)


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def class_metrics(cells: DataFrame) -> DataFrame:
    """(model, class, rows, hits, precision, recall, f1) of every class that has rows."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    nothing = F.lit(0).cast("bigint")
    as_actual = F.struct(F.col("label").alias("class"), F.col("count").alias("rows"), hit.alias("hits"), nothing.alias("predicted"))
    as_predicted = F.struct(F.col("prediction").alias("class"), nothing.alias("rows"), nothing.alias("hits"), F.col("count").alias("predicted"))
    per_class = (
        cells.select("model", F.inline(F.array(as_actual, as_predicted)))
        .groupBy("model", "class")
        .agg(F.sum("rows").alias("rows"), F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted"))
        .filter("rows > 0")
    )
    return (
        per_class.withColumn("precision", _or_zero(F.col("hits"), F.col("predicted")))
        .withColumn("recall", F.col("hits") / F.col("rows"))
        .withColumn(
            "f1",
            _or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
        .drop("predicted")
    )


def weighted_metrics(cells: DataFrame) -> DataFrame:
    """(model, accuracy, precision, recall, f1), per-class values weighted by class rows.

    Weighted recall is the accuracy: the class weights cancel.
    """
    total = F.sum("rows")
    return class_metrics(cells).groupBy("model").agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("rows")) / total).alias("precision"),
        (F.sum("hits") / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("rows")) / total).alias("f1"),
    )


def _usable(score: str) -> Column:
    """The score, or NULL where it is NULL or NaN: no threshold can place such a row."""
    value = F.col(score)
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), value)


def score_coverage(scored: DataFrame, score: str) -> DataFrame:
    """(model, rows, scored, null_scores, nan_scores): the rows that curve and area rest on, and the
    others, which only the confusion counts include."""
    value = F.col(score)
    return scored.groupBy("model").agg(
        F.count("*").alias("rows"),
        F.count(_usable(score)).alias("scored"),
        F.count_if(value.isNull()).alias("null_scores"),
        F.count_if(F.isnan(value.cast("double"))).alias("nan_scores"),
    )


def outcome_counts(scored: DataFrame, score: str) -> DataFrame:
    """(model, label, prediction, score, count): all that the metrics need to know of the rows.

    One scan and one shuffle; hot scores are added up before it. Confusion counts and score counts
    are sums of these rows.
    """
    return (
        scored.groupBy(
            "model",
            F.col("label").cast("double").alias("label"),
            F.col("prediction").cast("double").alias("prediction"),
            _usable(score).alias("score"),
        )
        .count()
    )


def confusion_of(outcomes: DataFrame) -> DataFrame:
    """(model, label, prediction, count) from ``outcome_counts``."""
    return outcomes.groupBy("model", "label", "prediction").agg(F.sum("count").alias("count"))


def score_counts_of(outcomes: DataFrame) -> DataFrame:
    """(model, score, p, n) from ``outcome_counts``; rows without a usable score are left out."""
    positive = F.col("label") > 0.5
    return (
        outcomes.filter(F.col("score").isNotNull())
        .groupBy("model", "score")
        .agg(
            F.sum(F.when(positive, F.col("count")).otherwise(0)).alias("p"),
            F.sum(F.when(~positive, F.col("count")).otherwise(0)).alias("n"),
        )
    )


def score_counts(scored: DataFrame, score: str) -> DataFrame:
    """(model, score, p, n): positives and negatives at each score, equal scores in one row.

    Rows without a score, NULL or NaN, are left out; ``score_coverage`` counts them. Curve and area
    read this several times, so they store it first: the scored table, which may still have to be
    scored, is scanned and shuffled once.
    """
    positive = F.col("label") > 0.5
    return (
        scored.withColumn("_usable", _usable(score))
        .filter("_usable IS NOT NULL")
        .groupBy("model", F.col("_usable").alias("score"))
        .agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"))
    )


def _ranked(counts: DataFrame, peek: list[str] | None = None) -> DataFrame:
    cuts = cut_points(counts, "score", default_buckets(counts))
    return running_totals(counts, ["model"], "score", ["p", "n"], cuts, descending=True, peek=peek)


def roc_points(scored: DataFrame, score: str, drop_collinear: bool = True) -> DataFrame:
    """(model, score, tp, fp, tpr, fpr) from the highest score down, after a (0, 0) point.

    With ``drop_collinear`` a point whose next step repeats its own is left out, first and last
    point excepted: the curve and its area stay the same. The start point has no score. A rate
    over an absent class is NULL.
    """
    counts = durable(score_counts(scored, score), "scores")
    ranked = _ranked(counts, ["p", "n"]).withColumnsRenamed({"p_so_far": "tp", "n_so_far": "fp"})
    if drop_collinear:
        first = (F.col("tp") == F.col("p")) & (F.col("fp") == F.col("n"))
        last = F.col("p_next").isNull()
        bends = (F.col("p_next") != F.col("p")) | (F.col("n_next") != F.col("n"))
        ranked = ranked.filter(first | last | bends)
    totals = counts.groupBy("model").agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"))
    zero = F.lit(0).cast("bigint")
    start = totals.select(
        "model", F.lit(None).cast(ranked.schema["score"].dataType).alias("score"), zero.alias("tp"), zero.alias("fp")
    )
    points = ranked.select("model", "score", "tp", "fp").unionByName(start).join(totals, "model")
    return points.select(
        "model",
        "score",
        "tp",
        "fp",
        F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).alias("tpr"),
        F.when(F.col("negatives") > 0, F.col("fp") / F.col("negatives")).alias("fpr"),
    )


def auc_exact(scored: DataFrame, score: str) -> DataFrame:
    """(model, auc_roc): area under the full ROC curve by trapezoids, ties counted half.

    The doubled area is summed in whole numbers, as decimals: with 10^12 rows it passes a
    bigint. NULL where a model saw one class only.
    """
    return area_of(durable(score_counts(scored, score), "scores"))


def area_of(counts: DataFrame) -> DataFrame:
    """(model, auc_roc) from stored score counts."""
    whole = "decimal(19,0)"
    doubled = F.col("n").cast(whole) * (2 * F.col("p_so_far") - F.col("p")).cast(whole)
    sums = _ranked(counts).groupBy("model").agg(
        F.sum(doubled).alias("area"), F.sum("p").alias("p"), F.sum("n").alias("n")
    )
    square = 2.0 * F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select("model", F.when(square > 0, F.col("area").cast("double") / square).alias("auc_roc"))


def auc_binned(scored: DataFrame, score: str, bins: int = 1000) -> DataFrame:
    """(model, auc_binned): area under the curve thinned to about ``bins`` points, for all models at once.

    Of every ceil(distinct scores / bins) neighbouring scores one point stays, the last of them. The curve
    between two points is a straight line, so the area is a little off where it bends. Which points stay
    depends on the scores alone. NULL where a model saw one class only.
    """
    counts = durable(score_counts(scored, score).withColumn("place", F.lit(1).cast("bigint")), "scores")
    cuts = cut_points(counts, "score", default_buckets(counts))
    ranked = running_totals(counts, ["model"], "score", ["p", "n", "place"], cuts, descending=True)
    totals = counts.groupBy("model").agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"), F.count("*").alias("scores"))
    placed = ranked.join(totals, "model")
    last = F.col("place_so_far") == F.col("scores")
    kept = placed.filter(last | (F.col("place_so_far") % F.ceil(F.col("scores") / bins) == 0))
    before = Window.partitionBy("model").orderBy("place_so_far")  # as many rows as there are bins

    def earlier(total: str) -> Column:
        return F.lag(total, 1, 0).over(before)

    steps = kept.select(
        "model",
        "positives",
        "negatives",
        (F.col("n_so_far") - earlier("n_so_far")).alias("across"),
        (F.col("p_so_far") + earlier("p_so_far")).alias("up"),
    )
    whole = "decimal(19,0)"
    square = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    doubled = F.sum(F.col("across").cast(whole) * F.col("up").cast(whole)).cast("double")
    areas = steps.groupBy("model", "positives", "negatives").agg(doubled.alias("area"))
    return areas.select("model", F.when(square > 0, F.col("area") / square).alias("auc_binned"))


def metrics_long(scored: DataFrame, score: str) -> DataFrame:
    """(model, metric, value) with all of ``METRICS`` for every model, from one scan of the rows."""
    return metrics_of(durable(outcome_counts(scored, score), "outcomes"))


def metrics_of(outcomes: DataFrame) -> DataFrame:
    """(model, metric, value) from stored ``outcome_counts``."""
    four = [m for m in METRICS if m != "auc_roc"]
    weighted = weighted_metrics(confusion_of(outcomes)).unpivot(["model"], four, "metric", "value")
    area = area_of(durable(score_counts_of(outcomes), "scores"))
    return weighted.unionByName(area.select("model", F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value")))


def metrics_wide(metrics: DataFrame, digits: int | None = None) -> DataFrame:
    """One row per model, the metrics as columns in their usual order."""
    wide = metrics.groupBy("model").pivot("metric", list(METRICS)).agg(F.first("value"))
    return wide if digits is None else wide.select("model", *(F.round(m, digits).alias(m) for m in METRICS))


def best_model(metrics: DataFrame, metric: str = "f1") -> DataFrame:
    """(model, value) of the model with the largest metric; the first name on a tie."""
    return metrics.filter(F.col("metric") == metric).orderBy(F.desc("value"), "model").limit(1).select("model", "value")


def best_per_metric(metrics: DataFrame) -> DataFrame:
    """(metric, model, value): the best model of each metric, all of them on a tie."""
    place = F.rank().over(Window.partitionBy("metric").orderBy(F.desc("value")))
    return metrics.withColumn("_place", place).filter("_place = 1").select("metric", "model", "value")


def metric_delta(metrics: DataFrame, baseline: str) -> DataFrame:
    """(model, metric, value, baseline, change) against the stored values of ``baseline``."""
    of_baseline = F.max(F.when(F.col("model") == baseline, F.col("value"))).over(Window.partitionBy("metric"))
    return metrics.withColumn("baseline", of_baseline).withColumn("change", F.col("value") - F.col("baseline"))


def model_counts(scored: DataFrame) -> DataFrame:
    """(models, rows_per_model): how many models, and the rows each was scored on."""
    per_model = scored.groupBy("model").count()
    return per_model.agg(F.count("*").alias("models"), F.max("count").alias("rows_per_model"))


def short_name(model: Column) -> Column:
    """The model's name without the leading word."""
    return F.regexp_replace(model, "Model ", "")


def slug(model: Column) -> Column:
    """The model's name as a file name: lower case, blanks to underscores, no hyphens."""
    return F.replace(F.replace(F.lower(model), F.lit(" "), F.lit("_")), F.lit("-"), F.lit(""))


def recall_by_class(scored: DataFrame, original: str = "label_original") -> DataFrame:
    """(model, class, rows, found, recall): the share of each original class that was called right."""
    right = F.col("label").cast("double") == F.col("prediction").cast("double")
    return (
        scored.groupBy("model", F.col(original).alias("class"))
        .agg(F.count("*").alias("rows"), F.count_if(right).alias("found"))
        .withColumn("recall", F.col("found") / F.col("rows"))
    )
