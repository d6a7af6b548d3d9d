"""Models of all original classes: an index with a defined order, a multinomial fit, and metrics of any
number of classes from stored counts.

The class index orders classes by rows, the most frequent first, names deciding ties. A class that the
index has not seen, or a missing one, gets the number after the last: it takes part in no fit, and in
the metrics it is a class that no model can name.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators import metrics
from flowlab.operators.forest import HistogramForest
from flowlab.operators.models import LR_SETTINGS, RF_EXECUTION, RF_SETTINGS, without_summary
from flowlab.sources.storage import durable, name_checkpoint_folder
from flowlab.sources.tables import dealt_once

CLASS = "label_original"
INDEX = "class_index"
UNSEEN = "(unseen)"


def class_index(df: DataFrame, column: str = CLASS) -> StringIndexerModel:
    """The fitted index from class name to number."""
    indexer = StringIndexer(inputCol=column, outputCol=INDEX, handleInvalid="keep", stringOrderType="frequencyDesc")
    return indexer.fit(df.select(column).filter(F.col(column).isNotNull()))


def class_names(index: StringIndexerModel, spark: SparkSession) -> DataFrame:
    """(class_index, class) of all known classes and of the unseen."""
    names = [*index.labels, UNSEEN]
    return spark.createDataFrame([(float(i), name) for i, name in enumerate(names)], f"{INDEX} double, class string")


def indexed(df: DataFrame, index: StringIndexerModel) -> DataFrame:
    """``df`` with ``class_index`` as a plain number: its metadata would count the unseen as a class to learn."""
    return index.transform(df).withColumn(INDEX, F.col(INDEX).alias(INDEX, metadata={}))


def multinomial(**settings) -> Estimator:
    return LogisticRegression(**{"labelCol": INDEX, "family": "multinomial", **LR_SETTINGS, **settings})


def forest(**settings) -> Estimator:
    return HistogramForest(**{"labelCol": INDEX, **RF_SETTINGS, **RF_EXECUTION, **settings})


def fit_classes(train: DataFrame, index: StringIndexerModel, estimator: Estimator, key: str = "flow_id") -> Model:
    """Fit on the rows of known classes, dealt out by key."""
    name_checkpoint_folder(train.sparkSession)
    known = indexed(train, index).filter(F.col(INDEX) < len(index.labels))
    extra = [estimator.getWeightCol()] if estimator.isSet("weightCol") else []
    with dealt_once(known, key, "features", INDEX, *extra) as rows:
        return estimator.fit(rows)


def predict_classes(model: Model, rows: DataFrame, index: StringIndexerModel, name: str) -> DataFrame:
    """(model, key columns, label, prediction, probability); ``label`` is the class number."""
    lineage = [c for c in ("flow_id", CLASS) if c in rows.columns]
    scored = without_summary(model).transform(indexed(rows, index))
    return scored.select(F.lit(name).alias("model"), *lineage, F.col(INDEX).alias("label"), "prediction", "probability")


def _as_array(df: DataFrame, column: str) -> Column:
    return vector_to_array(F.col(column)) if isinstance(df.schema[column].dataType, VectorUDT) else F.col(column)


def class_outcomes(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """(model, class, score, p, n): per class and score the rows of the class and the others.

    A row counts once for every class that has a score; equal scores are added up before the shuffle.
    Rows without a usable score of a class are left out there.
    """
    each = scored.select("model", "label", F.posexplode(_as_array(scored, probability)).alias("place", "score"))
    own = F.col("label") == F.col("place")
    usable = each.filter(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))
    return usable.groupBy("model", F.col("place").cast("double").alias("class"), "score").agg(
        F.count_if(own).alias("p"), F.count_if(~own).alias("n")
    )


def class_areas(outcomes: DataFrame) -> DataFrame:
    """(model, class, auc_roc) of each class against all others, from stored ``class_outcomes``; NULL where
    a class has no rows or all."""
    pair = F.struct("model", "class").alias("model")
    areas = metrics.area_of(outcomes.select(pair, "score", "p", "n"))
    return areas.select("model.model", "model.class", "auc_roc")


def class_report(cells: DataFrame, areas: DataFrame, names: DataFrame) -> DataFrame:
    """(model, class, rows, hits, precision, recall, f1, auc_roc) of every class that has rows, from stored
    k x k confusion counts and areas."""
    per_class = metrics.class_metrics(cells).join(areas, ["model", "class"], "left")
    named = names.select(F.col(INDEX).alias("class"), F.col("class").alias("name"))
    return per_class.join(F.broadcast(named), "class").select(  # one row per class
        "model", F.col("name").alias("class"), "rows", "hits", "precision", "recall", "f1", "auc_roc"
    )


def macro_metrics(report: DataFrame) -> DataFrame:
    """(model, classes, precision, recall, f1, auc_roc): every class weighs the same."""
    means = [F.avg(m).alias(m) for m in ("precision", "recall", "f1", "auc_roc")]
    return report.groupBy("model").agg(F.count("*").alias("classes"), *means)


def confusion_matrix(cells: DataFrame, labels: list[str]) -> DataFrame:
    """(model, actual, predicted, count) with every pair of classes, those without rows as 0."""
    names = F.array(*map(F.lit, [*labels, UNSEEN]))
    each = cells.select("model").distinct().select("model", F.posexplode(names).alias("label", "actual"))
    pairs = each.select("*", F.posexplode(F.slice(names, 1, len(labels))).alias("prediction", "predicted"))
    return pairs.join(cells, ["model", "label", "prediction"], "left").select(
        "model", "actual", "predicted", F.coalesce("count", F.lit(0)).alias("count")
    )


def evaluate(scored: DataFrame, index: StringIndexerModel, probability: str = "probability") -> tuple[DataFrame, DataFrame]:
    """(class report, stored confusion counts) of scored rows, which are stored first."""
    rows = durable(scored.select("model", "label", "prediction", probability), "classified")
    cells = durable(metrics.confusion(rows), "cells")
    areas = class_areas(durable(class_outcomes(rows, probability), "outcomes"))
    return class_report(cells, areas, class_names(index, scored.sparkSession)), cells
