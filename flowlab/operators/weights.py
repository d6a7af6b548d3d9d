"""Class weights against imbalance: every class weighs the same in total, whatever its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHT = "class_weight"
#: More classes than this are no classes; their weights would not fit into an expression.
MOST_CLASSES = 10_000


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, rows, weight), weight = N / (k * rows of the class), from one aggregate.

    The weights of all rows add up to N. A missing label is a class of its own.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("rows"))
    everything = Window.partitionBy()  # one row per class
    weight = F.sum("rows").over(everything) / (F.count("*").over(everything) * F.col("rows"))
    return counts.select("label", "rows", weight.alias("weight"))


def weight_of(weights: DataFrame, label: str = "label") -> Column:
    """The weight of each row's class as an expression; a class without a weight gets 1.0.

    The few weights become literals, so weighting a table or a stream needs no join.
    """
    found = weights.select("label", "weight").limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    pairs = [part for r in found if r.label is not None for part in (F.lit(r.label), F.lit(r.weight))]
    known = F.create_map(*pairs)[F.col(label)] if pairs else F.lit(None).cast("double")
    missing = next((r.weight for r in found if r.label is None), 1.0)
    return F.when(F.col(label).isNull(), F.lit(missing)).otherwise(F.coalesce(known, F.lit(1.0)))


def with_class_weights(df: DataFrame, label: str = "label", fitted_on: DataFrame | None = None) -> DataFrame:
    """``df`` with ``class_weight``; the weights come from ``fitted_on`` (say the training rows) or ``df``."""
    weights = class_weights(df if fitted_on is None else fitted_on, label)
    return df.withColumn(WEIGHT, weight_of(weights, label))


def weighted_confusion(scored: DataFrame, weight: str = WEIGHT) -> DataFrame:
    """(model, label, prediction, count, weight): rows and their total weight per cell."""
    return scored.groupBy(
        "model", F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")
    ).agg(F.count("*").alias("count"), F.sum(weight).alias("weight"))
