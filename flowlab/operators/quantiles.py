"""Per-column quantiles of wide tables, approximate in one scan or exact in three."""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions.values import not_nan
from flowlab.operators.ranking import cut_points, default_buckets, running_totals
from flowlab.operators.sketches import ERROR, size_for, sketched_quantiles
from flowlab.sources.storage import durable

BRACKETS_PER_SCAN = 32
EVERYTHING = (float("-inf"), float("inf"))


def approximate_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], rel_error: float = 0.001
) -> dict[str, list[float]]:
    """{column: values}; NULL and NaN are left out, and an empty column gives an empty list.

    The error must be smaller than the distance of every probability from 0 and 1: at or above
    it, the sketch may answer with the minimum or the maximum, and capping there caps nothing.
    Columns are sketched in groups, so what a merge holds does not grow with the table's width.
    A column with fewer rows than the sketch's size is answered exactly; beyond that, another run
    may answer with another value inside the error. An error that no sketch keeps, 0 among them, is
    kept by exact quantiles, in three scans.
    """
    check_error(probabilities, rel_error)
    size = size_for(rel_error)
    if size is None:
        rows = exact_quantiles(df, columns, probabilities).collect()
        at = {(r["column"], r["probability"]): r["value"] for r in rows}
        return {c: [at[c, p] for p in probabilities if (c, p) in at] for c in columns}
    values = df.select(*(not_nan(F.col(c).cast("double")).alias(c) for c in columns))
    found = sketched_quantiles(values, columns, probabilities, size)
    return {c: found.get(c, []) for c in columns}


def check_error(probabilities: list[float], rel_error: float) -> None:
    inner = [min(p, 1 - p) for p in probabilities if 0 < p < 1]
    if inner and rel_error >= min(inner):
        raise ValueError(f"rel_error {rel_error} must be below {min(inner)}, the outermost probability")


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """(column, probability, value): the smallest value that p of the column's rows do not exceed.

    Scan 1 sketches a bracket around each quantile. Scan 2 counts the rows below and inside each
    bracket, which proves the bracket or opens it, so the result never rests on the sketch. Scan
    3 counts the distinct values inside, under one percent of the rows, and a running total finds
    the value at the wanted rank. No column is ever sorted or collected as a whole. NULL and NaN
    are left out.
    """
    spark = df.sparkSession
    empty = "column string, probability double, value double"
    values = df.select(*(not_nan(F.col(c).cast("double")).alias(c) for c in columns))
    targets = _ranked_brackets(values, columns, probabilities)
    if not targets:
        return spark.createDataFrame([], empty)

    entries = list(targets.items())
    groups = [entries[i : i + BRACKETS_PER_SCAN] for i in range(0, len(entries), BRACKETS_PER_SCAN)]
    inside = durable(reduce(DataFrame.union, (_inside(values, group) for group in groups)), "inside")
    cuts = cut_points(inside, "value", default_buckets(inside))
    ranked = running_totals(inside, ["column", "probability"], "value", ["n"], cuts)
    wanted = spark.createDataFrame(
        [(c, p, rank) for (c, p), (_, _, rank) in targets.items()],
        "column string, probability double, rank bigint",
    )
    return (
        ranked.join(wanted, ["column", "probability"])
        .filter("n_so_far >= rank")
        .groupBy("column", "probability")
        .agg(F.min("value").alias("value"))
    )


def _inside(values: DataFrame, targets: list) -> DataFrame:
    """(column, probability, value, n): how often each value lies in a bracket of its column.

    Each group of brackets is a scan of its own columns and an expression of bounded size.
    """
    hits = (
        F.when(
            F.col(c).between(lo, hi),
            F.struct(F.lit(c).alias("column"), F.lit(p).alias("probability"), F.col(c).alias("value")),
        )
        for (c, p), (lo, hi, _) in targets
    )
    rows = values.select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
    return rows.groupBy("hit").agg(F.count("*").alias("n")).select("hit.*", "n")


def _ranked_brackets(
    values: DataFrame, columns: list[str], probabilities: list[float]
) -> dict[tuple[str, float], tuple[float, float, int]]:
    """{(column, p): (low, high, rank inside [low, high])}, three numbers per entry on the driver."""
    around = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-2 * ERROR, 2 * ERROR)]
    brackets = {
        (c, p): (cuts[2 * j], cuts[2 * j + 1])
        for c, cuts in sketched_quantiles(values, columns, around).items()
        for j, p in enumerate(probabilities)
    }
    ranked = {}
    entries = list(brackets.items())
    for start in range(0, len(entries), BRACKETS_PER_SCAN):
        group = entries[start : start + BRACKETS_PER_SCAN]
        counted = values.agg(
            *(F.count(c).alias(f"n_{c}") for c in dict.fromkeys(c for (c, _), _ in group)),
            *(F.count_if(F.col(c) < lo).alias(f"below_{i}") for i, ((c, _), (lo, _)) in enumerate(group)),
            *(F.count_if(F.col(c) <= hi).alias(f"upto_{i}") for i, ((c, _), (_, hi)) in enumerate(group)),
        ).first()
        for i, ((c, p), bracket) in enumerate(group):
            wanted = max(1, int((Decimal(str(p)) * counted[f"n_{c}"]).to_integral_value(ROUND_CEILING)))
            if counted[f"below_{i}"] < wanted <= counted[f"upto_{i}"]:
                ranked[c, p] = (*bracket, wanted - counted[f"below_{i}"])
            else:
                ranked[c, p] = (*EVERYTHING, wanted)
    return ranked
