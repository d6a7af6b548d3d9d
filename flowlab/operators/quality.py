"""What is wrong with a table, as rows: (check, column, rows)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowlab.functions.values import cast_failed
from flowlab.operators import clean
from flowlab.operators.profile import _one_row, infinite_counts


def raw_quality(raw: DataFrame, label: str = "label", ids: Iterable[str] = clean.ID_COLUMNS) -> DataFrame:
    """Texts of measures that are no number, and rows without a label, which count as attacks."""
    failed = clean.cast_failures(raw, label, ids).select(F.lit("cast_failed").alias("check"), "column", "failed")
    unlabelled = raw.agg(F.count_if(F.col(label).isNull()).alias("rows"))
    missing = unlabelled.select(F.lit("label_missing").alias("check"), F.lit(label).alias("column"), "rows")
    return failed.withColumnRenamed("failed", "rows").unionByName(missing)


class Watch:
    """The counts of ``raw_quality``, taken while a job runs over the rows anyway.

    ``over`` adds the counts to a plan; once the plan's write is done, ``report`` has the figures. Put it
    into the stage that writes: the tasks of that stage count once, however often one is retried.
    """

    def __init__(self):
        self.observation: Observation | None = None

    def over(self, raw: DataFrame, label: str = "label", ids: Iterable[str] = clean.ID_COLUMNS) -> DataFrame:
        measures = [c for c in clean.measure_columns(raw, label, ids) if raw.schema[c].dataType.typeName() == "string"]
        self.names = [("rows", label), ("label_missing", label), *(("cast_failed", c) for c in measures)]
        counts = [
            F.count(F.lit(1)),
            F.count_if(F.col(label).isNull()),
            *(F.count_if(cast_failed(c)) for c in measures),
        ]
        self.observation = Observation()
        return raw.observe(self.observation, *(c.alias(f"c{i}") for i, c in enumerate(counts)))

    def report(self, spark: SparkSession) -> DataFrame:
        """(check, column, rows): all raw rows, rows without a label, and failed casts where there are some."""
        counted = self.observation.get
        rows = [(check, column, counted[f"c{i}"]) for i, (check, column) in enumerate(self.names)]
        kept = [r for r in rows if r[0] != "cast_failed" or r[2] > 0]
        return spark.createDataFrame(kept, "check string, column string, rows bigint")


def counted_raw(raw: DataFrame, label: str = "label", ids: Iterable[str] = clean.ID_COLUMNS) -> DataFrame:
    """What ``Watch`` reports, by scans of its own."""
    everything = raw.agg(F.lit("rows").alias("check"), F.lit(label).alias("column"), F.count("*").alias("rows"))
    return everything.unionByName(raw_quality(raw, label, ids))


def feature_quality(table: DataFrame, columns: list[str]) -> DataFrame:
    """Features without any value or with a single one, with the table's rows, and infinities."""
    stats = {
        "filled": lambda c: F.count(c),
        "all": lambda c: F.count("*"),
        "constant": lambda c: F.min(c).eqNullSafe(F.max(c)),
    }
    found = _one_row(table, columns, stats)
    empty = found.filter("filled = 0").select(F.lit("all_null").alias("check"), "column", F.col("all").alias("rows"))
    constant = found.filter("filled > 0 AND constant").select(
        F.lit("constant").alias("check"), "column", F.col("all").alias("rows")
    )
    infinite = infinite_counts(table, columns).select(
        F.lit("infinite").alias("check"), "column", F.col("infinite").alias("rows")
    )
    return empty.unionByName(constant).unionByName(infinite)


def quality_report(raw: DataFrame, engineered: DataFrame, columns: list[str], **options) -> DataFrame:
    """All checks of the raw table and of its features before gaps are filled."""
    return raw_quality(raw, **options).unionByName(feature_quality(engineered, columns))
