"""Counts, shares, null and sentinel profiles, describe, histograms: one scan per report.

A profile of many columns is one aggregate without a key: every task sends one row. The single
result row is then turned into a long table. Very wide tables are cut into groups of columns,
because generated code for thousands of aggregates in one operator passes the JVM's limits; over
Parquet the groups read disjoint columns, so no byte is read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions.keys import in_percent
from flowlab.functions.values import BENIGN, finite_or_null, is_sentinel

STATISTICS_PER_SCAN = 256
HISTOGRAM_BINS = 50
# The measures that exploration looks at, and the statistics of a description.
EXPLORED = (
    "duration",
    "packets_count",
    "fwd_packets_count",
    "bwd_packets_count",
    "bytes_rate",
    "packets_rate",
    "payload_bytes_mean",
    "fwd_payload_bytes_mean",
)
DESCRIBE = ("count", "mean", "stddev", "min", "max")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def distribution(df: DataFrame, column: str, largest_first: bool = True) -> DataFrame:
    """(column, count), largest class first or by class."""
    counts = df.groupBy(column).count()
    return counts.orderBy(F.desc("count"), column) if largest_first else counts.orderBy(column)


def class_share(df: DataFrame, column: str, without: str | None = None, digits: int = 2) -> DataFrame:
    """(column, count, percent of all counted rows); ``without`` leaves one class out first.

    The total is a window over the class counts, a handful of rows after the aggregate.
    """
    if without is not None:
        df = df.filter(F.upper(F.col(column)) != without.upper())
    counts = df.groupBy(column).count()
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(column, "count", F.round(100 * F.col("count") / total, digits).alias("percent"))


def attack_share(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    return class_share(df, column, without=BENIGN, digits=digits)


def _one_row(df: DataFrame, columns: list[str], stats: dict[str, Callable[[str], Column]]) -> DataFrame:
    """(column, one field per statistic) for all ``columns``, one aggregate per column group."""

    def scan(group: list[str]) -> DataFrame:
        row = df.agg(
            *(
                F.struct(F.lit(c).alias("column"), *(f(c).alias(s) for s, f in stats.items())).alias(
                    f"c{i}"
                )
                for i, c in enumerate(group)
            )
        )
        return row.select(F.inline(F.array(*(F.col(f"c{i}") for i in range(len(group))))))

    width = max(1, STATISTICS_PER_SCAN // len(stats))
    groups = [columns[i : i + width] for i in range(0, len(columns), width)]
    return reduce(DataFrame.unionByName, map(scan, groups))


def null_profile(df: DataFrame, columns: list[str], top: int | None = None) -> DataFrame:
    """(column, null_count), most NULLs first, columns without any left out; ``top`` keeps so many."""
    counts = _one_row(df, columns, {"null_count": lambda c: F.count_if(F.col(c).isNull())})
    ordered = counts.filter("null_count > 0").orderBy(F.desc("null_count"), "column")
    return ordered if top is None else ordered.limit(top)


def sentinel_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, sentinel_count) of raw text columns that spell infinity somewhere."""
    counts = _one_row(df, columns, {"sentinel_count": lambda c: F.count_if(is_sentinel(c))})
    return counts.filter("sentinel_count > 0")


def describe_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """(column, stat, value): count, mean, stddev, min and max of numeric columns.

    NaN takes part as Spark orders and adds it; null it first if it stands for "missing".
    """
    wide = _one_row(
        df,
        columns,
        {
            "count": lambda c: F.count(c).cast("double"),
            "mean": lambda c: F.round(F.avg(c), digits),
            "stddev": lambda c: F.round(F.stddev_samp(c), digits),
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
        },
    )
    return wide.unpivot(["column"], list(DESCRIBE), "stat", "value")


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """The same ``percent`` of rows on every run and layout, chosen by key."""
    return df.filter(in_percent(key, percent, salt="sample:"))


def estimated_distribution(df: DataFrame, column: str, key: str, percent: int = 10) -> DataFrame:
    """Class counts estimated from a hash sample: (column, sampled, estimate), largest first."""
    counts = hash_sample(df, key, percent).groupBy(column).agg(F.count("*").alias("sampled"))
    scaled = (F.col("sampled") * 100 / percent).cast("bigint")
    return counts.withColumn("estimate", scaled).orderBy(F.desc("estimate"), column)


def _present(name: str) -> Column:
    """A measure as a double, with NaN and infinities counted as missing; see ``infinite_counts``."""
    return finite_or_null(F.col(name).cast("double"))


def infinite_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, infinite) of the columns with infinities, which no range or scaled value includes."""
    infinite = lambda c: F.count_if(F.abs(F.col(c).cast("double")) == float("inf"))
    return _one_row(df, columns, {"infinite": infinite}).filter("infinite > 0")


def fit_ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest finite value per column, on the driver: two numbers each."""
    rows = _one_row(
        df,
        columns,
        {"low": lambda c: F.min(_present(c)), "high": lambda c: F.max(_present(c))},
    )
    return {r["column"]: (r["low"], r["high"]) for r in rows.collect() if r["low"] is not None}


def minmax_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every column mapped to [0, 1] by its own range; a constant column becomes 0.0.

    The ranges enter the plan as literals, so the mapping itself is a narrow projection.
    """
    ranges = fit_ranges(df, columns)

    def scaled(name: str) -> Column:
        low, high = ranges.get(name, (0.0, 0.0))
        if not high > low:
            return F.lit(0.0)
        return (_present(name) - F.lit(low)) / F.lit(high - low)

    return df.withColumns({c: scaled(c) for c in columns})


def minmax_class_means(df: DataFrame, label: str, columns: list[str], digits: int = 6) -> DataFrame:
    """(label, mean of each column after mapping it to [0, 1]), in one scan.

    The mapping is linear, so the mean of mapped values is the mapped mean: class means and
    extremes come from one aggregate, and the overall range from its few class rows.
    """
    stats = {"avg": F.avg, "lo": F.min, "hi": F.max}
    per_class = df.groupBy(label).agg(
        *(f(_present(c)).alias(f"{s}_{c}") for c in columns for s, f in stats.items())
    )
    everywhere = Window.partitionBy()

    def mean(name: str) -> Column:
        low = F.min(f"lo_{name}").over(everywhere)
        high = F.max(f"hi_{name}").over(everywhere)
        scaled = (F.col(f"avg_{name}") - low) / (high - low)
        return F.round(F.when(high > low, scaled).otherwise(F.lit(0.0)), digits).alias(name)

    return per_class.select(label, *map(mean, columns))


def log_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value): log(1 + x) of the positive values of each column."""
    long = df.select(*(_present(c).alias(c) for c in columns)).unpivot([], columns, "feature", "x")
    return long.filter("x > 0").select("feature", F.log1p("x").alias("value"))


def log_histogram(df: DataFrame, columns: list[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(feature, bin, count): equal-width bins of ``log_values``, empty bins with 0.

    The ranges are fitted first and enter as literals. log(1 + x) grows with x, so the range of
    the logs follows from the smallest and largest positive value.
    """
    positive = df.select(*(F.when(F.col(c) > 0, _present(c)).alias(c) for c in columns))
    ranges = fit_ranges(positive, columns)
    if not ranges:
        return df.sparkSession.createDataFrame([], "feature string, bin int, count bigint")

    def slot(name: str) -> Column:
        low, high = ranges[name]
        if low == high:  # a single value sits in the middle of its plot
            return F.when(F.col(name).isNotNull(), F.lit(bins // 2)).alias(name)
        start, end = F.log1p(F.lit(low)), F.log1p(F.lit(high))
        position = F.floor((F.log1p(name) - start) / (end - start) * bins)
        last = F.when(position >= bins, F.lit(bins - 1)).otherwise(position)
        return last.cast("int").alias(name)

    counted = (
        positive.select(*map(slot, ranges))
        .unpivot([], list(ranges), "feature", "bin")
        .filter("bin IS NOT NULL")
        .groupBy("feature")
        .pivot("bin", list(range(bins)))
        .count()
        .na.fill(0)
    )
    slots = F.array(*(F.col(f"`{i}`") for i in range(bins)))
    return counted.select("feature", F.posexplode(slots).alias("bin", "count"))


def _against_previous(counts: DataFrame) -> DataFrame:
    before = F.lag("rows").over(Window.partitionBy().orderBy("position"))  # one row per stage
    return counts.withColumn("removed", before - F.col("rows")).withColumn(
        "removed_percent", F.round(F.when(before > 0, 100 * F.col("removed") / before), 4)
    )


def reconcile(stages: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """(position, stage, rows, removed, removed_percent), each stage against the one before.

    For stored stages, whose rows come from Parquet footers.
    """
    counts = [
        row_count(df).select(F.lit(i).alias("position"), F.lit(name).alias("stage"), "rows")
        for i, (name, df) in enumerate(stages)
    ]
    return _against_previous(reduce(DataFrame.unionByName, counts))


def reconcile_rules(df: DataFrame, stages: Iterable[tuple[str, Column]]) -> DataFrame:
    """As ``reconcile``, for stages that are rules about the rows of one table: one scan of it."""
    named = list(stages)
    row = df.agg(
        *(
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("stage"), F.count_if(rule).alias("rows")).alias(f"s{i}")
            for i, (name, rule) in enumerate(named)
        )
    )
    return _against_previous(row.select(F.inline(F.array(*(f"s{i}" for i in range(len(named)))))))
