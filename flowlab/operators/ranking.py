"""Running totals over a global order without sorting everything in one task.

A window ordered over a whole table puts every row into one task. Here the order column is cut
into ranges of about equal row counts; each range is summed on its own, and the totals of the
ranges before it (a few rows) are added. The cut points only steer the balance: any cut points
give the same result, so neither a retried task nor another file layout can change it.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators.sketches import LARGEST, SIZE, sketched_quantiles

BUCKET = "_bucket"


def default_buckets(df: DataFrame) -> int:
    """Two ranges per shuffle partition keep the partitions even, however many there are."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, column: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` increasing values that split ``column`` into even row counts.

    One scan of one column. A value that fills several ranges appears once.
    """
    if buckets < 2:
        return []
    steps = [i / buckets for i in range(1, buckets)]
    size = min(LARGEST, max(SIZE, 4 * buckets))  # several steps of the sketch per range
    return sorted(set(sketched_quantiles(df, [column], steps, size).get(column, [])))


def with_bucket(df: DataFrame, column: str, cuts: list[float]) -> DataFrame:
    """Adds the number of the range that ``column`` falls into."""
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0.0))
    splits = [float("-inf"), *(c for c in cuts if abs(c) != float("inf")), float("inf")]
    if len(splits) < 3:
        return df.withColumn(BUCKET, F.lit(0.0))
    place = Bucketizer(splits=splits, inputCol="_order", outputCol=BUCKET)
    return place.transform(df.withColumn("_order", F.col(column).cast("double"))).drop("_order")


def running_totals(
    df: DataFrame,
    groups: list[str],
    order: str,
    totals: list[str],
    cuts: list[float],
    descending: bool = False,
    peek: list[str] | None = None,
) -> DataFrame:
    """Adds ``<t>_so_far`` for every t in ``totals``: its inclusive running sum along ``order``.

    ``order`` must be unique within a group (aggregate equal values first, which also takes the
    weight out of a hot value). ``peek`` columns also get ``<p>_next``, the next row's value.
    The shuffles are by (groups, range); join and window share one.
    """
    peek = peek or []
    keys = [*groups, BUCKET]

    def along(column: str) -> Column:
        return F.desc(column) if descending else F.asc(column)

    placed = with_bucket(df, order, cuts)
    first = F.min_by if not descending else F.max_by
    per_range = placed.groupBy(*keys).agg(
        *(F.sum(t).alias(t) for t in totals),
        *(first(F.col(p), F.col(order)).alias(f"_first_{p}") for p in peek),
    )
    ranges = Window.partitionBy(*groups).orderBy(along(BUCKET))
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys,
        *(F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_before_{t}") for t in totals),
        *(F.lead(f"_first_{p}").over(ranges).alias(f"_after_{p}") for p in peek),
    )
    inside = Window.partitionBy(*keys).orderBy(along(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.join(offsets, keys).select(
        *(F.col(c) for c in df.columns),
        *((F.col(f"_before_{t}") + F.sum(t).over(upto)).alias(f"{t}_so_far") for t in totals),
        *(F.coalesce(F.lead(p).over(inside), F.col(f"_after_{p}")).alias(f"{p}_next") for p in peek),
    )
