"""Quantile sketches of many columns, merged in steps of bounded fan-in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 4000
ERROR = 0.0015  # of a sketch of this size, in rank
LARGEST = 65_535
#: Sketches that one task merges at each of the steps before the last. With three steps the last
#: task receives as few for up to a million scan tasks.
FAN_IN = 32
STEPS = 3
COLUMNS_PER_SKETCH = 32


def size_for(error: float) -> int | None:
    """The size whose rank error is half of ``error`` with 99 % confidence; None where no sketch is
    large enough.

    A sketch of size k errs by 2.296 / k^0.9021 in rank; twice that is passed about never.
    """
    size = max(SIZE, round((2 * 2.296 / error) ** (1 / 0.9021))) if error > 0 else LARGEST + 1
    return size if size <= LARGEST else None


def sketched_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], size: int = SIZE
) -> dict[str, list[float]]:
    """{column: value near each probability}; columns without a value are left out.

    Every task sketches its rows. Then, step by step, one task merges the sketches of ``FAN_IN``
    neighbours, so that no task receives more as the table grows in files. The task number only
    chooses who merges; any choice gives a valid sketch. Wide tables go in groups of columns, each
    a scan of its own columns.
    """
    found: dict[str, list[float]] = {}
    for i in range(0, len(columns), COLUMNS_PER_SKETCH):
        group = columns[i : i + COLUMNS_PER_SKETCH]
        part = F.floor(F.spark_partition_id() / FAN_IN).alias("_part")
        numbers = df.select(part, *(F.col(f"`{c}`").cast("double").alias(f"v{j}") for j, c in enumerate(group)))
        parts = numbers.groupBy("_part").agg(
            *(F.kll_sketch_agg_double(f"v{j}", size).alias(f"s{j}") for j in range(len(group))),
            *(F.count(f"v{j}").alias(f"n{j}") for j in range(len(group))),
        )
        merges = [
            *(F.kll_merge_agg_double(f"s{j}", size).alias(f"s{j}") for j in range(len(group))),
            *(F.sum(f"n{j}").alias(f"n{j}") for j in range(len(group))),
        ]
        further = F.floor(F.col("_part") / FAN_IN).alias("_part")
        parts = reduce(lambda some, _: some.groupBy(further).agg(*merges), range(STEPS - 1), parts)
        row = parts.agg(*merges).select(
            *(
                F.when(
                    F.col(f"n{j}") > 0,
                    F.array(*(F.kll_sketch_get_quantile_double(f"s{j}", F.lit(float(p))) for p in probabilities)),
                ).alias(f"q{j}")
                for j in range(len(group))
            )
        ).first()
        found.update((c, row[f"q{j}"]) for j, c in enumerate(group) if row[f"q{j}"] is not None)
    return found
