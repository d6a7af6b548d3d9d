"""Parquet tables: scans, unions of directories, tolerant scans, and overwrites."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, paths: str | Iterable[str], columns: list[str] | None = None) -> DataFrame:
    """One or several Parquet directories as one table; only ``columns`` are read from disk."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, bool]:
    """(table, True), or an empty table of ``schema`` and False where the path does not exist.

    Only a missing path is tolerated; an unreadable file still fails.
    """
    try:
        return spark.read.parquet(path), True
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema), False


#: How tables are stored: doubles and keys take a quarter less room than by Spark's default, in the same time.
COMPRESSION = "zstd"

#: Rows of a partition that an estimator passes over, as long as there are partitions for it.
DEALT_ROWS = 1 << 14


def _clustered(df: DataFrame, by: list[str]) -> DataFrame:
    return df.hint("rebalance", *by) if by else df


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Overwrite ``path``. With ``partition_by``, rows are first brought together by these columns, in
    partitions of an even size: few files per directory, and several for a large one."""
    by = list(partition_by)
    _clustered(df, by).write.mode("overwrite").partitionBy(*by).parquet(path, compression=COMPRESSION)


def replace_partitions(df: DataFrame, path: str, partition_by: Iterable[str], gather: bool = True) -> None:
    """Overwrite the partitions of ``path`` that ``df`` has rows for, and leave the files of all others; a
    partition without new rows stays as it is. ``gather=False`` writes rows where they are, without a
    shuffle: for rows of one partition, or of few."""
    by = list(partition_by)
    rows = _clustered(df, by) if gather else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path, compression=COMPRESSION)


def files_of(df: DataFrame) -> list[str]:
    """The files that rows of a scan come from; partitions that a filter excludes are not read."""
    return sorted(r.file for r in df.select(F.col("_metadata.file_path").alias("file")).distinct().collect())


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out by key to even partitions: one per ``DEALT_ROWS`` rows, and at most
    ``spark.sql.shuffle.partitions``.

    For a table that is about to be worked on many times: its layout then depends on its rows and
    that setting, and neither on the files it came in nor on the number of cores. Each pass of an
    estimator pays for every partition, so tiny ones cost more than their rows, and few large ones leave
    cores without work.
    """
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(most, -(-df.count() // DEALT_ROWS))), key)


@contextmanager
def dealt_once(df: DataFrame, key: str, *columns: str) -> Iterator[DataFrame]:
    """``dealt`` rows (of ``columns``, or all) that are kept while the block runs. An estimator plans its input
    anew for class counts, iterations and training summary, and each plan would shuffle the table again.

    They are kept batch by batch: in serialized form, a partition that was moved to disk comes back as one
    array of its whole length, for which a full heap has no room."""
    rows = dealt(df, key).select(*(columns or df.columns)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        yield rows
    finally:
        rows.unpersist()
