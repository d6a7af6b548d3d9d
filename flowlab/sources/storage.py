"""Shared storage: where intermediate tables go, and what is already there.

All paths go through the Hadoop FileSystem API, so the same code serves a local disk, HDFS or an
object store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, one in the warehouse."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/flowlab-scratch"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/flowlab-{uuid.uuid4().hex}/{name}"


def name_checkpoint_folder(spark: SparkSession) -> None:
    """Point Spark's own checkpoints at the shared folder, unless the session already did."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to shared storage as Parquet and read back: computed a single time, read
    column by column, and safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder from ``new_folder`` that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def complete(spark: SparkSession, path: str) -> bool:
    """True if a job finished writing ``path``; a half-written folder has no marker."""
    return exists(spark, f"{path}/_SUCCESS")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    if not exists(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file over whatever is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def mark_complete(spark: SparkSession, path: str) -> None:
    """The marker that Spark's own table writers leave, for results that are written in another way."""
    write_text(spark, f"{path}/_SUCCESS", "")


def remove_marker(spark: SparkSession, path: str) -> None:
    """Make a finished result count as unfinished before it is written anew."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, False)
