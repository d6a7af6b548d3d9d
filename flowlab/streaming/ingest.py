"""Incremental ingest: only files not seen before, remembered by a streaming checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flowlab.settings import SETTINGS
from flowlab.sources.tables import COMPRESSION

#: Progress reports that a query keeps, one per batch.
PROGRESS_SETTING = "spark.sql.streaming.numRecentProgressUpdates"
MOST_BATCHES = 1_000_000
#: The one plan from text to score makes a method that the JVM would interpret row by row.
METHOD_SETTING = "spark.sql.codegen.hugeMethodLimit"


def raw_files(
    spark: SparkSession, source: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """The CSV files of ``source`` as a stream. A file whose header is not the schema's fails it."""
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(source)


def append_what_is_there(rows: DataFrame, landing: str, checkpoint: str) -> int:
    """Run a stream of files into Parquet until it has seen all that is there; returns the rows read.

    The file sink's log makes the landing exactly-once when a call is cut short and repeated. Rows are
    counted by the query's own progress, so a call costs nothing for what landed before.
    """
    spark = rows.sparkSession
    kept = {name: spark.conf.get(name) for name in (PROGRESS_SETTING, METHOD_SETTING)}
    spark.conf.set(PROGRESS_SETTING, str(MOST_BATCHES))
    spark.conf.set(METHOD_SETTING, str(min(int(kept[METHOD_SETTING]), int(SETTINGS[METHOD_SETTING]))))
    try:
        query = (
            rows.writeStream.format("parquet")
            .option("path", landing)
            .option("compression", COMPRESSION)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sum(batch.numInputRows for batch in query.recentProgress)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    landing: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Append the CSV files of ``source`` that earlier calls did not land; returns the rows added.

    A call processes what is there and stops. ``files_per_batch`` bounds one batch of a long backlog.
    A file whose header is not the schema's, in its order, fails the call.
    """
    return append_what_is_there(raw_files(spark, source, schema, files_per_batch), landing, checkpoint)
