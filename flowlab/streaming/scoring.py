"""Scoring rows as they arrive, with a model that was fitted before."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from flowlab.operators.clean import clean_flows
from flowlab.operators.features import engineered
from flowlab.operators.models import predict
from flowlab.sources.tables import COMPRESSION
from flowlab.streaming.ingest import append_what_is_there, raw_files


def score_new_files(
    spark: SparkSession, model: Model, name: str, source: str, landing: str, checkpoint: str
) -> int:
    """Append predictions for the ml-ready files of ``source`` that earlier calls did not score; returns
    the batches run. Rows are scored one by one, so nothing is shuffled and no state is kept."""
    rows = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = (
        predict(model, rows, name)
        .writeStream.format("parquet")
        .option("path", landing)
        .option("compression", COMPRESSION)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len([batch for batch in query.recentProgress if batch.numInputRows])


def score_raw_files(
    spark: SparkSession,
    model: Model,
    name: str,
    source: str,
    schema: StructType,
    landing: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    **rules,
) -> int:
    """Append predictions for the raw CSV files of ``source`` that earlier calls did not score; returns the
    raw rows read.

    One plan from text to score: cleaning by ``rules`` (those of ``clean_flows``, without duplicates,
    which need all rows), derived features, and a model saved by ``models.from_features`` that caps,
    fills, assembles and classifies. All of it is row by row: nothing is shuffled and no state is kept.
    """
    cleaned = clean_flows(raw_files(spark, source, schema, files_per_batch), **rules)
    return append_what_is_there(predict(model, engineered(cleaned), name), landing, checkpoint)
