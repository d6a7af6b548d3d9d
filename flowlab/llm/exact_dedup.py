"""Exact deduplication as a stateful stream, in DataFrame functions only.

1. Rows are admitted to a content store (Parquet): digest, identifier, text and ``place``, a number
   that locates the row in the store.
2. A stream reads the store. Its state, kept on disk by RocksDB and never expired, holds per digest
   the number of rows seen and, of the row that stays, the stable identifier and the content
   locator. The stream's checkpoint and its updates lie in the shared folder: a stopped run goes on
   with the files it has not seen, and files added later meet the old state.
3. On hits (digests seen more than once) the full bytes are compared. Texts that share a digest but
   not all bytes are told apart, so the result is exact with any digest function.

Of equal texts the row with the largest identifier stays; of several rows with that identifier, the
one with the largest place. A null identifier is smaller than any other. A null text equals an
empty one. Other columns do not matter and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm.common import join_narrow, text_or_empty, whole_row
from flowlab.sources.storage import durable, exists, new_folder

#: State lies on disk: its buffers share a bounded memory in each executor, and no disk is allocated in
#: advance, so that small state takes little.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}

#: Hits are first narrowed by a table of this many slots. A slot without a repeated digest shows
#: that a text is unique, and its bytes need not move; full slots only cost a wider shuffle.
SLOTS = 2**20


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def admit(
    docs: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    with_rows: bool = False,
) -> None:
    """Append ``docs`` to the content store in ``folder``; with_rows keeps all their columns, the text as
    one of them."""
    text = text_or_empty(text_col)
    spark, first = docs.sparkSession, 0
    if exists(spark, f"{folder}/content"):
        last = content(spark, folder).agg(F.max("place")).first()[0]
        first = 0 if last is None else last + 1
    stored = docs.select(
        F.col(id_col).alias("id"),
        digest(text).alias("digest"),
        (F.monotonically_increasing_id() + first).alias("place"),
        whole_row(docs).alias("row") if with_rows else text.alias("text"),
    )
    stored.write.mode("append").parquet(f"{folder}/content")


def content(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/content")


def texts_in(stored: DataFrame, text_col: str) -> DataFrame:
    """(id, place, digest, text) of a content store, whether it keeps texts alone or whole rows."""
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")) if "row" in stored.columns else F.col("text")
    return stored.select("id", "place", "digest", text.alias("text"))


def track(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> None:
    """Run the stream over all files that the content store has and the state has not seen."""
    schema = content(spark, folder).schema
    seen = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/content")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "place")).alias("kept"), F.count("*").alias("size"))
    )

    def store(updates: DataFrame, batch: int) -> None:
        updates.write.mode("overwrite").parquet(f"{folder}/updates/batch={batch}")

    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        query = (
            seen.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/state")
            .foreachBatch(store)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    query.awaitTermination()


def groups(spark: SparkSession, folder: str) -> DataFrame:
    """The state per digest as the stream last reported it: sizes and kept rows only ever grow."""
    updates = spark.read.parquet(f"{folder}/updates")
    return updates.groupBy("digest").agg(F.max("kept").alias("kept"), F.max("size").alias("size"))


def _texts_of_hits(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """(digest, text, kept, size) of all texts whose digest was seen more than once.

    Grouping compares the full bytes. Equal texts are first added up within each task, so a hot text
    crosses the network once per task.
    """
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS)).alias("slot")
    marked = seen.filter("size > 1").select(slot).distinct()
    return (
        rows.select("*", slot)
        .join(F.broadcast(marked), "slot", "left_semi")  # at most SLOTS rows of 8 bytes
        .groupBy("digest", "text")
        .agg(F.max(F.struct("id", "place")).alias("kept"), F.count("*").alias("size"))
    )


def resolve(spark: SparkSession, folder: str, text_col: str = "text") -> DataFrame:
    """One row per admitted row: id, place, digest, keep_id, group_size, kept."""
    rows = texts_in(content(spark, folder), text_col)
    seen = durable(groups(spark, folder), "groups")
    texts = _texts_of_hits(rows, seen)
    parts = texts.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1")
    split = durable(parts.select("digest"), "split")
    whole = rows.select("id", "place", "digest").join(seen, "digest")
    if not split.isEmpty():
        # digests that several texts share: their rows are grouped by the texts themselves
        apart = texts.join(split, "digest", "left_semi")
        mixed = rows.join(split, "digest", "left_semi").join(apart, ["digest", "text"])
        whole = whole.join(split, "digest", "left_anti").unionByName(mixed.drop("text"))
    return whole.select(
        "id",
        "place",
        "digest",
        F.col("kept.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("place") == F.col("kept.place")).alias("kept"),
    )


def _run(docs: DataFrame, folder: str | None, files_per_batch: int, **options) -> str:
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "dedup")
    admit(docs, folder, **options)
    track(spark, folder, files_per_batch)
    return folder


def deduplicate(docs: DataFrame, *, folder: str | None = None, files_per_batch: int = 1000, **options) -> DataFrame:
    """The state of each row of ``docs`` after all were seen, see ``resolve``."""
    folder = _run(docs, folder, files_per_batch, **options)
    return resolve(docs.sparkSession, folder, options.get("text_col", "text"))


def unique_rows(docs: DataFrame, *, folder: str | None = None, files_per_batch: int = 1000, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    spark = docs.sparkSession
    folder = _run(docs, folder, files_per_batch, with_rows=True, **options)
    dropped = resolve(spark, folder, options.get("text_col", "text")).filter("not kept").select("place")
    return join_narrow(content(spark, folder), dropped, "place", "left_anti").select("row.*")
