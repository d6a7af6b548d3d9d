"""From raw documents to token ids: five stages, each a whole job over what the one before kept.

1. language identification: documents without letters, and those in no learned language, go;
2. exact deduplication: one row of each set of equal texts stays;
3. SimHash near-deduplication: one document of each group of near copies stays;
4. mixing: documents are repeated or left out until their sources reach their target weights;
5. byte-level BPE: texts become token ids, and are decoded again as a check.

Every stage is written as Parquet before the next one reads it. A null text counts as empty and goes
in the first stage. Near copies are decided row by row: of a group one row stays, also where ids are
null or repeated. Further columns pass through all stages but the last, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import byte_bpe, exact_dedup, language_id, mixing, simhash
from flowlab.llm.common import crc_remainder, join_narrow, whole_row
from flowlab.llm.queries import reach_package
from flowlab.sources.storage import durable, new_folder

#: Texts encoded at a time: less than the operator takes by itself, since executors that ran four stages
#: before have less memory left.
SLICE_BYTES = 3 << 20
#: A random cosine then has a deviation of 1/64.
DIMS = 4096
#: Places of dropped rows, paths among them, that are broadcast at most.
MOST_PLACES = 100_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What counts as a text in a learned language is fitted on the labelled documents that taught nothing.
    Where no language could be learned, or none was held out, every document with letters stays."""
    held_out = crc_remainder("doc_id", 4) == 2
    profiles = language_id.learn(docs.filter(~held_out), dims=DIMS)
    if not profiles.languages:
        return language_id.with_letters(docs)
    usual = language_id.fit_usual(docs.filter(held_out & F.col("lang").isNotNull()), profiles)
    return language_id.typical(docs, profiles, usual)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.unique_rows(docs)


def numbered(docs: DataFrame) -> DataFrame:
    """(at, row): the rows of a Parquet table, told apart by where they are stored; other rows are stored
    first. Numbers of tasks would not do: a second scan may be split in another way."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = durable(docs, "rows")
    place = docs.metadataColumn("_metadata")
    at = F.struct(
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("id"),
        place["file_path"].alias("file"),
        place["row_index"].alias("number"),
    )
    return docs.select(at.alias("at"), whole_row(docs).alias("row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the smallest id and place stays; null ids come last."""
    rows = numbered(docs)
    found = simhash.near_duplicates(rows, id_col="at", text_col="row.text", words=3, most_bits=2)
    same = (F.col("id.file") == F.col("component_id.file")) & (F.col("id.number") == F.col("component_id.number"))
    dropped = found.filter(~same).select("id.file", "id.number")
    placed = rows.select("at.file", "at.number", "row")
    return join_narrow(placed, dropped, ["file", "number"], "left_anti", MOST_PLACES).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit numbers) and whether they
    decode to the very bytes of the text, with both digests."""
    rows = docs.select("doc_id", "lang", "source", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.round_trip(rows, ranks, public_tokenizers.PATTERN, slice_bytes=SLICE_BYTES)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("exact"),
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: No SQL engine has the language profiles, fingerprints or merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``; every stage's rows lie in the shared folder."""
    reach_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
