"""One query per operator of this package, over the whole given tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    katz,
    language_id,
    license_join,
    mixing,
    nn_descent,
    simhash,
    spelling,
    token_counts,
    warc_zstd,
    whitening,
)
from flowlab.llm.common import crc_remainder
from flowlab.sources.storage import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package, also where the session was started without it on its
    path. A cluster has it installed or gets it with ``--py-files``; there this changes nothing."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc_zstd.write(table(spark, sf_dir, "pages"), path, least_bytes=100)
    back = warc_zstd.read(spark, path)
    return back.select(
        F.col("id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


ORACLES["op1_warc"] = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
placed AS (SELECT *, strlen(payload) AS bytes, min(page_id) OVER (PARTITION BY payload) AS first FROM sized)
SELECT page_id, bytes::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM placed
"""


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, most_bits=2)
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


@query
def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), folds=10, held_out_fold=0).withColumnRenamed("id", "doc_id")


@query
def op4_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), *bpe_files())


def bpe_files() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 4) == 2
    profiles = language_id.learn(docs.filter(~held_out))
    predicted = language_id.predict(docs.select("doc_id", "text"), profiles)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies"
    )


# Sources up to the level get their cap, the others share the rest by weight. Weights 3, 1, 2;
# 150 %; cap 2; seed 42.
ORACLES["op9_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), placed AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap,
         1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total
  FROM placed
), levels AS (
  SELECT *, coalesce(sum(cap) OVER before, 0)::DOUBLE AS given,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS waiting
  FROM weighted
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT *, cap * waiting <= (total - given) * weight AS capped FROM levels
), targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (total - (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE) * weight
                   / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM cut
), rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substring(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), copied AS (
  SELECT *, floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rated
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken, rate,
       copies::BIGINT AS copies
FROM copied
"""


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLES["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted_words(table(spark, sf_dir, "documents"), slip_every=97))


# crc32 byte by byte from its table; near words meet in what is left of them without one letter.
ORACLES["op12_spelling"] = """
WITH RECURSIVE bits(byte, step, crc) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END FROM bits WHERE step < 8
), crcs AS (SELECT list(crc ORDER BY byte) AS crc_of FROM bits WHERE step = 8),
split AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS key, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), runs AS (SELECT key, run, count(*) AS times FROM split WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (
  SELECT run, times, flatten(list_transform(string_split(key || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
         ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)) AS bytes
  FROM runs
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
    lambda crc, byte: xor(crc >> 8, crc_of[(xor(crc, byte) & 255) + 1]))) AS h
  FROM bytes, crcs
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word, sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3
), cut AS (
  SELECT word, n, place, left(word, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (place, rest) WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), followed(word, last) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT followed.word, form FROM followed JOIN forms ON forms.word = last WHERE form IS NOT NULL
)
SELECT forms.word, forms.form, last AS root, forms.n, forms.n_near, forms.form_n
FROM followed JOIN forms AS ends ON ends.word = last AND ends.form IS NULL JOIN forms ON forms.word = followed.word
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
