"""Documents that operators must not trip over: nulls, empty and very long texts, ties, repeated rows,
and further columns named like those that operators make."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASHES = (
    "id size score digest kept place print component_id row target rate copies source_size lang_pred ids decoded "
    "n_tokens n_bytes over_limit block words held label labels mark vector a b hits leads _row _copy"
).split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} and {i}" for i in range(40_000))

ROWS = [
    (1, None, "en", "s1", 0),
    (2, "", None, "s1", 0),
    (3, " \t\n", "fr", None, 3),
    (4, "One", "en", "s2", 3),
    (5, LONG, "en", "s2", len(LONG)),
    (6, "The same words stand here, under the MIT License.", "en", None, None),
    (7, "The same words stand here, under the MIT License.", "en", "s3", 1),
    (7, "The same words stand here, under the MIT License.", "en", "s3", 1),
    (8, "The same words stand here under the mit license", None, "s3", 1),
    (None, "nobody named these few words", "en", "s1", 1),
    (None, None, None, None, None),
    (9, "ce sont des mots pour les autres et la raison <|endoftext|> fin", "fr", "s4", 1),
    (10, "42 !! ?? 17", "en", "s4", 1),
    (11, "é" * 5000 + "x" * 70_000, "fr", "\U0001f600", 1),
]


def edge_docs(spark: SparkSession) -> DataFrame:
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.withColumns({c: F.lit(f"other {c}") for c in CLASHES})


def no_docs(spark: SparkSession) -> DataFrame:
    return edge_docs(spark).filter("false")


def same_rows(actual: DataFrame, expected: list[tuple]) -> None:
    def key(row):
        return [(v is None, str(v)) for v in row]

    assert sorted(map(tuple, actual.collect()), key=key) == sorted(expected, key=key)
