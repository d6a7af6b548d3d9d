"""Readable exports: row samples as CSV, schemas and small reports as tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions.vectors import vector_text


def preferred(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The listed columns that exist, in the listed order; all columns if none does."""
    found = [c for c in columns or () if c in df.columns]
    return df.select(*found) if found else df


def text_vectors(df: DataFrame) -> DataFrame:
    """Vector columns as JSON arrays."""
    vectors = {f.name: vector_text(f.name) for f in df.schema.fields if isinstance(f.dataType, VectorUDT)}
    return df.withColumns(vectors) if vectors else df


def sample_rows(df: DataFrame, rows: int, key: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The first ``rows`` rows by key, so that a second export gives the same sample.

    Spark keeps the best rows of every task and merges those: the table is not sorted.
    """
    return text_vectors(preferred(df.orderBy(key).limit(rows), columns))


def schema_table(df: DataFrame) -> DataFrame:
    """(position, name, type, nullable) of every column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def schema_with_counts(df: DataFrame) -> DataFrame:
    """``schema_table`` with the number of filled rows of every column."""
    names = df.columns
    filled = df.agg(*(F.count(c).alias(c) for c in names)).unpivot([], names, "name", "filled")
    return schema_table(df).join(filled, "name").select("position", "name", "type", "nullable", "filled")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header and NULL as an empty field; ``one_file`` is for small reports."""
    rows = text_vectors(df)
    rows = rows.coalesce(1) if one_file else rows
    rows.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """The one text column as lines, in as many files as there are tasks, each headed by ``header``."""
    as_they_are = {"header": True, "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer = lines.toDF(header).write.mode("overwrite").options(**as_they_are)
    writer.option("sep", "\u0001").option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str, one_file: bool = False) -> None:
    rows = df.coalesce(1) if one_file else df
    rows.write.mode("overwrite").json(path)
