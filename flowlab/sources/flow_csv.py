"""Directories of flow CSV files, read as one all-text table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"
FILE = "_file"
QUARANTINED = "_quarantined"


def header_names(spark: SparkSession, path: str) -> list[str]:
    """The raw first line's names, padding and repeats included: reads one line."""
    first = spark.read.option("header", False).csv(path).first()
    return ["" if name is None else str(name) for name in first] if first else []


def positional_names(header: list[str]) -> tuple[list[str], list[str]]:
    """(a unique name for every position, the names to keep).

    Names lose their padding. The first of equal names keeps it; a later one is renamed after
    its position and dropped, so a value never moves under another column's name.
    """
    names: list[str] = []
    kept: list[str] = []
    for position, raw in enumerate(header):
        name = raw.strip()
        if name in kept:
            name = f"{name}__dup{position}"
        else:
            kept.append(name)
        names.append(name)
    return names, kept


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def check_headers(spark: SparkSession, path: str) -> None:
    """Fail unless all files have the same header, padding aside. Reads the files as text, once."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    firsts = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("line"))
    words = F.transform(F.split("line", ","), lambda w: F.trim(F.regexp_replace(F.trim(w), '^"|"$', "")))
    kinds = firsts.groupBy(words.alias("words")).agg(F.min("file").alias("file")).limit(2).collect()
    if len(kinds) > 1:
        raise ValueError(f"headers differ: {kinds[0].words} in {kinds[0].file}, {kinds[1].words} in {kinds[1].file}")


def quarantine_flows(spark: SparkSession, path: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined): the CSV files under ``path`` parsed once and written to ``folder``, lines with a
    wrong number of fields apart from the others. ``quarantined`` has (file, text)."""
    parsed = read_flows(spark, path, keep_corrupt=True, file_column=FILE)
    faulty = F.col(CORRUPT).isNotNull()
    # tasks sort their rows by the flag, so rows that will not show their file do not carry it
    flagged = parsed.withColumns({QUARANTINED: faulty, FILE: F.when(faulty, F.col(FILE))})
    flagged.write.mode("overwrite").partitionBy(QUARANTINED).parquet(folder)
    schema = StructType([*parsed.schema.fields, StructField(QUARANTINED, BooleanType())])
    stored = spark.read.schema(schema).parquet(folder)
    rows = stored.filter(~F.col(QUARANTINED)).drop(QUARANTINED, CORRUPT, FILE)
    return rows, stored.filter(QUARANTINED).select(F.col(FILE).alias("file"), F.col(CORRUPT).alias("text"))


def read_flows(
    spark: SparkSession, path: str, keep_corrupt: bool = False, file_column: str | None = None
) -> DataFrame:
    """All CSV files under ``path`` as text columns, blanks around values removed.

    The schema comes from one header line and not from inference. Every file's header must be that
    of the first, padding aside; a file with other columns, or the same in another order, fails.
    Spark makes that check while it reads, if every column has its own name. With repeated names, or
    with ``keep_corrupt``, which adds the raw text of rows with a wrong number of fields, columns
    are bound by position and the headers are compared beforehand. ``file_column`` adds each row's file.
    """
    header = header_names(spark, path)
    names, kept = positional_names(header)
    by_position = keep_corrupt or names != [name.strip() for name in header]
    if by_position:
        check_headers(spark, path)
    schema = text_schema([*names, CORRUPT] if keep_corrupt else names)
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", by_position)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    file = [F.col("_metadata.file_path").alias(file_column)] if file_column else []
    return rows.select(*(F.col(f"`{c}`") for c in [*kept, *([CORRUPT] if keep_corrupt else [])]), *file)
