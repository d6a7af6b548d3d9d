"""From an all-text flow table to a typed one: narrow steps, one scan, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from flowlab.functions.values import cast_failed, no_negative, number, standard_label
from flowlab.sources.storage import durable

# The identifier columns, and the measures for which a negative is impossible.
ID_COLUMNS = ("flow_id", "timestamp", "src_ip", "dst_ip")
NON_NEGATIVE = (
    "duration",
    "fwd_packets_count",
    "bwd_packets_count",
    "fwd_total_payload_bytes",
    "bwd_total_payload_bytes",
    "bytes_rate",
    "packets_rate",
)
LABEL = "label"
#: Slots that tell where digests repeat: one bit each, 16 MB in all where every one is marked.
SLOTS = 2**27


def measure_columns(df: DataFrame, label: str = LABEL, ids: Iterable[str] = ID_COLUMNS) -> list[str]:
    """All columns but the label and the identifiers."""
    skip = {label, *ids}
    return [c for c in df.columns if c not in skip]


def cast_measures(
    df: DataFrame, label: str = LABEL, ids: Iterable[str] = ID_COLUMNS, strict: bool = False
) -> DataFrame:
    """Every measure to double in one projection; label and identifiers stay text.

    Pass ``ids=()`` to turn identifiers into numbers too (text ones become NULL).
    """
    measures = set(measure_columns(df, label, ids))
    typed = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}

    def column(name: str):
        if name not in measures:
            return F.col(name)
        if name in typed:
            return F.col(name).cast("double").alias(name)
        return number(name, strict).alias(name)

    return df.select(*map(column, df.columns))


def cast_failures(df: DataFrame, label: str = LABEL, ids: Iterable[str] = ID_COLUMNS) -> DataFrame:
    """(column, failed): how many texts of each measure were no number; only columns with some."""
    names = measure_columns(df, label, ids)
    counts = df.select(*(F.count_if(cast_failed(n)).alias(n) for n in names))
    return counts.unpivot([], names, "column", "failed").filter("failed > 0")


def drop_impossible(
    df: DataFrame, columns: Iterable[str] = NON_NEGATIVE, keep_nulls: bool = False
) -> DataFrame:
    """Drop rows with a negative in any of ``columns`` that exist; see ``no_negative`` on NULLs."""
    present = [c for c in columns if c in df.columns]
    return df.filter(no_negative(present, keep_nulls)) if present else df


def standardise_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.withColumn(label, standard_label(label))


def clean_flows(
    df: DataFrame,
    label: str = LABEL,
    ids: Iterable[str] = ID_COLUMNS,
    keep_nulls: bool = False,
    strict: bool = False,
    deduplicate: bool = False,
) -> DataFrame:
    """Cast, drop impossible rows, standardise labels; whole-row de-duplication on request."""
    df = cast_measures(df, label, ids, strict)
    if deduplicate:
        df = drop_duplicate_rows(df)
    return standardise_labels(drop_impossible(df, keep_nulls=keep_nulls), label)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact whole-row ``distinct`` that shuffles whole rows only where a digest may repeat.

    The rows are stored once with their digest, so what made them runs once. Counting digests then
    reads and shuffles 8 bytes a row. A digest that occurs twice marks one of ``SLOTS`` slots; rows
    of unmarked slots have no copy and pass as they are, and the others go through a real distinct,
    whose map side collapses the copies of a hot row. A shared slot or digest costs a little work
    and never a row. The marks are bitmaps of 4 KB and of a bounded number, and are broadcast, so the
    plan is the same for any table; with ten million repeated digests a tenth of the slots is marked.
    """
    columns = df.columns
    digested = durable(df.withColumn("_digest", F.xxhash64(*columns)), "digested")
    slot = F.pmod("_digest", F.lit(SLOTS))
    digests = digested.groupBy("_digest").count().filter("count > 1")
    repeated = digests.groupBy(F.bitmap_bucket_number(slot).alias("_bucket"))
    marks = repeated.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    marked = F.broadcast(durable(marks, "marked"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, CAST(_at % 8 AS INT)) & 1") == 1
    placed = digested.withColumns({"_bucket": F.bitmap_bucket_number(slot)}).join(marked, "_bucket", "left")
    told = placed.select(*columns, at.alias("_at"), byte.alias("_byte"))
    copied = F.coalesce(bit, F.lit(False))
    alone = told.filter(~copied).select(*columns)
    copies = told.filter(copied).select(*columns).distinct()
    return alone.unionByName(copies)
