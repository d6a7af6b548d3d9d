"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint has one bit per position: set if it is set in over half of the hashes of the text's
word shingles. Two fingerprints link if few bits differ. To find such pairs, a fingerprint becomes the
vector of bit counts of its segments. A flipped bit moves one count by one, so the Manhattan distance
of two vectors is at most the number of differing bits: a lower bound, never a missed pair. Vectors
at distance 2r or less have a common grid point within r of both, so every fingerprint is listed at
its own grid point and those within r, and a join on the grid point finds all candidates; comparing
the bits decides.

All joins are by sorting, never by broadcast: their sides grow with the table, while a stored file of
numbers or the points that one number becomes look small to the planner.

Equal fingerprints are one row before the join, with their smallest id: copies, however many, make no
pairs. Links exist between distinct fingerprints only, and each has at most as many partners as there
are fingerprints within the distance.

Rows: a null text is an empty one; without words the fingerprint is zero and links like any other.
With fewer words than a shingle the whole sequence is the one shingle. A null id gets a fingerprint
and a component but names none: the component id is the smallest non-null id. Repeated rows are
alike. Other columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from flowlab.llm.common import tidy
from flowlab.llm.components import components
from flowlab.sources.storage import durable

WORDS = 3
HASH_SEED = 42
MOST_BITS = 2
SEGMENTS = 32
#: Hashes whose bits are counted at a time.
SLICE = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of one text, unsigned. Words end at ASCII white space; A-Z become lower case."""
    found = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    if len(found) <= words:
        return xxh64_intdigest(b" ".join(found), HASH_SEED)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-words] + 1])
    counts, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, SLICE):
        cuts = zip(starts[at : at + SLICE].tolist(), ends[at + words - 1 :][:SLICE].tolist(), strict=False)
        hashes = np.array([xxh64_intdigest(line[a:b], HASH_SEED) for a, b in cuts], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, print): the 64 bits as a signed number."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], ["id", "print"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, print bigint")


def _fields(width: int, every: int) -> Column:
    """A number with the lowest ``width`` of each ``every`` bits set."""
    value = sum(((1 << width) - 1) << at for at in range(0, 64, every))
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("bigint")


def segment_counts(bits: Column, width: int) -> Column:
    """The numbers of set bits of all segments of ``width`` bits, each in its segment's place.

    A count fits its segment, so the whole vector is one 64-bit number.
    """
    if width > 1:
        low, high = (x.bitwiseAND(_fields(1, 2)) for x in (bits, F.shiftrightunsigned(bits, 1)))
        bits = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    half = 2
    while half < width:
        mask = _fields(half, 2 * half)
        bits = bits.bitwiseAND(mask) + F.shiftrightunsigned(bits, half).bitwiseAND(mask)
        half *= 2
    return bits


def _steps(vector: Column, width: int) -> list[Column]:
    """The vectors at distance one; null where a count would leave its range."""
    found = []
    for at in range(0, 64, width):
        count = F.shiftrightunsigned(vector, at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        for step, possible in ((1, count < width), (-1, count > 0)):
            found.append(F.when(possible, vector.bitwiseXOR(F.shiftleft(count.bitwiseXOR(count + step), at))))
    return found


def grid_points(distinct: DataFrame, segments: int, radius: int) -> DataFrame:
    """(point, print) for every grid point within ``radius`` of a fingerprint's vector."""
    width = 64 // segments
    if segments * width != 64 or width & (width - 1):
        raise ValueError("64 bits must split evenly into segments of 1, 2, 4, 8, 16, 32 or 64 bits")
    points = distinct.select("print", segment_counts(F.col("print"), width).alias("point"))
    for _ in range(radius):
        around = F.array_compact(F.array("point", *_steps(F.col("point"), width)))
        points = points.select("print", F.explode(around).alias("point"))
    return points if radius < 2 else points.distinct()


def links(prints: DataFrame, *, most_bits: int = MOST_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(a, b), a < b: the distinct fingerprints of ``prints`` (print) that differ in few bits."""
    radius = (most_bits + 1) // 2
    points = grid_points(prints.select("print").distinct(), segments, radius)
    one, other = (points.select("point", F.col("print").alias(n)) for n in ("a", "b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits
    return one.join(other.hint("merge"), "point").filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def classes(prints: DataFrame, *, most_bits: int = MOST_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(print, component_id) for each distinct fingerprint of ``prints`` (id, print)."""
    distinct = durable(prints.groupBy("print").agg(F.min("id").alias("first")), "prints")
    joined = components(links(distinct, most_bits=most_bits, segments=segments)).hint("merge")
    grouped = distinct.join(joined, distinct["print"] == joined["id"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("component")
    )
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    return grouped.join(smallest.hint("merge"), "component").select("print", "component_id")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **options
) -> DataFrame:
    """(id, print, component_id) per row of ``docs``: links between fingerprints, followed to the end."""
    prints = durable(fingerprints(docs, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    return prints.join(classes(prints, **options).hint("merge"), "print").select("id", "print", "component_id")
