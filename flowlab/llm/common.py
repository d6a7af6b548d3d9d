"""Helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.sources.storage import durable

#: A side of a join is broadcast up to this many narrow rows (counted first); beyond it both sides are
#: sorted, whatever the planner makes of the size of its files.
MOST_BROADCAST_ROWS = 500_000

#: A space between two characters that are no white space. No token of the byte-level vocabularies
#: spans the place before such a space, so texts can be cut there and encoded piece by piece.
SAFE_PLACE = re.compile(r"(?<!\s) (?!\s)")


def safe_pieces(text: str) -> list[str]:
    """``text`` cut before every safe space; joined, the pieces are the text again."""
    first, *rest = SAFE_PLACE.split(text)
    return [first, *[" " + piece for piece in rest]]


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that an operator's own columns cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_between(text: Column, between: str) -> Column:
    """The words of a text, given the pattern of what stands between them.

    Splitting is twice as fast as extracting; only the first and last part can be empty.
    """
    return F.array_remove(F.split(text, between), "")


def crc_remainder(column: str, parts: int) -> Column:
    """crc32 of the value as text, modulo ``parts``; a null value counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def join_narrow(left: DataFrame, right: DataFrame, on, how: str, limit: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """Join with a narrow table that is stored first and broadcast only if it has few rows. Of more rows the
    planner sees small files (paths and numbers compress well) and would broadcast them all the same."""
    kept = durable(right, "narrow")
    return left.join(kept.hint("broadcast" if kept.count() <= limit else "merge"), on, how)


def tidy(function):
    """An Arrow function that at a task's end gives back the memory that it no longer uses.

    Python workers outlive their tasks; what their allocators keep would be missing in later stages.
    """

    @wraps(function)
    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # what arrays leave behind, where the C library can
        if trim is not None:
            trim(0)

    return run


def slices(items: list, weights: list[int], most: int) -> Iterator[list]:
    """Consecutive items whose weights add up to ``most`` or less; a heavier item comes alone."""
    part, total = [], 0
    for item, weight in zip(items, weights, strict=True):
        if part and total + weight > most:
            yield part
            part, total = [], 0
        part.append(item)
        total += weight
    if part:
        yield part
