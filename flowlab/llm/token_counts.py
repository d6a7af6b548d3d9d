"""Token counts by batch encoding in Arrow functions that return lengths only.

An Arrow batch is cut into parts of bounded bytes. Within a part every text is split at safe places
(before a single space inside the text, where the vocabulary's pre-tokens always end), pieces that
occur more than once are counted once, and the rest goes through the library's batch encoder in
batches of bounded bytes. Pieces beyond that bound are cut again, where a mark follows a letter. No ids
and no offsets leave the function, and a long text is one call only if it has neither kind of place, as
a megabyte of letters alone: that is one pre-token.

Special strings such as ``<|endoftext|>`` are handled as the library does by default: they count as
one token, and none has a space in it, so no cut falls inside one. That and the safe places are
properties of byte-level vocabularies; ``check_vocabulary`` refuses others.

Rows: a null text counts as empty and has no tokens; repeated rows are counted like any others; an
empty table gives an empty result. Other columns pass through, the added ones replace their names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import SAFE_PLACE, slices, text_or_empty

PART_BYTES = 8 << 20
BATCH_BYTES = 256 << 10
#: Pieces whose counts a worker remembers between batches; a full memory starts anew.
MOST_REMEMBERED = 600_000
LONGEST_REMEMBERED = 64
#: Between a letter and a punctuation mark a run of letters ends, and with it a pre-token. Letters and
#: marks are ones that every version of the library's tables has as such, and no added token holds the marks.
MARKS = "。、！？「」（），．,.;:!?"
LETTER_THEN_MARK = re.compile(f"(?<=[A-Za-zぁ-ゖァ-ヺ一-龥가-힣])(?=[{MARKS}])")


def check_vocabulary(path: str) -> None:
    """Refuse vocabularies for which the safe places are not proven safe."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    before, added = made.get("pre_tokenizer") or {}, made.get("added_tokens") or []
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if made.get("normalizer") or not plain:
        raise ValueError(f"{path}: a byte-level vocabulary without normalizer and prefix space is needed")
    if any(set(t["content"]) & {" ", *MARKS} or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path}: added tokens must not hold spaces or marks, nor strip spaces")


def encoded_size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def short_parts(piece: str) -> list[str]:
    """A piece over BATCH_BYTES cut at further places, as rarely as that allows; others as they are."""
    if len(piece) * 4 <= BATCH_BYTES or encoded_size(piece) <= BATCH_BYTES:
        return [piece]
    parts = LETTER_THEN_MARK.split(piece)
    return ["".join(part) for part in slices(parts, list(map(encoded_size, parts)), BATCH_BYTES)]


class Counter:
    """Counts tokens of texts with a library vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        check_vocabulary(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def lengths(self, pieces: list[str]) -> list[int]:
        """Tokens per piece; no batch has more than BATCH_BYTES, unless it is a single part."""
        parts, owners = [], []
        for owner, piece in enumerate(pieces):
            found = short_parts(piece)
            parts += found
            owners += [owner] * len(found)
        counts, done = [0] * len(pieces), 0
        for batch in slices(parts, list(map(encoded_size, parts)), BATCH_BYTES):
            for encoded in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False):
                counts[owners[done]] += len(encoded)
                done += 1
        return counts

    def count(self, texts: list[str]) -> list[int]:
        """Tokens per text. Pieces after the first are kept without the space before them."""
        if len(self.known) >= MOST_REMEMBERED:
            self.known.clear()
        cut = [SAFE_PLACE.split(text) for text in texts]
        new = set().union(*(pieces[1:] for pieces in cut)).difference(self.known)
        pieces = sorted(new, key=len)  # like sizes together: batches of even bytes
        self.known.update(zip(pieces, self.lengths([" " + p for p in pieces]), strict=True))
        first = self.lengths([pieces[0] for pieces in cut])
        found = [n + sum(map(self.known.__getitem__, pieces[1:])) for n, pieces in zip(first, cut, strict=True)]
        for piece in reversed(pieces):
            if len(piece) <= LONGEST_REMEMBERED:
                break
            del self.known[piece]
        return found


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_lengths(path: str):
    """An Arrow function from texts to numbers of tokens, with a vocabulary of the tokenizers library."""

    @F.arrow_udf("bigint")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
            counts: list[int] = []
            start = 0
            for part in slices(sizes, sizes, PART_BYTES):
                counts += counter(path).count([t or "" for t in batch.slice(start, len(part)).to_pylist()])
                start += len(part)
            yield pa.array(counts, pa.int64())

    return lengths


def count_tokens(docs: DataFrame, path: str, *, text_col: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens)."""
    text = text_or_empty(text_col)
    counts = {"n_bytes": F.octet_length(text).cast("bigint"), "n_tokens": token_lengths(path)(text)}
    return docs.withColumns(counts).withColumn("over_limit", F.col("n_tokens") > limit)
