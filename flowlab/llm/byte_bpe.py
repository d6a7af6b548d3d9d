"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into the matches of a pattern (pre-tokens). The bytes of a pre-token form a linked
list; every pair of neighbours whose joined bytes have a rank waits in the bucket of that rank. A
two-level bitmap of non-empty buckets gives the next rank by find-first-set, so a merge costs the
same in a pre-token of a megabyte as in a word. Entries whose pair has changed since are skipped. Words
that are new to a worker share one list and one queue, so that a bucket's merges in thousands of words
are a few array operations; long pre-tokens have the queue for themselves. Workers remember encoded
words in a bounded number of bytes.

Rows: a null text encodes to no ids and decodes to empty bytes, as an empty text does. Other columns
pass through, ids and decoded bytes replace columns of their names. Repeated rows are encoded like
any others; an empty table gives an empty result.

The rank file is read where tasks run; its path is a parameter.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm.common import SAFE_PLACE, tidy

WORD_SHIFT = 6
#: Bytes of texts handled at a time. Larger slices share more merges and take more memory; no result changes.
SLICE_BYTES = 8 << 20
#: Bytes of the encoded words that a worker remembers from slice to slice and task to task, before those of
#: the last slice, for each byte of a slice; beyond that it starts anew. ENTRY_BYTES is what an entry takes
#: besides its text and ids.
REMEMBERED_SHARE = 6
ENTRY_BYTES = 200
#: Bytes of a pre-token that has the queue for itself.
LONG = 256


class Codes(dict):
    """Numbers strings in the order in which they first occur."""

    def __missing__(self, key: str) -> int:
        self[key] = code = len(self)
        return code


class ByteBpe:
    """Ranks of byte strings, a pattern, the rank queue, and the words that a worker remembers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.size = max(ranks.values()) + 1
        self.vocabulary = [b""] * self.size
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        #: The queue: positions by rank, and the lower level of the bitmap, a bit for every bucket that holds some.
        self.buckets: list[list] = [[] for _ in range(self.size)]
        self.words = [0] * ((self.size >> WORD_SHIFT) + 1)
        self.bits = [1 << i for i in range(max(1 << WORD_SHIFT, len(self.words)))]
        #: Ranks of single bytes, and of two by their number.
        self.single = np.array([ranks.get(bytes([n]), -1) for n in range(256)], np.int32)
        self.pairs = [ranks.get(bytes(divmod(n, 256)), -1) for n in range(1 << 16)]
        self.pair_ranks = np.array(self.pairs, np.int32)
        #: For any two tokens that make one, their number and its rank, by number.
        made = [
            (left * self.size + right, rank)
            for token, rank in ranks.items()
            for left, right in ((ranks.get(token[:i]), ranks.get(token[i:])) for i in range(1, len(token)))
            if left is not None and right is not None
        ]
        self.joins, self.joined = np.array(sorted(made), np.int64).reshape(-1, 2).T.copy()
        self.known: dict[str, bytes] = {}
        self.used = 0

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token: always merges the pair of least rank, the leftmost first.

        The summary, the bitmap's upper level, has a bit for every word of the lower level that has one.
        Find-first-set in it and then in its word is the next rank; a bucket gives its least position.
        The queue is empty again at the end. Its steps stand here and not in functions: most
        pre-tokens are words of a few bytes, for which calls would cost as much as the merges.
        """
        rank_of, buckets, words, bits, pairs = self.ranks.get, self.buckets, self.words, self.bits, self.pairs
        end, summary, mask = len(data), 0, (1 << WORD_SHIFT) - 1
        following = list(range(1, end + 1))
        previous = list(range(-1, end))
        waiting = [-1] * (end + 1)  # rank of the pair that starts here
        for i in range(end - 1):
            rank = pairs[data[i] << 8 | data[i + 1]]
            if rank >= 0:
                waiting[i] = rank
                bucket = buckets[rank]
                if not bucket:
                    word = rank >> WORD_SHIFT
                    if not words[word]:
                        summary |= bits[word]
                    words[word] |= bits[rank & mask]
                bucket.append(i)  # positions rise, so the bucket stays a heap
        while summary:
            word = (summary & -summary).bit_length() - 1
            filled = words[word]
            lowest = filled & -filled
            rank = (word << WORD_SHIFT) + lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket.pop()
                words[word] = filled = filled ^ lowest
                if not filled:
                    summary ^= bits[word]
            if waiting[i] != rank:
                continue
            gone = following[i]
            after = following[gone]
            following[i] = after
            previous[after] = i
            waiting[gone] = waiting[i] = -1
            changed = [(i, data[i : following[after]])] if after < end else []
            if i:
                before = previous[i]
                changed.append((before, data[before:after]))
            for at, joined in changed:
                waiting[at] = new = rank_of(joined, -1)
                if new >= 0:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, at)
                        continue
                    bucket.append(at)
                    word = new >> WORD_SHIFT
                    if not words[word]:
                        summary |= bits[word]
                    words[word] |= bits[new & mask]
        ids, i = [], 0
        while i < end:
            ids.append(self.ranks[data[i : following[i]]])
            i = following[i]
        return ids

    def rank_of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each two tokens' joined bytes, or -1."""
        number = np.int64(self.size) * left + right
        at = np.minimum(np.searchsorted(self.joins, number), len(self.joins) - 1)
        return np.where(self.joins[at] == number, self.joined[at], -1)

    def merge_together(self, items: list[bytes]) -> list[bytes]:
        """The packed ids of many short pre-tokens, which lie one after the other in a common linked list and
        share the queue: a bucket holds the positions of one rank in all of them, and its merges are done at
        once, in each pre-token the leftmost; others of that rank wait again, behind what may be lower by then.
        """
        if not items or not len(self.joins):
            return [packed([self.ranks[bytes([b])] for b in item]) for item in items]
        buckets, words, bits, mask = self.buckets, self.words, self.bits, (1 << WORD_SHIFT) - 1
        lengths = np.fromiter(map(len, items), np.int64, len(items))
        data = np.frombuffer(b"".join(items), np.uint8).astype(np.int32)
        end, summary = len(data), 0
        # one more place at the end belongs to no pre-token
        item = np.append(np.repeat(np.arange(len(items), dtype=np.int32), lengths), np.int32(-1))
        ids = np.append(self.single[data], np.int32(0))
        following = np.minimum(np.arange(1, end + 2, dtype=np.int32), end)
        previous = np.arange(-1, end, dtype=np.int32)
        alive = np.ones(end, bool)
        waiting = np.full(end + 1, -1, np.int32)  # rank of the pair that starts here
        if end > 1:
            waiting[: end - 1] = np.where(item[1:end] == item[: end - 1], self.pair_ranks[data[:-1] << 8 | data[1:]], -1)

        def push(places: np.ndarray, ranks: np.ndarray, summary: int) -> int:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = (np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
            firsts = [0, *cuts]
            for rank, start, stop in zip(ranks[firsts].tolist(), firsts, [*cuts, len(places)], strict=True):
                bucket = buckets[rank]
                if not bucket:
                    word = rank >> WORD_SHIFT
                    if not words[word]:
                        summary |= bits[word]
                    words[word] |= bits[rank & mask]
                bucket.append(places[start:stop])
            return summary

        first = np.flatnonzero(waiting >= 0)
        if len(first):
            summary = push(first, waiting[first], summary)
        while summary:
            word = (summary & -summary).bit_length() - 1
            filled = words[word]
            lowest = filled & -filled
            rank = (word << WORD_SHIFT) + lowest.bit_length() - 1
            at = buckets[rank][0] if len(buckets[rank]) == 1 else np.concatenate(buckets[rank])
            buckets[rank] = []
            words[word] = filled = filled ^ lowest
            if not filled:
                summary ^= bits[word]
            at = at[waiting[at] == rank]
            if not len(at):
                continue
            later = at[:0]
            if len(at) > 1:
                at = np.unique(at)
                again = item[at[1:]] == item[at[:-1]]
                if again.any():
                    later, at = at[1:][again], np.append(at[:1], at[1:][~again])
            gone = following[at]
            after = following[gone]
            before = previous[at]
            ids[at], following[at], previous[after] = rank, after, at
            alive[gone] = False
            waiting[gone] = -1
            own = item[at]
            waiting[at] = right = np.where(item[after] == own, self.rank_of_pairs(rank, ids[after]), -1)
            inside = item[before] == own
            before = before[inside]
            waiting[before] = left = self.rank_of_pairs(ids[before], rank)
            places = np.concatenate([at[right >= 0], before[left >= 0], later[waiting[later] == rank]])
            if len(places):
                summary = push(places, waiting[places], summary)
        kept = np.flatnonzero(alive)
        out = ids[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(item[kept], minlength=len(items)))).tolist()
        return [out[start:stop] for start, stop in zip([0, *ends], ends, strict=False)]

    def learn(self, new: list[str]) -> None:
        """Remember the encodings of these pre-tokens. A long one has the queue for itself."""
        short, short_data = [], []
        for word in new:
            data = word.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[word] = packed([rank])
            elif len(data) > LONG:
                self.known[word] = packed(self.merge(data))
            else:
                short.append(word)
                short_data.append(data)
        self.known.update(zip(short, self.merge_together(short_data), strict=True))
        self.used += ENTRY_BYTES * len(new) + sum(map(len, new)) + sum(map(len, map(self.known.__getitem__, new)))

    def encode_all(self, texts: list[str], remembered: int = REMEMBERED_SHARE * SLICE_BYTES) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers.

        Texts are cut at safe spaces; of what is distinct in all of them, words that are not remembered
        are encoded together.
        """
        if self.used > remembered:
            self.known, self.used = {}, 0
        pieces, rests, words, counts = Codes(), [], [], []
        for text in texts:
            first, *rest = SAFE_PLACE.split(text)
            rests.append(array("I", map(pieces.__getitem__, rest)))
            found = self.find(first)
            words += found
            counts.append(len(found))
        for piece in pieces:
            found = self.find(" " + piece)
            words += found
            counts.append(len(found))
        pieces.clear()
        self.learn(list(set(words).difference(self.known)))
        ids = map(self.known.__getitem__, words)  # one flat list: a list per piece would be slow to keep
        encoded = [next(ids) if count == 1 else b"".join(islice(ids, count)) for count in counts]
        after_space = encoded[len(texts) :].__getitem__
        return [b"".join([first, *map(after_space, rest)]) for first, rest in zip(encoded, rests, strict=False)]

    def encode(self, text: str, **options) -> bytes:
        return self.encode_all([text], **options)[0]

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I")
        numbers.frombytes(ids)
        return b"".join(map(self.vocabulary.__getitem__, numbers))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One coder per worker and vocabulary; the file has a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return ByteBpe(ranks, pattern)


def _mapped(df: DataFrame, column: str, added: dict, slice_bytes: int) -> DataFrame:
    """``df`` with binary columns, each made by a function of lists from the one before, the first from
    ``column``.

    Works on each Arrow batch a slice of bytes at a time.
    """
    kept = [f for f in df.schema.fields if f.name not in added]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(name, T.BinaryType(), False) for name in added)])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, column, slice_bytes):
                values, made = part.column(column).to_pylist(), []
                for convert in added.values():
                    values = convert(values)
                    made.append(pa.array(values, pa.binary()))
                yield pa.RecordBatch.from_arrays([*map(part.column, names), *made], [*names, *added])

    return df.mapInArrow(run, schema)


def sliced(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch cut into slices whose values of ``column`` have at most so many bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(chain(sizes, [0])):
        if i == len(sizes) or (i > start and total + size > most):
            if i > start:
                yield batch.slice(start, i - start)
            start, total = i, 0
        total += size


def _encoder(path: str, pattern: str, slice_bytes: int):
    remembered = REMEMBERED_SHARE * slice_bytes
    return lambda texts: coder(path, pattern).encode_all([text or "" for text in texts], remembered)


def _decoder(path: str, pattern: str):
    return lambda many: [coder(path, pattern).decode(ids or b"") for ids in many]


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    *,
    text_col: str = "text",
    ids_col: str = "ids",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` with the ids of each text as little-endian unsigned 32-bit numbers in one binary."""
    return _mapped(docs, text_col, {ids_col: _encoder(path, pattern, slice_bytes)}, slice_bytes)


def decode(encoded: DataFrame, path: str, pattern: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that each row's ids stand for."""
    return _mapped(encoded, ids_col, {out_col: _decoder(path, pattern)}, SLICE_BYTES)


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    *,
    text_col: str = "text",
    ids_col: str = "ids",
    out_col: str = "decoded",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` encoded and decoded again by the same workers, so that texts reach Python once."""
    steps = {ids_col: _encoder(path, pattern, slice_bytes), out_col: _decoder(path, pattern)}
    return _mapped(docs, text_col, steps, slice_bytes)


def digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of ids, SHA-256 of the ids and of the bytes they decode to."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return round_trip(rows, path, pattern).select(
        F.col("id").alias(id_col),
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
