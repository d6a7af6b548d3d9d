"""Language-model scores: a Katz backoff model of any order, trained and evaluated in partitioned tables.

Tokens are the words of a text and one end mark; before the first word stand end marks. Counts up to
five are discounted by Good-Turing, each order on its own; the freed probability of a context goes to
the words not seen after it, by their probability after the context without its first word, with a
backoff weight that makes the sum exactly one. Unigrams are discounted the same way, and what they free
is the probability of an unknown word. A token's probability is looked up recursively: its longest
n-gram, else the context's weight times the probability by the shorter ones.

How it runs. Texts are gathered into blocks of bounded bytes: token codes and a local dictionary. Only
what is distinct in a block is shuffled, as packed arrays of numbers, order by order:

* words go to a part by hash; a part counts its words, numbers them and answers the blocks with
  numbers and counts;
* n-grams, a context and a word each, go to a part by context; a part counts them, answers with the
  counts, sums up its contexts, and numbers its n-grams, which are the contexts of the next order. A
  context with so many tokens that it could fill a part is spread over several, and the sums of these
  few (at most MOST_SPREAD an order) go to all blocks;
* a block computes the probabilities of its tokens from the answers, order by order, and the scores.

An n-gram is asked for only if its shorter one and its context were counted. Blocks lie in a table that
is bucketed by block, so that joining answers to them moves only the answers. The count tables stay in
the shared folder, one row of packed arrays per part and order.

Words are told apart by 64-bit hashes.

Rows: a null text is an empty one and scores its end mark. A null id counts as the empty id when the
training texts are chosen. Repeated rows count as often as they occur. Without training texts every
token is unknown and has probability one. Other columns do not matter. An empty table gives an empty
result. A text must fit into the memory of a task.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from flowlab.llm.common import crc_remainder
from flowlab.sources.storage import durable, new_folder

END = b"\n"  # no word has white space in it
MOST_DISCOUNTED = 5
BLOCK_BYTES = 8 << 20
#: Words, and n-grams of an order, that a part is meant to have; the numbers of parts follow from the corpus.
PART_WORDS = 1 << 20
PART_GRAMS = 1 << 21
MOST_SPREAD = 1 << 16
ADDED = 0.1  # of the base score
ORDER = 2


def pack(values: np.ndarray) -> bytes:
    """Numbers of 64 bits, compressed byte plane by byte plane: high bytes are mostly zero."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, dtype=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(dtype)


def joined(parts: list[np.ndarray], dtype=np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


class Codes(dict):
    """Numbers words in the order in which they first occur."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


# ---- the model's numbers -------------------------------------------------------------------------


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Factors for counts 0 to MOST_DISCOUNTED from how many n-grams occur once, twice, and so on.

    Good-Turing with the largest limit for which all factors lie between 0 and 1; if there is none,
    half a count is taken off. Counts above the limit keep all.
    """
    n = [0, *counts_of_counts]
    for limit in range(MOST_DISCOUNTED, 1, -1):
        if min(n[1 : limit + 2]) > 0:
            common = (limit + 1) * n[limit + 1] / n[1]
            ratios = [(r + 1) * n[r + 1] / (r * n[r]) for r in range(1, limit + 1)]
            found = [(ratio - common) / (1 - common) for ratio in ratios] if common < 1 else []
            if found and all(0 < d < 1 for d in found):
                return np.array([0.0, *found, *[1.0] * (MOST_DISCOUNTED - limit)])
    return np.array([0.0, *((r - 0.5) / r for r in range(1, MOST_DISCOUNTED + 1))])


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= MOST_DISCOUNTED, factors[np.minimum(counts, MOST_DISCOUNTED)], 1.0)


@dataclass(frozen=True)
class Unigrams:
    """Number of training tokens and of distinct ones, discount factors, probability of the unknown."""

    tokens: int
    distinct: int
    factors: np.ndarray
    total: int  # tokens, or one more if nothing is discounted
    unknown: float

    @classmethod
    def of(cls, tokens: int, distinct: int, counts_of_counts: list[int]) -> Unigrams:
        factors = discounts(counts_of_counts)
        freed = sum(r * n * (1 - factors[r]) for r, n in enumerate(counts_of_counts, 1) if r <= MOST_DISCOUNTED)
        if tokens == 0 or freed == 0:
            return cls(tokens, distinct, factors, tokens + 1, 1 / (tokens + 1))
        return cls(tokens, distinct, factors, tokens, freed / tokens)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.factors) / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))


def context_weights(
    totals: np.ndarray, seen: np.ndarray, mass: np.ndarray, factors: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(total, backoff weight) of contexts.

    totals: their tokens; seen[r - 1]: how many words follow r times; mass: the unigram probability of
    all words seen after them. A context whose words are all too frequent to be discounted counts as
    if it had one token more, and frees that.
    """
    freed = sum(r * (1 - factors[r]) * seen[r - 1] for r in range(1, MOST_DISCOUNTED + 1))
    plus = (freed <= 0).astype(np.int64)
    total = totals + plus
    return total, (freed + plus) / total / (1 - mass)


# ---- blocks ------------------------------------------------------------------------------------


def blocks(docs: DataFrame, id_col: str, text_col: str, held_out) -> DataFrame:
    """One row per block of texts, in a table that is bucketed by block."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number, size, codes, ids, held, parts = 0, 0, Codes(), [], [], []

        def block() -> pa.RecordBatch:
            lengths = np.array([len(p) for p in parts])
            tokens = np.concatenate(parts)
            train = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(tokens[train], minlength=len(codes)).astype(np.int64)
            hashes = np.fromiter((xxh64_intdigest(w) for w in codes), np.uint64, len(codes))
            columns = {
                "block": pa.array([first + number], pa.int64()),
                "ids": pa.array([ids], pa.list_(kind)),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "lengths": pa.array([pack(lengths)], pa.binary()),
                "tokens": pa.array([pack(tokens)], pa.binary()),
                "words": pa.array([hashes.tobytes()], pa.binary()),
                "counts": pa.array([pack(counts)], pa.binary()),
                "n_tokens": pa.array([len(tokens)], pa.int64()),
                "n_words": pa.array([len(codes)], pa.int64()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            kind = batch.schema.field("id").type
            for i in range(batch.num_rows):
                if not codes:
                    codes[END] = 0
                words = (batch.column("text")[i].as_py() or "").encode().lower().split()  # ASCII only
                words.append(END)
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
                ids.append(batch.column("id")[i].as_py())
                held.append(batch.column("held")[i].as_py())
                size += sum(map(len, words))
                if size >= BLOCK_BYTES:
                    yield block()
                    number, size, codes, ids, held, parts = number + 1, 0, Codes(), [], [], []
        if parts:
            yield block()

    schema = (
        f"block bigint, ids array<{id_type}>, held array<boolean>, lengths binary, tokens binary, words binary, "
        "counts binary, n_tokens bigint, n_words bigint"
    )
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = rows.mapInArrow(gather, schema).write.bucketBy(buckets, "block")
    written.option("path", new_folder(spark, "blocks")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay as long as the folder
    return table


MESSAGE = "kind string, part int, block bigint, a binary, b binary, c binary, d binary, stats array<bigint>"


def message(kind: str, part: int, block: int | None, *data: bytes, stats: list[int] | None = None) -> tuple:
    return (kind, part, block, *data, *[None] * (4 - len(data)), stats)


def messages(rows: list[tuple]) -> pa.Table:
    types = [pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int64())]
    names = ["kind", "part", "block", "a", "b", "c", "d", "stats"]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def totals(sent: DataFrame) -> list[int]:
    """The statistics of all parts, added up."""
    cells = sent.filter("kind = 'stats'").select(F.posexplode("stats").alias("place", "value"))
    return [r.value for r in cells.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()]


def counts_of_counts(counts: np.ndarray) -> list[int]:
    seen = counts[(counts > 0) & (counts <= MOST_DISCOUNTED + 1)]
    return np.bincount(seen, minlength=MOST_DISCOUNTED + 2)[1:].tolist()


# ---- words -------------------------------------------------------------------------------------


def word_parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (hashes % np.uint64(parts)).astype(np.int64)


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places) for the parts that occur, in order; the work does not grow with the number of parts."""
    order = np.argsort(part, kind="stable")
    present, starts = np.unique(part[order], return_index=True)
    yield from zip(present.tolist(), np.split(order, starts[1:]) if len(starts) else [], strict=True)


def count_words(corpus: DataFrame, parts: int) -> DataFrame:
    """Messages: per part the table of its words, per part and block their numbers and counts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.frombuffer(row["words"], np.uint64), unpack(row["counts"])
                part = word_parts(hashes, parts)
                for p, mine in by_part(part):
                    sent = message("words", p, row["block"], hashes[mine].tobytes(), pack(counts[mine]))
                    yield from messages([sent]).to_batches()

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        pieces = [np.frombuffer(r["a"], np.uint64) for r in rows]
        words, place = np.unique(np.concatenate(pieces), return_inverse=True)
        seen = np.zeros(len(words), np.int64)
        np.add.at(seen, place, np.concatenate([unpack(r["b"]) for r in rows]))
        part = rows[0]["part"]
        order = np.argsort(-seen, kind="stable")  # small numbers for frequent words pack well
        numbers = np.empty(len(words), np.int64)
        numbers[order] = np.arange(len(words)) * parts + part
        known = seen > 0
        out = [
            message("table", part, None, words[known].tobytes(), pack(numbers[known]), pack(seen[known])),
            message("stats", part, None, stats=[int(seen.sum()), int(known.sum()), *counts_of_counts(seen)]),
        ]
        start = 0
        for r, piece in zip(rows, pieces, strict=True):
            mine = place[start : start + len(piece)]
            start += len(piece)
            out.append(message("words", part, r["block"], pack(numbers[mine]), pack(seen[mine])))
        return messages(out)

    sent = corpus.select("block", "words", "counts").mapInArrow(split, MESSAGE)
    return durable(sent.groupBy("part").applyInArrow(count, MESSAGE), "unigrams")


# ---- n-grams -----------------------------------------------------------------------------------


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A hash of whole numbers."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Layout:
    """How n-grams are dealt out: contexts of more than ``spread`` tokens go to several parts."""

    word_parts: int
    parts: int
    spread: int

    def shares(self, context_counts: np.ndarray) -> np.ndarray:
        return np.where(context_counts > self.spread, context_counts // self.spread + 1, 1)

    def part(self, contexts: np.ndarray, context_counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        share = mixed(words) % self.shares(context_counts).astype(np.uint64)
        return (mixed(contexts.astype(np.uint64) + (share << np.uint64(40))) % np.uint64(self.parts)).astype(np.int64)


class Block:
    """A block's texts, and its words' numbers and counts."""

    def __init__(self, row: dict, words: list[dict], layout: Layout):
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        self.lengths, self.tokens = unpack(row["lengths"]), unpack(row["tokens"])
        hashes = np.frombuffer(row["words"], np.uint64)
        self.number, self.count = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        places = dict(by_part(word_parts(hashes, layout.word_parts)))
        for sent in words:
            mine = places[sent["part"]]
            self.number[mine], self.count[mine] = unpack(sent["a"]), unpack(sent["b"])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.layout = layout

    def previous(self, codes: np.ndarray, first: int) -> np.ndarray:
        """Per token the code of the token before it, and ``first`` where a text begins."""
        before = np.empty_like(codes)
        before[1:] = codes[:-1]
        before[self.starts] = first
        return before

    def bigrams(self, unigrams: Unigrams) -> Level:
        """The end mark, code 0, is the context of a first word."""
        known = (self.count > 0)[self.tokens]
        low = unigrams.probability(self.count)[self.tokens]
        return Level(self, self.previous(self.tokens, 0), self.number, self.count, known, low)


class Level:
    """The n-grams of a block that may have been counted, each a context and a word.

    context_of: per token the local code of its context; numbers and counts: per code the context's
    number, the same in all blocks, and how often it is one in the training texts; possible: whether the
    token's shorter n-gram was counted; low: the token's probability by the shorter ones.
    """

    def __init__(self, block: Block, context_of, numbers, counts, possible, low):
        self.block, self.context_of, self.numbers, self.counts, self.low = block, context_of, numbers, counts, low
        self.known = possible & (counts[context_of] > 0)
        keys = context_of[self.known] * len(block.number) + block.tokens[self.known]
        grams, first, self.gram = np.unique(keys, return_index=True, return_inverse=True)
        self.context, self.word = grams // len(block.number), grams % len(block.number)
        self.gram_low = low[self.known][first]
        # contexts that go whole to one part, each with the part that knows its sums
        codes, layout = np.unique(context_of), block.layout
        codes = codes[counts[codes] > 0]
        self.spread_codes = codes[layout.shares(counts[codes]) > 1]
        self.codes = codes[layout.shares(counts[codes]) == 1]
        no_word = np.zeros(len(self.codes), np.int64)
        self.code_part = layout.part(numbers[self.codes], counts[self.codes], no_word)
        self.gram_part = layout.part(numbers[self.context], counts[self.context], block.number[self.word])

    def pieces(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, its n-grams, its contexts) as indices into grams and codes, in a fixed order."""
        grams, codes = dict(by_part(self.gram_part)), dict(by_part(self.code_part))
        none = np.empty(0, np.int64)
        for p in sorted(grams.keys() | codes.keys()):
            yield p, grams.get(p, none), codes.get(p, none)

    def solve(self, answers: dict[int, dict], factors: np.ndarray, shared: dict[int, np.ndarray]) -> np.ndarray:
        """The probability of every token, from the parts' answers: that of its n-gram, or the context's
        backoff weight times that of the shorter one."""
        self.seen = np.zeros(len(self.context), np.int64)
        self.gram_numbers = np.zeros(len(self.context), np.int64)
        sums, mass = np.zeros((MOST_DISCOUNTED, len(self.counts))), np.zeros(len(self.counts))
        for p, grams, code_index in self.pieces():
            self.seen[grams] = unpack(answers[p]["a"])
            if answers[p]["d"] is not None:
                self.gram_numbers[grams] = unpack(answers[p]["d"])
            codes = self.codes[code_index]
            sums[:, codes] = unpack(answers[p]["b"]).reshape(MOST_DISCOUNTED, -1)
            mass[codes] = unpack(answers[p]["c"], np.float64)
        for code in self.spread_codes.tolist():
            found = shared[int(self.numbers[code])]
            sums[:, code], mass[code] = found[:-1], found[-1]
        total, weight = context_weights(self.counts, sums, mass, factors)
        weight[self.counts == 0] = 1.0
        probability = weight[self.context_of] * self.low
        counted = self.seen[self.gram]
        whole = discounted(counted, factors) / total[self.context[self.gram]]
        probability[self.known] = np.where(counted > 0, whole, probability[self.known])
        return probability

    def longer(self, probability: np.ndarray) -> Level:
        """The next order, once this one is solved. Codes of contexts: 0 for nothing but end marks, which
        come as often as texts, 1 for those never counted, and from 2 on this order's n-grams."""
        counted = self.seen > 0
        codes = np.ones(len(self.known), np.int64)
        codes[self.known] = np.where(counted[self.gram], self.gram + 2, 1)
        numbers = np.concatenate([np.zeros(2, np.int64), self.gram_numbers])
        counts = np.concatenate([[self.block.count[0], 0], self.seen])
        return Level(self.block, self.block.previous(codes, 0), numbers, counts, codes > 1, probability)


@dataclass(frozen=True)
class Solved:
    """What all blocks need to know of an order besides the answers to their own questions."""

    factors: np.ndarray
    shared: dict[int, np.ndarray]


def climbed(row: dict, sent: list[dict], layout: Layout, unigrams: Unigrams, solved: list[Solved]) -> Level:
    """The block's level above the solved orders; its ``low`` has the probabilities so far."""
    block = Block(row, [m for m in sent if m["kind"] == "words"], layout)
    level = block.bigrams(unigrams)
    for order, known in enumerate(solved, 2):
        answers = {m["part"]: m for m in sent if m["kind"] == kind_of(order)}
        level = level.longer(level.solve(answers, known.factors, known.shared))
    return level


def kind_of(order: int) -> str:
    return f"order {order}"


def with_blocks(corpus: DataFrame, sent: DataFrame, function, schema: str) -> DataFrame:
    """``function(block row, messages)`` for every block: only the messages are shuffled."""

    def call(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        return function(row, right.to_pylist())

    return corpus.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(call, schema)


def count_grams(
    corpus: DataFrame, sent: DataFrame, layout: Layout, unigrams: Unigrams, solved: list[Solved], last: bool
) -> DataFrame:
    """The order above the solved ones. Messages: per part the table of its n-grams and the sums of spread
    contexts, per part and block the counts of its n-grams, the sums of its contexts, and, unless this
    order is the last, numbers for the n-grams, which are contexts of the next."""
    order = len(solved) + 2

    def split(row: dict, messages_in: list[dict]) -> pa.Table:
        level = climbed(row, messages_in, layout, unigrams, solved)
        block = level.block
        train = np.repeat(~block.held, block.lengths)[level.known]
        seen = np.bincount(level.gram[train], minlength=len(level.context)).astype(np.int64)
        out = []
        for p, grams, codes in level.pieces():
            contexts, following = level.context[grams], level.word[grams]
            numbers = np.concatenate([level.numbers[contexts], block.number[following], seen[grams]])
            asked = pack(level.numbers[level.codes[codes]])
            # below bigrams lie unigrams, whose probabilities follow from counts, which pack better
            low = block.count[following] if order == 2 else level.gram_low[grams]
            out.append(message("grams", p, row["block"], pack(numbers), pack(level.counts[contexts]), asked, pack(low)))
        return messages(out)

    def count(table: pa.Table) -> pa.Table:
        rows = table.select(["part", "block", "a", "b", "c", "d"]).to_pylist()
        contexts, words, seen, context_counts, lows = ([] for _ in range(5))
        for r in rows:
            for part, into in zip(np.split(unpack(r["a"]), 3), (contexts, words, seen), strict=True):
                into.append(part)
            context_counts.append(unpack(r["b"]))
            lows.append(unigrams.probability(unpack(r["d"])) if order == 2 else unpack(r["d"], np.float64))
        sizes = [len(c) for c in contexts]
        context, word, seen, context_count, low = map(np.concatenate, (contexts, words, seen, context_counts, lows))
        sort = np.lexsort((word, context))
        context, word = context[sort], word[sort]
        new = np.ones(len(sort), bool)
        new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
        group = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        counts = np.add.reduceat(seen[sort], firsts) if len(firsts) else np.empty(0, np.int64)
        answer, part = np.empty(len(sort), np.int64), rows[0]["part"]
        numbers, number = np.empty(len(sort), np.int64), np.zeros(len(counts), np.int64)
        kept = counts > 0
        number[kept] = np.arange(int(kept.sum())) * layout.parts + part + 1
        if len(firsts):
            answer[sort], numbers[sort] = counts[group], number[group]
        context, word = context[firsts], word[firsts]
        context_count, low = context_count[sort][firsts], low[sort][firsts]
        # sums per context
        opens = np.ones(len(context), bool)
        opens[1:] = context[1:] != context[:-1]
        heads = np.flatnonzero(opens)
        rates = range(1, MOST_DISCOUNTED + 1)
        sums = [np.add.reduceat((counts == r).astype(np.int64), heads) for r in rates] if len(heads) else []
        mass = np.add.reduceat(np.where(kept, low, 0.0), heads) if len(heads) else np.empty(0)
        names, shared = context[heads], layout.shares(context_count[heads]) > 1
        out = [
            message("table", part, None, pack(context[kept]), pack(word[kept]), pack(counts[kept])),
            message("stats", part, None, stats=counts_of_counts(counts)),
        ]
        if shared.any():
            spread = np.concatenate([names[shared], *(s[shared] for s in sums)])
            out.append(message("spread", part, None, pack(spread), pack(mass[shared])))
        start = 0
        for r, size in zip(rows, sizes, strict=True):
            asked = unpack(r["c"])
            found, weights = [np.zeros(len(asked), np.int64)] * MOST_DISCOUNTED, np.zeros(len(asked))
            if len(names):
                at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
                there = names[at] == asked  # a context without known words after it has no sums
                found = [np.where(there, s[at], 0) for s in sums]
                weights = np.where(there, mass[at], 0.0)
            mine = slice(start, start + size)
            data = [pack(answer[mine]), pack(np.concatenate(found)), pack(weights)]
            out.append(message(kind_of(order), part, r["block"], *data, *([] if last else [pack(numbers[mine])])))
            start += size
        return messages(out)

    pieces = with_blocks(corpus, sent, split, MESSAGE)
    return durable(pieces.groupBy("part").applyInArrow(count, MESSAGE), f"order{order}")


def spread_sums(pairs: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the contexts that several parts share, at most MOST_SPREAD of them."""

    counted = [f"n{r}" for r in range(1, MOST_DISCOUNTED + 1)]

    def open_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = np.split(unpack(row["a"]), MOST_DISCOUNTED + 1)
                columns = [*(pa.array(n) for n in numbers), pa.array(unpack(row["b"], np.float64))]
                yield pa.RecordBatch.from_arrays(columns, ["word", *counted, "mass"])

    schema = ", ".join(["word bigint", *(f"{c} bigint" for c in counted), "mass double"])
    rows = pairs.filter("kind = 'spread'").select("a", "b").mapInArrow(open_up, schema)
    # masses are added up in a fixed order: reruns agree to the last bit
    masses = F.sort_array(F.collect_list("mass")).alias("m")
    summed = rows.groupBy("word").agg(*(F.sum(c).alias(c) for c in counted), masses)
    return {r.word: np.array([*(r[c] for c in counted), math.fsum(r.m)]) for r in summed.collect()}


# ---- scores ------------------------------------------------------------------------------------


def score(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    held_out_fold: int = 0,
    order: int = ORDER,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Training texts are those whose crc32 of the id, as text, has another remainder than
    ``held_out_fold`` by ``folds``. ``order`` is the length of the longest n-grams, 2 or more.
    """
    if order < 2:
        raise ValueError(f"order {order} has no contexts")
    corpus = blocks(docs, id_col, text_col, crc_remainder(id_col, folds) == held_out_fold)
    size = corpus.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_words").alias("words")).first()
    word_part_count = max(1, math.ceil((size.words or 0) / PART_WORDS))
    words = count_words(corpus, word_part_count)
    tokens, distinct, *ones = totals(words) or [0, 0, *[0] * (MOST_DISCOUNTED + 1)]
    unigrams = Unigrams.of(tokens, distinct, ones)
    spread = max(PART_GRAMS, tokens // MOST_SPREAD)
    layout = Layout(word_part_count, max(1, math.ceil((size.tokens or 0) / PART_GRAMS)), spread)
    sent, solved = words.filter("kind = 'words'"), []
    for n in range(2, order + 1):
        grams = count_grams(corpus, sent, layout, unigrams, solved, n == order)
        factors = discounts(totals(grams) or [0] * (MOST_DISCOUNTED + 1))
        solved.append(Solved(factors, spread_sums(grams)))
        sent = sent.unionByName(grams.filter(F.col("kind") == kind_of(n)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def evaluate(row: dict, messages_in: list[dict]) -> pa.Table:
        level = climbed(row, messages_in, layout, unigrams, solved[:-1])
        answers = {m["part"]: m for m in messages_in if m["kind"] == kind_of(order)}
        probability = level.solve(answers, solved[-1].factors, solved[-1].shared)
        block = level.block
        base = unigrams.base(block.count)[block.tokens]
        known = (block.count > 0)[block.tokens].astype(np.int64)

        def per_text(values: np.ndarray) -> pa.Array:
            return pa.array(np.add.reduceat(values, block.starts))

        return pa.table(
            {
                "id": pa.array(block.ids, id_arrow),
                "held_out": pa.array(block.held),
                "n_tokens": pa.array(block.lengths),
                "n_known": per_text(known),
                "train_tokens": pa.array(np.full(len(block.lengths), unigrams.tokens)),
                "base_score": per_text(base),
                "score": per_text(np.log10(probability)),
            }
        )

    id_arrow = to_arrow_type(docs.schema[id_col].dataType)
    schema = (
        f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return with_blocks(corpus, sent, evaluate, schema)
