"""Spelling variants: words that differ by one letter, grouped under the more frequent spelling.

A word becomes the vector of its letter counts. One edit moves it little: a replaced letter by at most
two in Manhattan distance, an inserted one by one. So all near pairs of a length pair (L, L or L, L+1)
are found by range searches in a k-d tree over the words of one length, whose planes cut at a count of
one letter and whose boxes are pruned by their distance to the word. What is found is verified letter
by letter. Counts are held as thermometers, four bits for each of 32 letter classes; a distance is then
the number of differing bits, and a count beyond four, or two rare letters in one class, can only make
it smaller, never hide a pair.

The tree has two storeys. The upper one is planted from a bounded sample of words per length (it steers
the balance only) and cuts the words of a length into cells, the work units. A word is sent to its own
cell and, as a question, to every cell whose box is near enough: of 2**k cells at most 1 + k + k(k-1)/2
for a replaced and 1 + k for an inserted letter. Inside a cell the tree goes on below, a storey of its own
in each task, which reads its questions as a stream. A cell answers with counts and the best neighbour
per word, not with pairs.

A word's form is its near word of most occurrences, if it has at least twice the word's. Forms of forms
are followed to the last by doubling; occurrences double with each step, so a few rounds suffice.

Rows: a null text has no words. A null id counts as empty text. Repeated rows count as often as they
occur. Of near words with equal occurrences the first in code-point order is the form. Other columns do
not matter. An empty table, or one without words, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import lower_ascii, text_or_empty, tidy
from flowlab.sources.storage import durable

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS = 5
LEAST_TIMES = 3
RATIO = 2
REPLACED, INSERTED = 2, 1  # how far one edit moves a word
CLASSES, LEVELS = 32, 4
LATIN = 26
#: Words of a cell, words per length that its tree is planted from, and the most cells of a length.
CELL_WORDS = 1 << 14
SAMPLE_WORDS = 1 << 15
MOST_CELLS = 1 << 10
#: Words of a last box, questions answered and pairs compared at a time.
LEAF_WORDS = 48
QUESTIONS = 1 << 15
PAIRS = 1 << 19
CELL_SHIFT = 20
MOST_ROUNDS = 20

Tree = int | tuple


# ---- words ---------------------------------------------------------------------------------


def slipped(run: Column, key: Column, every: int) -> Column:
    """The run, or in one of ``every`` cases without one code point; a hash of key and run decides which."""
    drawn = F.crc32(F.concat(key, F.lit(":"), run).cast("binary"))
    place = (drawn % F.char_length(run)).cast("int")
    cut = F.concat(F.left(run, place), F.substr(run, place + 2))
    return F.when(drawn % every == 0, cut).otherwise(run)


def counted_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip_every: int | None = None,
    least_letters: int = LEAST_LETTERS,
    least_times: int = LEAST_TIMES,
) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lower-cased, that are long and frequent enough.

    ``slip_every`` plants a slip in one of so many (document, run) pairs, to see that it is found.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key")
    runs = docs.select(key, F.explode(F.split(lower_ascii(text_or_empty(text_col)), f"[^{LETTERS}]+")).alias("run"))
    runs = runs.filter(F.char_length("run") >= least_letters)
    word = F.col("run") if slip_every is None else slipped(F.col("run"), F.col("key"), slip_every)
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_times)


# ---- letter counts and boxes ---------------------------------------------------------------


def letter_rows(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, in bytes if they fit."""
    rows = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    return rows.astype(np.uint8) if rows.max(initial=0) < 256 else rows


def thermometers(rows: np.ndarray) -> np.ndarray:
    """Letter counts as two 64-bit numbers per word: for each class as many low bits as the count."""
    wide = rows.astype(np.int64)
    classes = np.where((wide >= ord("a")) & (wide <= ord("z")), wide - ord("a"), LATIN + wide % (CLASSES - LATIN))
    cells = classes + CLASSES * np.arange(len(rows))[:, None]
    counts = np.bincount(cells.ravel(), minlength=len(rows) * CLASSES).reshape(-1, CLASSES)
    bits = (1 << np.minimum(counts, LEVELS)) - 1
    return (bits[:, 0::2] | bits[:, 1::2] << LEVELS).astype(np.uint8).view(np.uint64)


def box_distance(codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Manhattan distance of each word to a box of counts."""
    return np.bitwise_count((low & ~codes) | (codes & ~high)).sum(axis=1, dtype=np.uint8)


def best_bit(codes: np.ndarray) -> int | None:
    """The count that splits the words most evenly; None where all are alike."""
    bits = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little")
    uneven = np.abs(bits.mean(axis=0) - 0.5)
    best = int(uneven.argmin())
    return best if uneven[best] < 0.5 else None


def with_bit(codes: np.ndarray, bit: int) -> np.ndarray:
    return codes[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1) == 1


def plane(bit: int, above: bool) -> np.ndarray:
    """What a plane says of a box: the levels that are surely reached above it, or surely not below."""
    level, first = bit % LEVELS, bit - bit % LEVELS
    number = sum(1 << (first + k) for k in (range(level + 1) if above else range(level, LEVELS)))
    return np.array([number & (2**64 - 1), number >> 64], np.uint64)


def plant(codes: np.ndarray, most: float, first: int = 0) -> tuple[Tree, int]:
    """A tree of cells with at most so many of these words each, and the number after its last cell."""
    bit = best_bit(codes) if len(codes) > most else None
    if bit is None:
        return first, first + 1
    upper = with_bit(codes, bit)
    left, after = plant(codes[~upper], most, first)
    right, end = plant(codes[upper], most, after)
    return (bit, left, right), end


def cells_near(
    tree: Tree, codes: np.ndarray, radius: int, which: np.ndarray | None = None, low=None, high=None
) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, words within the radius of its box); with radius 0 each word is in one cell."""
    if which is None:
        which, low, high = np.arange(len(codes)), np.zeros(2, np.uint64), np.full(2, 2**64 - 1, np.uint64)
    if isinstance(tree, int):
        yield tree, which
        return
    bit, left, right = tree
    for child, low_, high_ in ((left, low, high & ~plane(bit, False)), (right, low | plane(bit, True), high)):
        near = which[box_distance(codes[which], low_, high_) <= radius]
        if len(near):
            yield from cells_near(child, codes, radius, near, low_, high_)


# ---- range search inside a cell ------------------------------------------------------------


def within(points: np.ndarray, asked: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (point, question) at most ``radius`` apart, by a k-d tree over the points."""
    waiting = [(np.arange(len(points)), np.arange(len(asked)))]
    while waiting:
        p, q = waiting.pop()
        here = points[p]
        low, high = np.bitwise_and.reduce(here, axis=0), np.bitwise_or.reduce(here, axis=0)
        q = q[box_distance(asked[q], low, high) <= radius]
        if not len(q):
            continue
        bit = best_bit(here) if len(p) > LEAF_WORDS else None
        if bit is not None:
            upper = with_bit(here, bit)
            waiting += [(p[upper], q), (p[~upper], q)]
            continue
        step = max(1, PAIRS // len(p))
        for start in range(0, len(q), step):
            part = q[start : start + step]
            others = asked[part]
            apart = np.bitwise_count(here[:, None, 0] ^ others[None, :, 0])
            apart += np.bitwise_count(here[:, None, 1] ^ others[None, :, 1])
            i, j = np.nonzero(apart <= radius)
            yield p[i], part[j]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether the longer word without one letter is the shorter one."""
    same = longer[:, :-1] == shorter
    first = np.where(same.all(axis=1), shorter.shape[1], same.argmin(axis=1))
    late = np.arange(shorter.shape[1]) >= first[:, None]
    return ((longer[:, 1:] == shorter) | ~late).all(axis=1)


def verified(points, asked, radius, letters, other_letters, check) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (point, question) of the range search whose letters pass the check."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for i, j in within(points, asked, radius):
        good = check(letters[i], other_letters[j])
        found.append((i[good], j[good]))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def best_of(targets: np.ndarray, neighbours: np.ndarray, words: list[str], times: np.ndarray):
    """(target, how many neighbours, the best neighbour): most times, then first in code-point order."""
    used, place = np.unique(neighbours, return_inverse=True)
    order = sorted(range(len(used)), key=lambda k: (-times[used[k]], words[used[k]]))
    rank = np.empty(len(used), np.int64)
    rank[order] = np.arange(len(used))
    sort = np.lexsort((rank[place], targets))
    ordered = targets[sort]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], np.diff(np.append(starts, len(ordered))), neighbours[sort][starts]


class Cell:
    """The words of a cell, all of one length, and answers to questions about them."""

    def __init__(self, words: list[str], times: list[int]):
        self.words, self.times = words, np.array(times, np.int64)
        self.letters = letter_rows(words)
        self.codes = thermometers(self.letters)

    def answer(self, words: list[str], times: list[int]) -> Iterator[pa.RecordBatch]:
        """What the words of the cell, and questions one letter shorter, learn from these questions,
        which are all of one length."""
        letters = letter_rows(words)
        same = len(words[0]) == self.letters.shape[1]
        if same:
            i, j = verified(self.codes, thermometers(letters), REPLACED, self.letters, letters, one_replaced)
        else:
            i, j = verified(self.codes, thermometers(letters), INSERTED, self.letters, letters, one_inserted)
        everyone, often = [*self.words, *words], np.concatenate([self.times, np.array(times, np.int64)])
        asked = j + len(self.words)
        for targets, neighbours in ((i, asked), (asked, i))[: 1 if same else 2]:
            if len(targets):
                yield learned(*best_of(targets, neighbours, everyone, often), everyone, often)


def learned(targets, counts, best, words, times) -> pa.RecordBatch:
    columns = {
        "word": pa.array([words[t] for t in targets.tolist()]),
        "n_near": pa.array(counts, pa.int64()),
        "near_n": pa.array(times[best]),
        "near": pa.array([words[b] for b in best.tolist()]),
    }
    return pa.record_batch(columns)


NEAR = "word string, n_near bigint, near_n bigint, near string"


@tidy
def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by cell, each cell's own words first and then its questions by length."""
    key, cell, own, asked = None, None, ([], []), ([], [])

    def close_own():
        nonlocal cell
        if cell is None and own[0]:
            cell = Cell(*own)

    def flush() -> Iterator[pa.RecordBatch]:
        close_own()
        if asked[0] and cell is not None:
            yield from cell.answer(*asked)
        asked[0].clear()
        asked[1].clear()

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("cell", "home", "word", "n"))
        for at, home, word, n in zip(*columns, strict=True):
            if at != key:
                yield from flush()
                if cell is not None:
                    yield from ask_itself(cell)
                key, cell, own = at, None, ([], [])
            if home:
                own[0].append(word)
                own[1].append(n)
                continue
            if asked[0] and (len(asked[0]) >= QUESTIONS or len(asked[0][0]) != len(word)):
                yield from flush()
            close_own()
            asked[0].append(word)
            asked[1].append(n)
    yield from flush()
    if cell is not None:
        yield from ask_itself(cell)


def ask_itself(cell: Cell) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(cell.words), QUESTIONS):
        part = slice(start, start + QUESTIONS)
        yield from cell.answer(cell.words[part], cell.times[part].tolist())


# ---- jobs ----------------------------------------------------------------------------------


def planted(words: DataFrame) -> dict[int, Tree]:
    """A tree per length. Lengths with more than one cell sample SAMPLE_WORDS words by hash, or a few more."""
    length = F.char_length("word")
    sizes = {r.length: r.words for r in words.groupBy(length.alias("length")).agg(F.count("*").alias("words")).collect()}
    trees: dict[int, Tree] = dict.fromkeys(sizes, 0)
    large = {n: size for n, size in sizes.items() if size > CELL_WORDS}
    if not large:
        return trees
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 20))
    chosen = F.lit(False)
    for n, size in large.items():
        chosen = chosen | ((length == n) & (drawn < max(1, (SAMPLE_WORDS << 20) // size)))
    samples: dict[int, list[str]] = {n: [] for n in large}
    for (word,) in words.filter(chosen).select("word").collect():
        samples[len(word)].append(word)
    for n, sample in samples.items():
        if sample:
            cells = min(MOST_CELLS, -(-large[n] // CELL_WORDS))
            trees[n] = plant(thermometers(letter_rows(sorted(sample))), len(sample) / cells)[0]
    return trees


def cells_of(tree: Tree) -> int:
    return 1 if isinstance(tree, int) else cells_of(tree[1]) + cells_of(tree[2])


def placed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(cell, home, word, n): every word in its own cell, and as a question in all that may hold near words."""

    def rows(batch: pa.RecordBatch, which: np.ndarray, length: int, cell: int, home: bool) -> pa.RecordBatch:
        number = pa.array(np.full(len(which), length << CELL_SHIFT | cell, np.int64))
        some = batch.take(pa.array(which))
        return pa.record_batch([number, pa.array(np.full(len(which), home)), *some.columns], ["cell", "home", "word", "n"])

    @tidy
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.utf8_length(batch.column("word")).to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                codes = thermometers(letter_rows(part.column("word").to_pylist()))
                own = np.empty(len(codes), np.int64)
                for cell, which in cells_near(trees[length], codes, 0):
                    own[which] = cell
                    yield rows(part, which, length, cell, True)
                for cell, which in cells_near(trees[length], codes, REPLACED):
                    yield rows(part, which[own[which] != cell], length, cell, False)
                if length + 1 in trees:
                    for cell, which in cells_near(trees[length + 1], codes, INSERTED):
                        yield rows(part, which, length + 1, cell, False)

    return words.mapInArrow(place, "cell bigint, home boolean, word string, n bigint")


def nearest(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): per word with near words their number and the best of them.

    ``words`` (word, n) holds each word once and is stored.
    """
    trees = planted(words)
    if not trees:
        return words.sparkSession.createDataFrame([], NEAR)
    tasks = min(sum(map(cells_of, trees.values())), 4 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = placed(words, trees).repartition(tasks, "cell")
    ordered = cells.sortWithinPartitions("cell", F.desc("home"), F.char_length("word"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return (
        ordered.mapInArrow(search, NEAR)
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that each word of (word, form) leads to, by doubling."""
    links = durable(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        above = links.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = links.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        step = durable(step, "roots")
        links = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return links
    raise RuntimeError(f"forms still lead on after {MOST_ROUNDS} rounds")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n); n is at least 1."""
    words = durable(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    known = words.join(nearest(words), "word", "left")
    strong = F.col("near_n") >= ratio * F.col("n")
    known = durable(
        known.select(
            "word",
            F.when(strong, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(strong, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
