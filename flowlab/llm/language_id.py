"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds (multiplies) its letters'
vectors, each permuted (rotated) by its place; a text's vector bundles (adds) those of its n-grams,
and a language's prototype the vectors of its training texts at equal length, so that one long text
weighs no more than a short one. A text gets the language whose prototype has the largest cosine.

Letters are the characters for which ``str.isalpha`` holds, in simple lower case. Everything between
two words counts as one space, and a text begins and ends with one, so n-grams know word ends.

Bundles are sums of whole numbers (texts' vectors are rounded to a grid of 2**-20): any order,
partition or retry gives the same prototypes. Each task bundles its own texts, so what is shuffled is
one vector per task and language, and the driver gets one per language. Long texts are read in pieces
and lose no n-gram.

``fit_usual`` and ``typical`` tell texts in none of the learned languages. What a text's n-grams reach on
average in the direction of its language's prototype is compared with what held-out texts reach; a text
is rejected if it falls short by more deviations than all but one in a thousand of those do, where the
deviation is that of a text of as many n-grams.

Rows: a null text, or one without letters, is ``und`` with score 0. A text with a null language
teaches nothing. Of equal cosines the first language in order of code points wins; a negative cosine
scores 0. Without any training text all is ``und``. Repeated rows count as often as they occur. Other
columns pass through; the two that are added replace their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm.common import tidy, whole_row
from flowlab.sources.storage import durable

SPACE = 32
DIMS = 1024
DIMS_AT_A_TIME = 256
GRAM = 3
SEED = 42
UNDETERMINED = "und"
#: Characters read, and texts handled, at a time.
PIECE = 1 << 18
GRID = 1 << 20
TEXTS = 256


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space for what is no letter."""
    table = np.full(0x110000, SPACE, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            lower = chr(c).lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


def symbols(text: str) -> Iterator[np.ndarray]:
    """The letters of a text and single spaces, in pieces that overlap by what an n-gram needs."""
    last = np.array([SPACE], np.uint32)
    for start in range(0, len(text), PIECE):
        codes = np.frombuffer(text[start : start + PIECE].encode("utf-32-le"), np.uint32)
        piece = np.concatenate([last, letters()[codes]])
        space = piece == SPACE
        again = np.concatenate([[False], space[1:] & space[:-1]])
        again[: len(last)] = False
        piece = piece[~again]
        if start + PIECE >= len(text) and piece[-1] != SPACE:
            piece = np.append(piece, np.uint32(SPACE))
        yield piece
        last = piece[-(GRAM - 1) :]


def gram_codes(piece: np.ndarray) -> np.ndarray:
    """One number per n-gram of three symbols of 21 bits."""
    if len(piece) < GRAM:
        return np.empty(0, np.int64)
    wide = piece.astype(np.int64)
    return (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]


@lru_cache(maxsize=1)
def _letter_memory(dims: int, seed: int) -> dict[int, np.ndarray]:
    return {}


def letter_vectors(codes: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """The random vectors of these letters; they depend on seed and letter only."""
    known = _letter_memory(dims, seed)
    for c in codes.tolist():
        if c not in known:
            known[c] = np.random.default_rng((seed, c)).integers(0, 2, dims, np.int8) * np.int8(2) - np.int8(1)
    return np.stack([known[c] for c in codes.tolist()])


def gram_vectors(grams: np.ndarray, dims: int, seed: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Bound vectors of distinct n-grams, some dimensions at a time: the first letter rotated twice, the
    second once."""
    places = np.stack([grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF])
    used, index = np.unique(places, return_inverse=True)
    index = index.reshape(places.shape)
    base = letter_vectors(used, dims, seed)
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    for start in range(0, dims, DIMS_AT_A_TIME):
        part = slice(start, start + DIMS_AT_A_TIME)
        yield part, first[:, part][index[0]] * second[:, part][index[1]] * base[:, part][index[2]]


def bundles(
    owners: list[int], texts: list[str | None], count: int, dims: int, seed: int, grams_of: np.ndarray | None = None
) -> np.ndarray:
    """``count`` vectors; text i is added to vector owners[i], and its n-grams are counted in ``grams_of``."""
    total = np.zeros((count, dims))

    def add(parts: list[np.ndarray], whose: list[np.ndarray]) -> None:
        grams, index = np.unique(np.concatenate(parts), return_inverse=True)
        if len(grams):
            cells = np.concatenate(whose) * len(grams) + index
            counts = np.bincount(cells, minlength=count * len(grams)).reshape(count, -1).astype(np.float32)
            for part, vectors in gram_vectors(grams, dims, seed):
                # single precision is exact here: all sums stay below 2**24
                total[:, part] += counts @ vectors.astype(np.float32)

    parts, whose, size = [], [], 0
    for owner, text in zip(owners, texts, strict=True):
        for piece in symbols(text or ""):
            codes = gram_codes(piece)
            parts.append(codes)
            whose.append(np.full(len(codes), owner, np.int64))
            size += len(codes)
            if grams_of is not None:
                grams_of[owner] += len(codes)
            if size >= 4 * PIECE:
                add(parts, whose)
                parts, whose, size = [], [], 0
    if parts:
        add(parts, whose)
    return total


def on_grid(vectors: np.ndarray) -> np.ndarray:
    """Vectors at equal length in whole numbers; zero stays zero."""
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.rint(vectors * (GRID / np.where(lengths > 0, lengths, 1))).astype(np.int64)


@dataclass(frozen=True)
class Profiles:
    """Languages in order of code points and their prototypes, one row each."""

    languages: list[str]
    prototypes: np.ndarray
    seed: int = SEED

    def compare(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.evidence(texts)[:2]

    def evidence(self, texts: list[str | None]) -> tuple[list[str], list[float], list[int], list[float]]:
        """Per text its language and cosine, its n-grams, and how far they reach on average in the
        direction of the language's prototype."""
        dims, grams = self.prototypes.shape[1], np.zeros(len(texts), np.int64)
        vectors = bundles(list(range(len(texts))), texts, len(texts), dims, self.seed, grams)
        lengths = np.linalg.norm(vectors, axis=1)
        known = np.linalg.norm(self.prototypes, axis=1)
        scale = np.outer(lengths, known)
        cosines = np.divide(vectors @ self.prototypes.T, scale, out=np.zeros_like(scale), where=scale > 0)
        best = cosines.argmax(axis=1) if self.languages else np.zeros(len(texts), int)
        names, scores, reach = [], [], []
        for i, text in enumerate(texts):
            if not self.languages or not text or not any(map(str.isalpha, text)):
                names.append(UNDETERMINED)
                scores.append(0.0)
                reach.append(0.0)
            else:
                cosine = cosines[i, best[i]]
                names.append(self.languages[best[i]])
                scores.append(float(min(1.0, max(0.0, cosine))))
                reach.append(float(cosine * lengths[i] / max(1, grams[i])))
        return names, scores, grams.tolist(), reach


def learn(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", dims: int = DIMS, seed: int = SEED
) -> Profiles:
    """The prototypes of all languages, from every text with a language."""
    labelled = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    @tidy
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                langs = part.column("lang").to_pylist()
                made = bundles(list(range(len(langs))), part.column("text").to_pylist(), len(langs), dims, seed)
                for lang, vector in zip(langs, on_grid(made), strict=True):
                    sums[lang] = sums.get(lang, 0) + vector
        if sums:
            vectors = [v.tolist() for v in sums.values()]
            yield pa.record_batch([pa.array(list(sums)), pa.array(vectors, pa.list_(pa.int64()))], ["lang", "vector"])

    per_task = labelled.filter("lang IS NOT NULL").mapInArrow(bundle, "lang string, vector array<bigint>")
    cells = per_task.select("lang", F.posexplode("vector").alias("dim", "value"))
    rows = cells.groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()  # languages x dims
    languages = sorted({r.lang for r in rows})
    place = {name: i for i, name in enumerate(languages)}
    prototypes = np.zeros((len(languages), dims))
    for r in rows:
        prototypes[place[r.lang], r.dim] = r.value
    return Profiles(languages, prototypes, seed)


def _with_evidence(docs: DataFrame, profiles: Profiles, text_col: str, added: list[T.StructField]) -> DataFrame:
    """``docs`` with the first of the values that ``Profiles.evidence`` gives, under the names of ``added``."""
    kept = [f for f in docs.schema.fields if f.name not in {a.name for a in added}]
    names = [f.name for f in kept]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                values = profiles.evidence(part.column(text_col).to_pylist())[: len(added)]
                columns = [part.column(n) for n in names]
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.float64())
                made = [pa.array(v, kind) for v, kind in zip(values, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([*columns, *made], [*names, *(a.name for a in added)])

    return docs.mapInArrow(run, T.StructType([*kept, *added]))


def predict(
    docs: DataFrame,
    profiles: Profiles,
    *,
    text_col: str = "text",
    lang_out: str = "lang_pred",
    score_out: str = "score",
) -> DataFrame:
    """``docs`` with the language and its cosine (0 to 1)."""
    added = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]
    return _with_evidence(docs, profiles, text_col, added)


EVIDENCE = [
    T.StructField("_language", T.StringType()),
    T.StructField("_cosine", T.DoubleType()),
    T.StructField("_grams", T.LongType()),
    T.StructField("_reach", T.DoubleType()),
]


@dataclass(frozen=True)
class Usual:
    """What texts of the learned languages look like: how far an n-gram reaches on average in each language,
    how much that varies with the n-grams of a text (per n-gram) and with the text itself, and how many
    of these deviations a text may fall short."""

    reach: dict[str, float]
    per_gram: float
    per_text: float
    most: float

    def short_of(self) -> Column:
        """By how many deviations a text falls short of its language; null where that was not fitted."""
        pairs = [part for name, mean in self.reach.items() for part in (F.lit(name), F.lit(mean))]
        mean = F.create_map(*pairs)[F.col("_language")] if pairs else F.lit(None).cast("double")
        share = F.col("_reach") / mean
        return (1 - share) / F.sqrt(self.per_gram / F.col("_grams") + self.per_text)


#: Variances are taken to be at least these, and a text may fall short by three deviations at least:
#: held-out texts that are all alike prove nothing narrower.
LEAST_PER_GRAM, LEAST_PER_TEXT, LEAST_MOST = 1.0, 0.0025, 3.0
#: The share of held-out texts of a learned language that may fall shorter than what is accepted.
LOST = 0.001


def fit_usual(held_out: DataFrame, profiles: Profiles, *, text_col: str = "text", lost: float = LOST) -> Usual:
    """Fitted on texts of the learned languages that taught nothing, all of them.

    The share r of a text's reach in its language's mean has an expected square error of
    per_gram / n-grams + per_text; both come from one weighted regression. No length is special: a
    text of few n-grams is uncertain by itself, so it is not rejected for what it lacks.
    """
    found = durable(_with_evidence(held_out.select(F.col(text_col).alias("text")), profiles, "text", EVIDENCE).drop("text"), "evidence")
    found = found.filter(F.col("_language") != UNDETERMINED)
    total = found.groupBy("_language").agg(F.sum(F.col("_reach") * F.col("_grams")).alias("all"), F.sum("_grams").alias("grams"))
    reach = {r._language: r.all / r.grams for r in total.collect()}  # a row per language
    start = Usual(reach, LEAST_PER_GRAM, LEAST_PER_TEXT, LEAST_MOST)
    if not reach:
        return start
    pairs = [part for name, mean in reach.items() for part in (F.lit(name), F.lit(mean))]
    error = F.pow(F.col("_reach") / F.create_map(*pairs)[F.col("_language")] - 1, 2)
    u = 1 / F.col("_grams")
    weight = 1 / F.pow(2 * u + 0.01, 2)
    sums = found.select(u.alias("u"), error.alias("y"), weight.alias("w")).agg(
        *(F.sum(F.expr(e)).alias(n) for n, e in (("uu", "w*u*u"), ("u", "w*u"), ("one", "w"), ("uy", "w*u*y"), ("y", "w*y")))
    )
    s = sums.first()
    free = s.uu * s.one - s.u * s.u
    if free > 1e-9 * s.uu * s.one:
        per_gram, per_text = (s.uy * s.one - s.y * s.u) / free, (s.y * s.uu - s.uy * s.u) / free
    else:
        per_gram, per_text = s.uy / s.uu, 0.0
    usual = Usual(reach, max(LEAST_PER_GRAM, per_gram), max(LEAST_PER_TEXT, per_text), LEAST_MOST)
    tail = found.agg(F.percentile_approx(usual.short_of(), 1 - lost, 10_000).alias("short"), F.count("*").alias("texts")).first()
    # fewer texts than one in ``lost`` do not reach that far into the tail, which falls like a normal one
    further = max(1.0, math.log(1 / lost) / math.log(max(2, tail.texts))) ** 0.5
    return Usual(reach, usual.per_gram, usual.per_text, max(LEAST_MOST, tail.short * further))


def typical(docs: DataFrame, profiles: Profiles, usual: Usual, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has letters and does not fall short of its language; those of a
    language for which that was not fitted stay."""
    rows = docs.select(F.col(text_col).alias("text"), whole_row(docs).alias("row"))
    found = _with_evidence(rows, profiles, "text", EVIDENCE)
    near = F.coalesce(usual.short_of() <= usual.most, F.lit(True))
    return found.filter((F.col("_language") != UNDETERMINED) & near).select("row.*")


def with_letters(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter."""
    return docs.filter(F.col(text_col).rlike(r"\p{L}"))
