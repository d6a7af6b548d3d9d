"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only.

A text's words (lower-cased A-Z, split at ASCII white space) make shingles of five; shorter texts are
one shingle. Of the shingles' 64-bit hashes, those below a fixed fraction of the hash space are kept.
Which hashes are kept does not depend on the text they come from, so sketches of any two texts hold
the same hashes of what they share: the sketch of several texts is made from their sketches (``merge``),
and shares of retained hashes estimate likeness (intersection over union) and containment also where
one text is a thousand times the other. A text without any hash below the threshold keeps its least
one, so only texts without words have an empty sketch; a merge drops it again where it has others.

``neighbours`` puts every document beside the next one in falling order of ids. No task sees the whole
order: ids are cut into ranges, each range is one window partition, and the first document of a range
is also sent to the range before it. Texts are shuffled once.

Rows: a null text counts as empty; it has the empty sketch, alike (1.0) to itself and 0.0 to others.
Repeated ids are ordered by their texts, and rows alike in both follow one another; rows of one id
share a task, whose sort and window spill. A null id has no place in the order: its row has no next
document. A single document is its own next. Other columns do not matter. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import lower_ascii, text_or_empty, words_between
from flowlab.operators.ranking import cut_points, default_buckets

BETWEEN = r"[\x20\x09-\x0D]+"
WORDS = 5
#: Of the 2**64 hashes, those in the first 2**-KEPT_BITS part are kept.
KEPT_BITS = 2


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(words: Column, width: int = WORDS) -> Column:
    """The hashes of all shingles of ``width`` words; of the whole sequence if it is shorter."""

    def hashes(each: Column) -> Column:
        count = F.size(each)
        many = F.transform(
            F.sequence(F.lit(0), count - width), lambda i: F.xxhash64(*(F.get(each, i + k) for k in range(width)))
        )
        return F.when(count >= width, many).when(count > 0, F.array(F.xxhash64(each))).otherwise(F.array().cast("array<bigint>"))

    return bound(F.transform(words, lambda word: F.xxhash64(word)), hashes)


def below(hashes: Column, bits: int = KEPT_BITS) -> Column:
    """The distinct hashes of the fixed fraction, in order; the least of all where there is none.

    Hashes are ordered as unsigned numbers with their sign bit flipped, so that the kept ones come first.
    """
    limit = -(2**63) + 2 ** (64 - bits)

    def chosen(all_of_them: Column) -> Column:
        kept = F.filter(all_of_them, lambda h: h < F.lit(limit))
        least = F.filter(F.array(F.array_min(all_of_them)), lambda h: h.isNotNull())
        return F.array_sort(F.array_distinct(F.when(F.exists(all_of_them, lambda h: h < F.lit(limit)), kept).otherwise(least)))

    return bound(hashes, chosen)


def sketch(text: Column, width: int = WORDS, bits: int = KEPT_BITS) -> Column:
    """The sketch of a text that is not null: an ordered array of bigint."""
    return below(shingle_hashes(words_between(lower_ascii(text), BETWEEN), width), bits)


def merge(one: Column, other: Column, bits: int = KEPT_BITS) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    return below(F.array_union(one, other), bits)


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of common shingles among all of two texts; two empty sketches are alike."""
    common = F.size(F.array_intersect(one, other))
    return F.when((F.size(one) == 0) & (F.size(other) == 0), 1.0).otherwise(
        common / (F.size(one) + F.size(other) - common)
    )


def containment(one: Column, other: Column) -> Column:
    """Estimated share of the first text's shingles that the second has; nothing is contained in all."""
    return F.when(F.size(one) == 0, 1.0).otherwise(F.size(F.array_intersect(one, other)) / F.size(one))


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash, as an unsigned number."""
    digits = F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h.bitwiseXOR(F.lit(-(2**63))))), 16, "0"))
    return F.array_join(digits, "")


def range_number(value: Column, cuts: list[float]) -> Column:
    """How many of the increasing ``cuts`` are not above the value, by halving."""
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    number = value.cast("double")
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(table, at + step - 1) <= number, at + step).otherwise(at),
    )


def neighbours(
    rows: DataFrame, made: dict[str, Column], id_col: str = "id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """(id, text, *made) with ``next_<name>`` for text and made columns: those of the next row in falling
    order of ids, and after the last the first. ``made`` is computed once per row, after the shuffle."""
    named = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = named.select("id").filter("id IS NOT NULL")
    cuts = cut_points(ids, "id", buckets or default_buckets(rows))
    place = range_number(F.col("id"), cuts)
    in_order = Window.orderBy("first_in")
    firsts = (  # at most one row per range
        ids.groupBy(place.alias("first_in"))
        .agg(F.max("id").alias("first"))
        .select("first", F.coalesce(F.lead("first_in").over(in_order), F.min("first_in").over(Window.partitionBy())).alias("also"))
    )
    own = F.struct(F.when(F.col("id").isNull(), -1 - F.spark_partition_id()).otherwise(place).alias("part"), F.lit(False).alias("lent"))
    lent = F.struct(F.col("also").alias("part"), F.lit(True).alias("lent"))
    sent = named.join(F.broadcast(firsts), F.col("id") == F.col("first"), "left").select(
        "id", "text", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, lent))).alias("to")
    )
    dealt = sent.select("id", "text", "to.part", "to.lent").repartition("part")
    along = Window.partitionBy("part").orderBy("lent", F.desc("id"), "text")
    names = ["text", *made]
    following = {f"next_{n}": F.when(F.col("id").isNotNull(), F.lead(n).over(along)) for n in names}
    return dealt.select("*", *(c.alias(n) for n, c in made.items())).select("*", *(c.alias(n) for n, c in following.items())).filter("NOT lent").drop("part", "lent")


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, bits: int = KEPT_BITS
) -> DataFrame:
    """(id, sketch, fingerprint) per document."""
    made = docs.select(F.col(id_col).alias("id"), sketch(text_or_empty(text_col), width, bits).alias("sketch"))
    return made.select("id", "sketch", fingerprint(F.col("sketch")).alias("fingerprint"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as much of the start of another."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.left(text, F.char_length(text) - third), F.left(following, third))


def compare_with_edited(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, bits: int = KEPT_BITS
) -> DataFrame:
    """Each document against itself edited, and against the next document: (id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, contained_edited, contained_next).

    Without a next document the text only loses its last third, and what compares with it is null.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    beside = neighbours(rows, {"sketch": sketch(F.col("text"), width, bits)})
    changed = beside.withColumn("edited", edited(F.col("text"), F.coalesce("next_text", F.lit(""))))
    both = changed.select(
        "id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "sketch",
        "next_sketch",
        sketch(F.col("edited"), width, bits).alias("edited_sketch"),
    )
    own, new, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        "id",
        "n_chars",
        "edited_sha256",
        fingerprint(own).alias("fingerprint"),
        fingerprint(new).alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"),
        F.when(following.isNotNull(), likeness(own, following)).alias("near_next"),
        containment(own, new).alias("contained_edited"),
        F.when(following.isNotNull(), containment(own, following)).alias("contained_next"),
    )
