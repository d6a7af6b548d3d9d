"""Mixing sources to target weights by repetition rates, in DataFrame functions only.

Words are added up per source, each source gets a target, and a document of a source with rate
``target / size`` is emitted ``floor(rate)`` times plus once more with the remaining fraction as
probability. The draw is a hash of seed and document id, so reruns and other file layouts agree.

Rows: a null text has size 0 and is emitted like others of its source. A null source is a source
of its own. Repeated rows are documents of their own; those that share an id share the draw, and a
null id draws as the empty text does. A source without words has rate 0. An empty table gives an
empty mix. Other columns pass through ``mix``; the columns that ``plan`` adds replace any of the
same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import join_narrow, text_or_empty, whole_row, words_between

BETWEEN = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
SEED = 42


def word_count(text: str) -> Column:
    return F.size(words_between(text_or_empty(text), BETWEEN)).cast("bigint")


def draw(column: str, seed: int = SEED) -> Column:
    """A double in [0, 1) that depends on seed and value only: 52 bits of an md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS
) -> DataFrame:
    """Target per source, from rows of (source, size).

    Sources in order of code points, null last, take the weights in turn. A target above ``most``
    times its source is cut to that, and the excess goes to the others by weight until none is
    above. That end state is one level: ordered by ``cap / weight``, the sources up to some place
    get their cap and the rest shares what is left by weight, so running sums find it without
    iteration. The windows see one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    turn = F.array(*map(F.lit, weights))
    levels = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.get(turn, F.col("place") % len(weights)).cast("bigint"))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("given", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn(
            "waiting",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        )
        .withColumn(
            "capped",
            F.col("cap") * F.col("waiting") <= (F.col("total") - F.col("given")) * F.col("weight"),
        )
    )
    capped = F.col("capped")
    return (
        levels.withColumn("full", F.sum(F.when(capped, F.col("cap")).otherwise(0)).over(everything))
        .withColumn("open", F.sum(F.when(capped, 0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(capped, F.col("cap").cast("double")).otherwise(
                (F.col("total") - F.col("full")) * F.col("weight") / F.col("open")
            ),
        )
        .select("source", "source_size", "target")
    )


ADDED = ("size", "source_size", "target", "rate", "copies")


def _planned(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """Each row of ``docs`` as the struct ``_row``, with its plan.

    Two scans: the first adds up sizes per source, partial sums first, so a hot source is one row
    per task; the second joins each document with its source's target. There are as many targets as
    sources; they are counted, and broadcast unless there are very many.
    """
    sized = docs.select(
        whole_row(docs).alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        word_count(text_col).alias("size"),
    )
    targets = source_targets(
        docs.select(F.col(source_col).alias("source"), word_count(text_col).alias("size")), weights, share, most
    )
    same = F.col("_source").eqNullSafe(F.col("source"))
    whole = F.floor("rate")
    extra = (draw("_id", seed) < F.col("rate") - whole).cast("bigint")
    return (
        join_narrow(sized, targets, same, "left")
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("copies", whole + extra)
    )


def plan(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with size, source_size, target, rate and copies; they replace columns of these names."""
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c.lower() not in ADDED]
    return _planned(docs, **options).select(*kept, *ADDED)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as its plan says, with its own columns."""
    repeats = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return _planned(docs, **options).filter("copies > 0").select("_row", repeats.alias("_copy")).select("_row.*")
