"""License scans as an exact set-similarity join, in DataFrame functions only.

Texts are read as words and cut into overlapping blocks, long enough that any run of words as long as
a template lies whole in the block in which it starts. A block meets a template if it holds at least
``threshold`` of the template's distinct words. The join finds all such pairs without comparing all:

* order: the words of all templates are ordered by how often the corpus has them, rarest first;
* prefix: to hold ``need`` of n words, a block must hold one of the first ``n - need + 1``; only
  these words, mostly rare ones, lead from a block to a template;
* length: the block must have ``need`` distinct words;
* position: the words of the block from the leading one onward in that order, and those of the
  template, must still suffice;
* the words in common are then counted.

A phrase is a template that must be whole, and its words must follow each other; each place where they
do is counted once, in the block where it starts.

The templates are a parameter and small, so their index is broadcast: at most MOST_TEMPLATE_WORDS
words. One pass counts their words, one finds blocks; both are narrow. Only one short row per text
is shuffled, with results per text.

Rows: a null text is an empty one, without words. Rows with equal id and text get equal results. A
null id is an id like others. Other columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import lower_ascii, text_or_empty, words_between
from flowlab.sources.storage import durable

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
MOST_TEMPLATE_WORDS = 20_000


@dataclass(frozen=True)
class Template:
    label: str
    words: str  # lower case, one space between words
    whole: bool = False  # a phrase: all words, one after the other
    base: bool = False


# The phrases that the scan must report, and their labels.
BASE = (
    Template("mit", "under the mit license", whole=True, base=True),
    Template("apache-2", "apache license version 2", whole=True, base=True),
    Template("cc-by-nc", "cc by nc", whole=True, base=True),
)

# Sentences by which public licenses are recognised.
OWN = (
    Template("all-rights-reserved", "all rights reserved", whole=True),
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike international license"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
)


def words_of(text: str) -> Column:
    return words_between(lower_ascii(text_or_empty(text)), BETWEEN)


def word_order(docs: DataFrame, text_col: str, templates: Sequence[Template]) -> dict[str, int]:
    """Place of each template word, the one that the corpus has least first."""
    vocabulary = sorted({w for t in templates for w in t.words.split(" ")})
    if len(vocabulary) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates have {len(vocabulary)} words, more than {MOST_TEMPLATE_WORDS}")
    found = docs.select(F.explode(F.filter(words_of(text_col), lambda w: w.isin(vocabulary))).alias("word"))
    counts = {r.word: r["count"] for r in found.groupBy("word").count().collect()}  # at most the vocabulary
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def template_index(docs: DataFrame, templates: Sequence[Template], order: dict[str, int], threshold: float) -> DataFrame:
    """One row per template and word of its prefix."""
    rows = []
    for number, t in enumerate(templates):
        sequence = t.words.split(" ")
        distinct = sorted(set(sequence), key=order.__getitem__)
        need = len(distinct) if t.whole else math.ceil(threshold * len(distinct) - 1e-9)
        for place, word in enumerate(distinct[: len(distinct) - need + 1]):
            rows.append((word, order[word], place, number, t.label, t.whole, t.base, sequence, distinct, need))
    schema = (
        "word string, rank int, place int, template int, label string, whole boolean, base boolean, "
        "sequence array<string>, distinct array<string>, need int"
    )
    return docs.sparkSession.createDataFrame(rows, schema)


def leading_blocks(
    docs: DataFrame, id_col: str, text_col: str, leads: list[str], stride: int, length: int
) -> DataFrame:
    """(id, mark, n_words, leads): per text the blocks with a leading word, as (word, block number, words).

    Block k holds the words from ``k * stride`` on, ``length`` of them; a word is in one or two.
    """
    words = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("mark"), words_of(text_col).alias("words")
    )
    count = F.size("words")
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    led = F.arrays_overlap("words", F.array(*map(F.lit, leads)))  # most texts end here
    hits = F.when(led, F.filter(places, lambda i: F.get("words", i).isin(leads)))

    def blocks(i: Column) -> Column:
        last = F.floor(i / stride).cast("int")
        word = F.get("words", i)
        here = F.struct(word.alias("word"), last.alias("block"))
        before = F.struct(word.alias("word"), (last - 1).alias("block"))
        return F.when((last > 0) & (i < (last - 1) * stride + length), F.array(before, here)).otherwise(F.array(here))

    with_words = F.transform(
        F.array_distinct(F.flatten(F.transform("hits", blocks))),
        lambda b: F.struct(
            b["word"].alias("word"),
            b["block"].alias("block"),
            F.slice("words", b["block"] * stride + 1, F.lit(length)).alias("words"),
        ),
    )
    return words.withColumn("hits", hits).select(
        "id", "mark", count.cast("bigint").alias("n_words"), with_words.alias("leads")
    )


def matches(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = BASE + OWN,
    threshold: float = THRESHOLD,
    stride: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """All texts as (id, mark, n_words), and every block that meets a template:
    (id, mark, block, template, label, base, whole, share, starts)."""
    longest = max(len(t.words.split(" ")) for t in templates)
    stride = max(stride, longest)
    length = stride + longest - 1
    order = word_order(docs, text_col, templates)
    index = template_index(docs, templates, order, threshold)
    leads = sorted({r.word for r in index.select("word").collect()})
    texts = durable(leading_blocks(docs, id_col, text_col, leads, stride, length), "blocks")
    ranks = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    blocks = texts.select("id", "mark", F.explode("leads").alias("b")).select(
        "id", "mark", "b.*", F.array_distinct("b.words").alias("set")
    )
    paired = blocks.join(F.broadcast(index), "word")
    by_length = paired.filter(F.size("set") >= F.col("need"))
    in_order = F.filter(F.transform("set", lambda w: F.try_element_at(ranks, w)), lambda r: r >= F.col("rank"))
    # Seen from the first of its template's words that a block has, all shared words come later; what
    # a later leading word loses here is found from the first one.
    rest = F.least(F.size(in_order), F.size("distinct") - F.col("place"))
    by_position = by_length.filter(rest >= F.col("need"))
    shared = F.size(F.array_intersect("set", "distinct"))
    met = by_position.withColumn("shared", shared).filter("shared >= need")
    m = F.size("sequence")
    last = F.least(F.lit(stride), F.size("words") - m + 1) - 1
    starts = F.when(
        F.col("whole") & (last >= 0),
        F.filter(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice("words", i + 1, m) == F.col("sequence")
        ),
    )
    found = (
        met.withColumn("starts", F.transform(starts, lambda i: (F.col("block") * stride + i).cast("bigint")))
        .filter(~F.col("whole") | (F.size("starts") > 0))
        .withColumn("share", F.col("shared") / F.size("distinct"))
        .groupBy("id", "mark", "block", "template")  # several leading words, or repeated rows
        .agg(*(F.first(c).alias(c) for c in ("label", "base", "whole", "share", "starts")))
    )
    return texts.select("id", "mark", "n_words"), found


def scan(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    texts, found = matches(docs, **options)
    base = F.col("base")
    per_text = found.groupBy(F.col("id").alias("found_id"), F.col("mark").alias("found_mark")).agg(
        F.sum(F.when(base, F.size("starts"))).alias("n_base"),
        F.min(F.when(base, F.array_min("starts"))).alias("first_word"),
        F.max(F.when(base, F.array_max("starts"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max("share").alias("score"),
    )
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("mark") == F.col("found_mark"))
    joined = texts.join(per_text, same, "left")
    names = {c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit("")) for c in ("base_labels", "labels")}
    return joined.select(
        "id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        *(column.alias(name) for name, column in names.items()),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
