from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.llm import spelling as s
from flowlab.llm.queries import ORACLES, op12_spelling
from tests.compare import differences
from tests.llm.edge import ROWS, edge_docs, no_docs

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def plain_words(rows, slip_every=None, least_times=3):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if slip_every:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % slip_every == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_times}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    rows = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return rows


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()))


def from_words(spark, words):
    return s.variants(spark.createDataFrame(list(words.items()), "word string, n bigint"))


def invented(seed, count, letters="abcdeé", shortest=5, longest=9):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randrange(shortest, longest + 1))) for _ in range(count)}
    return {w: r.choice([1, 1, 2, 3, 5, 8, 30, 400]) for w in sorted(words)}


def test_query_equals_sql(spark, sf_dir, con):
    assert differences(op12_spelling(spark, sf_dir), con, ORACLES["op12_spelling"]) == []


def test_equals_brute_force(spark):
    words = invented(1, 900)
    assert found(from_words(spark, words)) == sorted(plain_variants(words))


@pytest.mark.parametrize("cell, leaf, questions", [(40, 4, 17), (7, 1, 1000)])
def test_many_cells_lose_nothing(spark, monkeypatch, cell, leaf, questions):
    monkeypatch.setattr(s, "CELL_WORDS", cell)
    monkeypatch.setattr(s, "SAMPLE_WORDS", 60)
    words = invented(2, 700)
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").coalesce(1)
    trees = s.planted(frame)
    assert max(map(s.cells_of, trees.values())) > 2
    assert found(s.variants(frame)) == sorted(plain_variants(words))


def test_anagrams_and_rare_letters_are_told_apart(spark):
    """Words with equal letter counts, counts beyond the levels, classes shared by letters."""
    words = {"stale": 3, "least": 4, "tales": 50, "aaaaaaaab": 9, "aaaaaaaac": 2, "aaaaaaaabb": 1, "àãåaa": 5, "çéëaa": 9, "àãåab": 11}
    assert found(from_words(spark, words)) == sorted(plain_variants(words))


def test_forms_are_followed_to_the_last(spark):
    words = {"aaaaa" + "b" * i: 2**i for i in range(12)}
    rows = {r[0]: r for r in found(from_words(spark, words))}
    last = "aaaaa" + "b" * 11
    assert all(r[2] == last for r in rows.values()) and rows[last][1] is None
    assert sorted(rows.values()) == sorted(plain_variants(words))


def test_ties_take_the_first_in_code_point_order(spark):
    words = {"house": 1, "mouse": 7, "louse": 7, "éouse": 7, "rouse": 6}
    rows = {r[0]: r[1] for r in found(from_words(spark, words))}
    assert rows["house"] == "louse" and rows["rouse"] is None


def test_edges(spark):
    docs = edge_docs(spark)
    for every in (None, 2):
        words = plain_words(ROWS, every)
        counted = s.counted_words(docs, slip_every=every)
        assert dict(map(tuple, counted.collect())) == words
        assert found(s.variants(counted)) == sorted(plain_variants(words))
    assert s.variants(s.counted_words(no_docs(spark))).isEmpty()
    assert s.variants(s.counted_words(docs.withColumn("text", F.lit("42 !!")))).isEmpty()


def test_very_long_words(spark):
    long = "ab" * 30_000
    text = " ".join([long] * 9 + [long[:70] + long[71:]] * 3 + ["×÷÷××"] * 3)
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert found(s.variants(s.counted_words(docs))) == sorted(plain_variants(plain_words([(1, text)])))


def test_distance_is_a_lower_bound():
    r = random.Random(4)
    words = ["".join(r.choice("abcxyzéèàß") for _ in range(8)) for _ in range(400)]
    codes = s.thermometers(s.letter_rows(words))
    for i, word in enumerate(words):
        counts = Counter(word)
        apart = np.bitwise_count(codes ^ codes[i]).sum(axis=1)
        for other, d in zip(words, apart.tolist(), strict=True):
            theirs = Counter(other)
            assert d <= sum(abs(counts[c] - theirs[c]) for c in counts | theirs)


def test_each_word_is_in_one_cell_and_boxes_prune():
    words = list(invented(9, 4000, "abcdefgh", 7, 7))
    codes = s.thermometers(s.letter_rows(words))
    tree, cells = s.plant(codes, 100)
    assert cells == s.cells_of(tree) > 30
    home = np.concatenate([which for _, which in s.cells_near(tree, codes, 0)])
    assert sorted(home.tolist()) == list(range(len(words)))
    asked = sum(len(which) for _, which in s.cells_near(tree, codes, 2))
    assert asked < 0.8 * cells * len(words)
