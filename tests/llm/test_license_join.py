import re

import pytest

from flowlab.llm import license_join as lj
from tests.llm.edge import ROWS, edge_docs, no_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(text, templates=lj.BASE + lj.OWN, threshold=0.8, stride=64) -> tuple:
    """Every block against every template."""
    words = WORD.findall((text or "").translate(LOWER))
    longest = max(len(t.words.split()) for t in templates)
    stride = max(stride, longest)
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        phrase = t.words.split()
        if t.whole:
            starts = [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]
            if starts:
                labels.add(t.label)
                score = 1.0
            if starts and t.base:
                places += starts
                base.add(t.label)
        else:
            for at in range(0, len(words), stride):
                share = len(set(phrase) & set(words[at : at + stride + longest - 1])) / len(set(phrase))
                if share >= threshold - 1e-9:
                    labels.add(t.label)
                    score = max(score, share)
    ends = (min(places, default=None), max(places, default=None))
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def filler(count: int) -> str:
    return " ".join(f"w{i}" for i in range(count))


TEXTS = [
    *(f"{filler(n)} Released under the MIT-License. {filler(n)}" for n in (0, 1, 59, 60, 61, 62, 63, 64, 65, 127, 128, 200)),
    "under the MIT license under the mit license " * 40,
    "CC BY-NC cc by nc, cc by cc by nc",
    "Apache License\nVersion 2",
    f"apache {filler(80)} license version 2",
    "Licensed under the GNU General Public License, version 2",
    f"gnu general public license version 3 licensed {filler(30)} under the",
    f"gnu general public license {filler(200)} version 3 licensed under the",
    "All rights reserved",
    "under the mit licenseé under the mit_license",
    "under the Kit license",
    f"{filler(60)} Permission is hereby granted, free of charge, to any person obtaining a copy of this program",
    "mit " * 300,
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    found = {r.id: tuple(r)[1:] for r in lj.scan(docs).collect()}
    for i, text in enumerate(TEXTS):
        assert found[i] == pytest.approx(expected(text)), text[:80]


@pytest.mark.parametrize("threshold", [0.5, 0.65, 1.0])
@pytest.mark.parametrize("stride", [22, 50])
def test_every_threshold_and_stride(spark, threshold, stride):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    found = {r.id: tuple(r)[1:] for r in lj.scan(docs, threshold=threshold, stride=stride).collect()}
    for i, text in enumerate(TEXTS):
        assert found[i] == pytest.approx(expected(text, threshold=threshold, stride=stride)), text[:80]


def test_edges(spark):
    found = lj.scan(edge_docs(spark)).collect()
    wanted = [(r[0], *expected(r[1])) for r in ROWS]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_given_tables(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in lj.scan(docs).collect():
        assert tuple(r)[1:] == pytest.approx(expected(texts[r.id]))


def test_too_many_templates(spark, monkeypatch):
    monkeypatch.setattr(lj, "MOST_TEMPLATE_WORDS", 3)
    with pytest.raises(ValueError):
        lj.scan(edge_docs(spark))


def test_empty(spark):
    assert lj.scan(no_docs(spark)).collect() == []
