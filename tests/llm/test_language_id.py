import random

import numpy as np
import pytest

from flowlab.llm import language_id
from tests.llm.edge import CLASHES, ROWS, edge_docs, no_docs


def vector(text: str | None, dims: int, seed: int) -> np.ndarray:
    """One text's vector, n-gram by n-gram."""
    line = " " + "".join(c if c.isalpha() else " " for c in text or "") + " "
    line = " " + " ".join("".join(c.lower() if len(c.lower()) == 1 else c for c in line).split()) + " "
    if not line.strip():
        return np.zeros(dims)
    base = {c: language_id.letter_vectors(np.array([ord(c)]), dims, seed)[0].astype(int) for c in set(line)}
    return sum(
        (np.roll(base[line[i]], 2) * np.roll(base[line[i + 1]], 1) * base[line[i + 2]] for i in range(len(line) - 2)),
        np.zeros(dims),
    )


TEXTS = ["", None, "a", "Ab c", "  12 x ", "ÀÉ ß İstanbul K", "日本語 テキスト", "word " * 300, "tabs\tand\nlines, dots. end", "42"]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 18])
def test_bundles_equal_one_by_one(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    found = language_id.bundles(list(range(len(TEXTS))), TEXTS, len(TEXTS), 64, 42)
    wanted = np.stack([vector(t, 64, 42) for t in TEXTS])
    assert (found == wanted).all()


def test_prototypes_are_sums_whatever_the_layout(spark):
    docs = edge_docs(spark)
    one, other = language_id.learn(docs, dims=128), language_id.learn(docs.repartition(5), dims=128)
    assert one.languages == other.languages == ["en", "fr"]
    assert (one.prototypes == other.prototypes).all()
    units = [v / max(1, np.linalg.norm(v)) for v in (vector(r[1], 128, 42) for r in ROWS if r[2] == "fr")]
    assert np.abs(one.prototypes[1] / language_id.GRID - sum(units)).max() < 1e-5


def test_predictions_of_edges(spark):
    docs = edge_docs(spark)
    profiles = language_id.learn(docs, dims=64)
    rows = language_id.predict(docs, profiles).collect()
    for r in rows:
        v = vector(r.text, 64, 42)
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = [v @ p / np.linalg.norm(v) / np.linalg.norm(p) for p in profiles.prototypes]
        assert r.lang_pred == profiles.languages[int(np.argmax(cosines))]
        assert r.score == pytest.approx(max(0.0, *cosines))
        assert all(r[c] == f"other {c}" for c in CLASHES if c not in ("score", "lang_pred"))
    assert len(rows) == len(ROWS)


def test_held_out_accuracy(spark):
    r = random.Random(2)
    made = {"xx": "aeiouklmn", "yy": "bcdfgaeo", "zz": "αβγδεζη"}
    rows = []
    for i in range(300):
        lang = r.choice(sorted(made))
        text = " ".join("".join(r.choice(made[lang]) for _ in range(r.randrange(2, 7))) for _ in range(r.randrange(3, 30)))
        rows.append((i, text, lang))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    profiles = language_id.learn(docs.filter("doc_id % 4 <> 2"))
    held_out = language_id.predict(docs.filter("doc_id % 4 = 2"), profiles).collect()
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r.score <= 1 for r in held_out)


def test_given_tables(spark, sf_dir):
    """Accuracy over the documents that taught nothing."""
    from flowlab.llm import queries

    found = queries.op6_language_id(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held_out = found.join(truth, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.95 * len(held_out)


def test_nothing_learned(spark):
    profiles = language_id.learn(no_docs(spark))
    assert profiles.languages == []
    found = language_id.predict(edge_docs(spark), profiles).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert language_id.predict(no_docs(spark), profiles).collect() == []
