import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowlab.llm import katz
from tests.llm.edge import ROWS, edge_docs, no_docs

END = "\n"


class Model:
    """The same model from plain dictionaries."""

    def __init__(self, texts: list[list[str]], order: int = 2):
        self.uni = Counter(w for t in texts for w in t)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.f1 = self.factors(self.uni)
        kept = sum(self.cut(n, self.f1) for n in self.uni.values())
        plain = kept == self.n
        self.total = self.n + plain
        self.unknown = 1 / self.total if plain else (self.n - kept) / self.n
        self.order, self.grams, self.f, self.weight, self.totals = order, {}, {}, {(): 1.0}, {}
        for n in range(2, order + 1):
            self.grams[n] = Counter((h, w) for t in texts for h, w in histories(t, n))
            self.f[n] = self.factors(self.grams[n])
            after = defaultdict(list)
            for (h, w), count in self.grams[n].items():
                after[h].append((w, count))
            for h, found in after.items():
                kept = sum(self.cut(c, self.f[n]) for _, c in found)
                total = sum(c for _, c in found)
                total += kept == total
                self.totals[h] = total
                self.weight[h] = (1 - kept / total) / (1 - sum(self.p(h[1:], w) for w, _ in found))

    @staticmethod
    def factors(counts):
        return katz.discounts([sum(n == r for n in counts.values()) for r in range(1, 7)])

    @staticmethod
    def cut(n, factors):
        return n * (factors[n] if n <= 5 else 1.0)

    def p1(self, w):
        return self.cut(self.uni[w], self.f1) / self.total if self.uni[w] else self.unknown

    def p(self, h, w):
        if not h:
            return self.p1(w)
        if h not in self.totals:
            return self.p(h[1:], w)
        n = self.grams[len(h) + 1][h, w]
        return self.cut(n, self.f[len(h) + 1]) / self.totals[h] if n else self.weight[h] * self.p(h[1:], w)


def histories(t, order):
    """(the order - 1 tokens before, token) of each token."""
    padded = [END] * (order - 1) + t
    return [(tuple(padded[i : i + order - 1]), w) for i, w in enumerate(t)]


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def compare(found, rows, order=2):
    model = Model([tokens(r[1]) for r in rows if not held_out(r[0])], order)
    wanted = []
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((model.uni[w] + 0.1) / (model.n + 0.1 * (model.v + 1))) for w in t)
        score = sum(math.log10(model.p(h, w)) for h, w in histories(t, order))
        known = sum(model.uni[w] > 0 for w in t)
        wanted.append((r[0], held_out(r[0]), len(t), known, model.n, base, score))
    key = lambda r: (str(r[0]), r[2], r[3])
    for a, e in zip(sorted(map(tuple, found), key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == e[:5]
        assert a[5:] == pytest.approx(e[5:], rel=1e-9)
    return model


@pytest.mark.parametrize("order", [2, 3, 4])
def test_edges(spark, order):
    compare(katz.score(edge_docs(spark), order=order).collect(), ROWS, order)


@pytest.mark.parametrize("order, small", [(2, None), (2, 400), (3, 400), (4, 400)])
def test_given_tables(spark, sf_dir, monkeypatch, order, small):
    """With small parts and blocks, frequent contexts are spread over several parts."""
    if small:
        monkeypatch.setattr(katz, "PART_GRAMS", small * 10)
        monkeypatch.setattr(katz, "PART_WORDS", small)
        monkeypatch.setattr(katz, "BLOCK_BYTES", small * 100)
        monkeypatch.setattr(katz, "MOST_SPREAD", 100)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = compare(katz.score(docs, order=order).collect(), rows, order)
    # the sum over all words and the unknown is one after any context
    some = sorted(model.totals, key=lambda h: (-model.totals[h], h))
    for h in [*some[:10], *some[-10:], (END,) * (order - 1), ("never", "seen", "before")[: order - 1]]:
        unknown = model.unknown * math.prod(model.weight.get(h[i:], 1) for i in range(len(h)))
        assert sum(model.p(h, w) for w in model.uni) + unknown == pytest.approx(1, abs=1e-9)


def test_order_without_contexts_is_refused(spark):
    with pytest.raises(ValueError):
        katz.score(no_docs(spark), order=1)


def test_no_training_text(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(60) if held_out(i)], "doc_id bigint, text string")
    for r in katz.score(docs).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)
        assert r.score == r.base_score == 0


def test_discounts():
    assert katz.discounts([100, 40, 20, 10, 6, 4])[1:] == pytest.approx(
        [((r + 1) * b / (r * a) - 0.24) / 0.76 for r, (a, b) in enumerate(zip([100, 40, 20, 10, 6], [40, 20, 10, 6, 4], strict=True), 1)]
    )
    assert (katz.discounts([0, 0, 0, 0, 0, 0])[1:] == np.array([0.5, 0.75, 2.5 / 3, 0.875, 0.9])).all()
    limited = katz.discounts([100, 30, 12, 0, 0, 0])
    assert (limited[1:3] < 1).all() and (limited[3:] == 1).all()


def test_packing():
    for values in (np.empty(0, np.int64), np.array([0, -1, 2**62, 7]), np.arange(1000)):
        assert (katz.unpack(katz.pack(values)) == values).all()
    doubles = np.array([0.0, 0.1, -5e300])
    assert (katz.unpack(katz.pack(doubles), np.float64) == doubles).all()


@pytest.mark.parametrize("order", [2, 3])
def test_empty(spark, order):
    assert katz.score(no_docs(spark), order=order).collect() == []
