import json
import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from flowlab.llm import token_counts
from tests.llm.edge import ROWS, edge_docs, no_docs

PATH = P.path("byte_bpe_50k.json")


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_equals_the_library_on_random_texts():
    r = random.Random(8)
    letters = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x1680, 0x4E00, 0x1F600]]
    letters += [" "] * 150 + ["<|endoftext|>", " <|endoftext|> ", "'s", "\n\n", "  "] * 8
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(2500)]
    assert token_counts.counter(PATH).count(texts) == library(texts)


def test_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_REMEMBERED", 5)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 40)
    texts = [" ".join(f"w{i * j % 97}" for i in range(50)) + " " + "long" * 40 for j in range(20)]
    counter = token_counts.Counter(PATH)
    assert counter.count(texts) == counter.count(texts) == library(texts)
    assert all(len(p) <= token_counts.LONGEST_REMEMBERED for p in counter.known)


def test_batches_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 3000)
    japanese = "日本語の文章はここで終わります。そして、「次」も！" * 200
    mixed = ("word,another.third" * 50 + "漢字" * 70 + "!?..x" + " spaced out, <|endoftext|>") * 30
    texts = [japanese, mixed, "字" * 4000, "a.b" * 3000, "plain " * 900, ""]
    counter, seen = token_counts.Counter(PATH), []

    class Watched:
        def encode_batch_fast(self, batch, **options):
            seen.append(batch)
            return library_object.encode_batch_fast(batch, **options)

    library_object = counter.tokenizer
    counter.tokenizer = Watched()
    assert counter.count(texts) == library(texts)
    sizes = [sum(len(p.encode()) for p in batch) for batch in seen]
    assert max(len(b) for b, size in zip(seen, sizes, strict=True) if size > 3000) == 1  # a single part
    assert [b for b, size in zip(seen, sizes, strict=True) if size > 3000] == [["字" * 4000]]


def test_edges(spark):
    found = token_counts.count_tokens(edge_docs(spark), PATH, limit=10)
    rows = found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    counts = library([r[1] or "" for r in ROWS])
    wanted = [(r[0], len((r[1] or "").encode()), n, n > 10) for r, n in zip(ROWS, counts, strict=True)]
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)


def test_other_vocabularies_are_refused(tmp_path):
    made = json.load(open(PATH, encoding="utf-8"))
    made["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(made))
    with pytest.raises(ValueError):
        token_counts.check_vocabulary(str(path))
    with pytest.raises(ValueError):
        token_counts.check_vocabulary(P.path("word_bpe_49k.json"))


def test_empty(spark):
    assert token_counts.count_tokens(no_docs(spark), PATH).collect() == []
