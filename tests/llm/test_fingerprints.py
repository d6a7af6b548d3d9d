from __future__ import annotations

import hashlib
import struct

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from flowlab.llm import fingerprints as fp
from flowlab.llm.queries import op11_fingerprints
from tests.llm.edge import ROWS, edge_docs, no_docs

SEED = 42
HALF = 1 << 63


def chained(values, encode):
    seed = SEED
    for value in values:
        seed = xxh64_intdigest(encode(value), seed)
    return seed


def plain_hashes(text):
    words = (text or "").encode().lower().split()
    numbers = [xxh64_intdigest(w, SEED) for w in words]
    shingles = [numbers[i : i + 5] for i in range(len(numbers) - 4)] or ([numbers] if numbers else [])
    return {chained(s, lambda n: struct.pack("<Q", n)) for s in shingles}


def plain_sketch(text, bits=fp.KEPT_BITS):
    """Unsigned hashes in the order that the operator keeps: that of their signed numbers."""
    hashes = {h ^ HALF for h in plain_hashes(text)}
    kept = {h for h in hashes if h < 1 << (64 - bits)} or set(sorted(hashes)[:1])
    return sorted(kept)


def plain_likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def printed(sketch):
    return "".join(f"{h:016x}" for h in sketch)


def plain_rows(docs):
    order = sorted((d for d in docs if d[0] is not None), key=lambda d: (-d[0], (d[1] or "").encode()))
    beside = [(d, order[(i + 1) % len(order)]) for i, d in enumerate(order)] + [(d, None) for d in docs if d[0] is None]
    rows = []
    for (doc_id, text, *_), following in beside:
        text = text or ""
        after = (following[1] or "") if following else ""
        third = len(text) // 3
        new = text[: len(text) - third] + after[:third]
        own, other = plain_sketch(text), plain_sketch(new)
        near_next = plain_likeness(own, plain_sketch(after)) if following else None
        digest = hashlib.sha256(new.encode()).hexdigest()
        rows.append((doc_id, len(text), digest, printed(own), printed(other), plain_likeness(own, other), near_next))
    return rows


COLUMNS = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, str(v)) for v in r])


def same(found, docs):
    assert in_order(found.select(*COLUMNS).collect()) == in_order(plain_rows(docs))


def test_equals_brute_force_on_edge_documents(spark):
    same(fp.compare_with_edited(edge_docs(spark)), ROWS)


def test_query_equals_brute_force_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    same(op11_fingerprints(spark, sf_dir).withColumnRenamed("doc_id", "id"), docs)


@pytest.mark.parametrize("buckets", [1, 2, 7, 40])
def test_ranges_do_not_change_neighbours(spark, buckets):
    ids = [3, -8, 10**15, 17, 17, 5, 900, 2**40, -(2**60), 4, 0]
    docs = [(n, f"text number {i} of these") for i, n in enumerate(ids)]
    rows = spark.createDataFrame(docs, "id bigint, text string")
    found = fp.neighbours(rows, {"size": F.char_length("text")}, buckets=buckets)
    order = sorted(docs, key=lambda d: (-d[0], d[1]))
    wanted = [(*d, len(d[1]), order[(i + 1) % len(order)][1], len(order[(i + 1) % len(order)][1])) for i, d in enumerate(order)]
    assert in_order(found.select("id", "text", "size", "next_text", "next_size").collect()) == in_order(wanted)


def test_one_and_no_document(spark):
    one = [(5, "a b c d e f g h i")]
    same(fp.compare_with_edited(spark.createDataFrame(one, "doc_id bigint, text string")), one)
    assert fp.compare_with_edited(no_docs(spark)).isEmpty()
    nameless = [(None, "a b c d e f g"), (None, None)]
    same(fp.compare_with_edited(spark.createDataFrame(nameless, "doc_id bigint, text string")), nameless)


def test_merged_sketches_are_those_of_all_shingles(spark):
    texts = [("", "one"), ("one two three four five six seven", "eight nine"), (" ".join(f"w{i}" for i in range(60)), "x y z u v w")]
    rows = spark.createDataFrame(texts, "a string, b string")
    merged = rows.select("a", "b", fp.merge(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("m")).collect()
    for a, b, m in merged:
        hashes = {h ^ HALF for h in plain_hashes(a) | plain_hashes(b)}
        kept = {h for h in hashes if h < 1 << (64 - fp.KEPT_BITS)} or set(sorted(hashes)[:1])
        assert [h + HALF for h in m] == sorted(kept)


def test_containment_between_unequal_documents(spark):
    words = [f"word{i * 7919 % 40_009}" for i in range(40_000)]
    rows = spark.createDataFrame([(" ".join(words), " ".join(words[5000:5600]), " ".join(words[::-1]))], "a string, b string, c string")
    a, b, c = (fp.sketch(F.col(n)) for n in "abc")
    part, whole, none, like = rows.select(fp.containment(b, a), fp.containment(a, b), fp.containment(b, c), fp.likeness(a, b)).first()
    assert part == 1.0 and whole < 0.03 and none == 0.0 and like < 0.03


def test_equal_texts_have_equal_fingerprints(spark):
    rows = spark.createDataFrame([(1, "A b  c"), (2, "a B c "), (3, "a b d")], "doc_id bigint, text string")
    prints = dict(fp.fingerprints(rows).select("id", "fingerprint").collect())
    assert prints[1] == prints[2] != prints[3] and len(prints[1]) == 16
