import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from flowlab.llm import byte_bpe
from tests.llm.edge import CLASHES, ROWS, edge_docs, no_docs

FILES = [P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_multi_50k.tiktoken")]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    coder = byte_bpe.coder(request.param, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    return coder, library


def ids(coder, text):
    return list(memoryview(coder.encode(text)).cast("I"))


def test_equals_the_library_on_random_texts(pair):
    coder, library = pair
    r = random.Random(5)
    letters = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x1680, 0x4E00, 0x1F600]]
    letters += [" "] * 150 + ["'s", "'re", "\n\n", "\t ", "  ", "<|endoftext|>"] * 5
    for _ in range(1500):
        text = "".join(r.choice(letters) for _ in range(r.randrange(50)))
        assert ids(coder, text) == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def test_equals_the_library_on_texts_encoded_together(pair, monkeypatch):
    coder, library = pair
    r = random.Random(7)
    texts = ["".join(r.choice("etaoin shrdlu,.éè日本") for _ in range(r.randrange(400))) for _ in range(400)] + ["", " ", "x" * 700]
    wanted = [library.encode_ordinary(t) for t in texts]
    for long in (byte_bpe.LONG, 4, 1 << 20):
        monkeypatch.setattr(byte_bpe, "LONG", long)
        fresh = byte_bpe.ByteBpe(coder.ranks, P.PATTERN)
        assert [list(memoryview(ids).cast("I")) for ids in fresh.encode_all(texts)] == wanted


def test_equals_the_library_on_long_pre_tokens(pair):
    coder, library = pair
    r = random.Random(6)
    for text in ("a" * 30_000, "".join(r.choice("thaeion") for _ in range(60_000)), " " * 5000 + "x", "é" * 9999):
        assert ids(coder, text) == library.encode_ordinary(text)


def test_memory_changes_nothing(pair):
    coder, library = pair
    texts = [" ".join(f"w{i * j}" for i in range(300)) for j in range(5)]
    small = byte_bpe.ByteBpe(coder.ranks, P.PATTERN)
    for text in texts * 2:
        assert small.encode(text, remembered=1000) == coder.encode(text)
        assert small.used == sum(byte_bpe.ENTRY_BYTES + len(w) + len(ids) for w, ids in small.known.items())
        assert set(small.known) <= set(coder.find(text))  # each text is more than is remembered


def plain_merge(ranks, data):
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_take_the_least_rank_and_then_the_leftmost():
    """Ranks under which a merge makes pairs of lower rank than its own, and runs overlap."""
    r = random.Random(3)
    letters = b"abc"
    for _ in range(300):
        tokens = [bytes([c]) for c in letters]
        tokens += list({bytes(r.choice(letters) for _ in range(r.randrange(2, 6))) for _ in range(25)})
        r.shuffle(tokens)
        coder = byte_bpe.ByteBpe({t: i for i, t in enumerate(tokens)}, P.PATTERN)
        for _ in range(20):
            data = bytes(r.choice(letters) for _ in range(r.randrange(1, 25)))
            assert coder.merge(data) == plain_merge(coder.ranks, data)
        many = [bytes(r.choice(letters) for _ in range(r.randrange(1, 25))) for _ in range(r.randrange(60))]
        together = [list(memoryview(ids).cast("I")) for ids in coder.merge_together(many)]
        assert together == [plain_merge(coder.ranks, data) for data in many]
        assert not any(coder.words) and not any(coder.buckets)  # the queue is empty again


def test_edges(spark):
    library = tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.coder(FILES[0], P.PATTERN).ranks, special_tokens={}
    )
    wanted = []
    for r in ROWS:
        found = library.encode_ordinary(r[1] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in found)
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, (r[1] or "").encode())]
        wanted.append((r[0], len(found), *digests))
    found = byte_bpe.digests(edge_docs(spark), FILES[0], P.PATTERN).collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_encode_then_decode_keeps_other_columns(spark):
    encoded = byte_bpe.encode(edge_docs(spark), FILES[0], P.PATTERN)
    rows = byte_bpe.decode(encoded, FILES[0], P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert all(r[c] == f"other {c}" for r in rows for c in CLASHES if c not in ("ids", "decoded"))


def test_slices_bound_bytes():
    import pyarrow as pa

    batch = pa.record_batch([pa.array(["aaaa", "bbbb", "cccc", None, "d" * 99, ""])], ["text"])
    assert [p.num_rows for p in byte_bpe.sliced(batch, "text", 10)] == [2, 2, 1, 1]


def test_empty(spark):
    assert byte_bpe.digests(no_docs(spark), FILES[0], P.PATTERN).collect() == []
