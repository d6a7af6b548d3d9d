import hashlib
import struct

import zstandard
from pyspark.sql import functions as F

from flowlab.llm import warc_zstd as w
from flowlab.sources.storage import new_folder

BIG = "<p>" + "many words " * 40 + "</p>"
ROWS = [
    (1, "http://a/1", None),
    (2, None, ""),
    (3, "http://a/3 with space\r\nWARC-Type: fake", "short"),
    (4, "http://a/4", "short"),
    (9, "http://a/é", BIG),
    (5, "http://a/5", BIG),
    (7, "http://a/7", BIG),
    (7, "http://a/7", BIG),
    (None, "http://a/none", BIG),
    (5, "http://a/5", BIG),
    (10, "http://a/10", "x" * 99),
    (11, "http://a/11", "x" * 99),
    (12, "http://a/12", "x" * 100),
    (13, "http://a/13", "x" * 100),
    (14, "http://a/14", "é\r\n\r\nWARC/1.1\r\n" * 30_000),
    (None, "http://b", "y" * 200),
    (None, "http://b", "y" * 200),
]
SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("id", "payload", "digest", "first", "size")})


def expected(rows=ROWS):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p, _, other in rows if (other or "") == (html or "") and p is not None]
        first = min(ids, default=None)
        revisit = len(payload) >= 100 and page != first
        kind = "revisit" if revisit else "response"
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), kind, first if revisit else None))
    return out


def test_edges(spark):
    path = new_folder(spark, "warc")
    w.write(pages(spark).repartition(3), path)
    found = w.read(spark, path).collect()
    rows = [(r.id and int(r.id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in found]
    assert sorted(rows, key=str) == sorted(expected(), key=str)
    payloads = sorted(hashlib.sha256(r.payload).hexdigest() for r in found if r.record_type == "response")
    assert payloads == sorted(d for _, _, d, kind, _ in expected() if kind == "response")
    assert {r.uri for r in found if r.id == "2"} == {"about:blank"}
    assert {r.uri for r in found if r.id == "3"} == {"http://a/3%20with%20space%0D%0AWARC-Type:%20fake"}


def archives(spark, path):
    files = spark.read.format("binaryFile").load(path).collect()
    assert files and all(f.path.endswith(".warc.zst") for f in files)
    return [bytes(f.content) for f in files]


def test_layout_of_an_archive(spark):
    """A leading skippable frame with the dictionary, then one frame per record that needs it."""
    rows = [(i, f"http://a/{i}", f"<html><title>Page {i}</title>" + f"<p>common words {i * i}</p>" * 60) for i in range(300)]
    path = new_folder(spark, "warc")
    w.write(pages(spark, rows).coalesce(1), path)
    (archive,) = archives(spark, path)
    magic, size = struct.unpack("<II", archive[:8])
    assert magic == 0x184D2A5D
    content = archive[8 : 8 + size]
    assert content[:4] == bytes.fromhex("37a430ec")  # a Zstandard dictionary
    data, count = archive[8 + size :], 0
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    while data:
        if data[:8] == w.SEPARATOR:
            data = data[8:]
            continue
        frame = decompressor.decompressobj()
        record = frame.decompress(data)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert zstandard.get_frame_parameters(data).dict_id != 0
        data, count = frame.unused_data, count + 1
    assert count == 300
    alone = sum(len(zstandard.ZstdCompressor().compress(w.record(str(i), u, h.encode(), "0" * 64, len(h), None))) for i, u, h in rows)
    assert len(archive) < alone


def test_compressed_dictionaries_are_read():
    payloads = [f"page {i} ".encode() * 50 for i in range(200)]
    digests = [hashlib.sha256(p).hexdigest() for p in payloads]
    rows = enumerate(zip(payloads, digests, strict=True))
    records = [w.record(str(i), "http://a", p, digest, len(p), None) for i, (p, digest) in rows]
    first, *rest = w.frames(iter(records))
    packed = zstandard.ZstdCompressor().compress(first[8:])
    archive = struct.pack("<II", w.DICTIONARY_MAGIC, len(packed)) + packed + b"".join(rest)
    assert [w.parsed(*r)["id"] for r in w.records(archive)] == [str(i) for i in range(200)]


def test_few_records_need_no_dictionary():
    (only,) = w.frames(iter([w.record("1", None, b"x", hashlib.sha256(b"x").hexdigest(), 1, None)]))
    assert only[:4] == zstandard.FRAME_HEADER
    assert [w.parsed(*r)["payload"] for r in w.records(only)] == [b"x"]


def test_damage_is_found():
    import pytest

    whole = w.record("1", None, b"payload", hashlib.sha256(b"payload").hexdigest(), 7, None)
    for bad in (whole.replace(b"\r\npayload", b"\r\npaYload"), whole[:-12]):
        with pytest.raises(ValueError):
            [w.parsed(*r) for r in w.records(zstandard.ZstdCompressor().compress(bad))]


def test_empty(spark):
    path = new_folder(spark, "warc")
    w.write(pages(spark).filter("false"), path)
    assert w.read(spark, path).collect() == []
