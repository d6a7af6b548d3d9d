"""WARC archives in dictionary-compressed Zstandard, written and read by Spark.

Every task writes one archive. It trains a dictionary on its first records (a bounded sample), puts it
into a leading skippable frame, and compresses each record as a frame of its own with it, so any
record can be read alone. Frames leave the tasks as binary rows and are written by Spark's text sink:
its committer makes whole files whatever executors are lost, on any file system that Spark reaches.
The sink puts a separator after each row; here that is an empty skippable frame, which every
Zstandard reader passes over. Files end in ``.warc.zst`` after a last renaming.

Payloads of at least ``least_bytes`` that occur more than once are stored once: the page with the
smallest id has the response, the others are revisits that name it. An archive with too few records
to train on has no dictionary frame, which the format allows.

Rows: a null payload is an empty one. A null id is written as such; it is larger than any other id,
and if all ids of equal payloads are null, all are responses. Rows that share the smallest id are all
responses. A null address is written as ``about:blank``; spaces and control characters in addresses
are percent-encoded. Other columns do not matter. An empty table makes an empty folder.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm.common import join_narrow

LEAST_BYTES = 100
DATE = "2000-01-01T00:00:00Z"
DICTIONARY_MAGIC = 0x184D2A5D  # fixed by the WARC-Zstandard format
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)  # an empty skippable frame; all its bytes are ASCII
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEAST_SAMPLES = 8
LEVEL = 3
SUFFIX = ".warc.zst"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "<urn:page>"
READ_BYTES = 8 << 20


def record_id(page: str | None) -> str:
    return NO_ID if page is None else f"<urn:page:{quote(page, safe='')}>"


def page_of(record: str) -> str | None:
    return None if record == NO_ID else unquote(record.removeprefix("<urn:page:").removesuffix(">"))


def address(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url) if url else "about:blank"


def record(page: str | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header with the payload's length, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Target-URI: {address(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of at most a tenth of the samples' bytes; None if they are too few or too plain."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    if len(samples) < LEAST_SAMPLES or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, level=LEVEL)
    except zstandard.ZstdError:
        return None


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: the dictionary, then each record."""
    first, size = [], 0
    for item in records:
        first.append(item)
        size += len(item)
        if size >= SAMPLE_BYTES:
            break
    trained = train(first)
    if trained is not None:
        content = trained.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True)
    for item in first:
        yield compressor.compress(item)
    first.clear()
    for item in records:
        yield compressor.compress(item)


def described(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("bigint").alias("size"), F.sha2("payload", 256).alias("digest")
    )


def with_references(rows: DataFrame, least_bytes: int) -> DataFrame:
    """``rows`` with the id that each revisit refers to; only repeated digests take part in the join."""
    repeated = (
        rows.filter(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("digest", "first")
    )
    other = ~F.col("id").eqNullSafe(F.col("first"))
    return join_narrow(rows, repeated, "digest", "left").withColumn("refers_to", F.when(other, F.col("first")))


def write(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = LEAST_BYTES,
) -> None:
    """Write one archive per partition of ``pages`` into the new folder ``path``."""
    rows = with_references(described(pages, id_col, url_col, payload_col), least_bytes).select(
        F.col("id").cast("string").alias("id"), "url", "payload", "digest", "size", F.col("refers_to").cast("string")
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                columns = [batch.column(c) for c in ("id", "url", "payload", "digest", "size", "refers_to")]
                for i in range(batch.num_rows):
                    yield record(*(c[i].as_py() for c in columns))

        waiting, size = [], 0
        for frame in frames(records()):
            waiting.append(frame)
            size += len(frame)
            if size >= READ_BYTES:
                yield pa.record_batch([pa.array(waiting, pa.binary())], ["frame"])
                waiting, size = [], 0
        yield pa.record_batch([pa.array(waiting, pa.binary())], ["frame"])

    written = rows.mapInArrow(archive, "frame binary").select(F.col("frame").cast("string"))
    written.write.option("lineSep", SEPARATOR.decode("ascii")).text(path)
    _name_archives(pages.sparkSession, path)


def _name_archives(spark: SparkSession, path: str) -> None:
    """Give the finished files the suffix of their format."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            fs.rename(status.getPath(), hadoop.Path(folder, name.removesuffix(".txt") + SUFFIX))


def dictionary(archive: bytes) -> zstandard.ZstdCompressionDict | None:
    """The dictionary of an archive's leading frame, itself compressed or not."""
    if len(archive) < 8:
        return None
    magic, size = struct.unpack("<II", archive[:8])
    if magic != DICTIONARY_MAGIC:
        return None
    content = archive[8 : 8 + size]
    if content[:4] == zstandard.FRAME_HEADER:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary(archive))
    with decompressor.stream_reader(io.BytesIO(archive), read_across_frames=True) as raw:
        stream = io.BufferedReader(raw, 1 << 20)
        while version := stream.readline():
            if not version.strip():
                continue
            if not version.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            headers = {}
            while line := stream.readline().rstrip(b"\r\n"):
                name, _, value = line.decode().partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            block = stream.read(length)
            if len(block) != length:
                raise ValueError("a record ends early")
            yield headers, block


def parsed(headers: dict[str, str], block: bytes) -> dict:
    """The columns of one record; a response's payload is checked against its digest and length."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    response = headers["warc-type"] == "response"
    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{headers['warc-record-id']}: the payload differs from its digest")
    refers_to = headers.get("warc-refers-to")
    return {
        "id": page_of(headers["warc-record-id"]),
        "uri": headers["warc-target-uri"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": headers["warc-type"],
        "refers_to": page_of(refers_to) if refers_to else None,
        "payload": payload if response else None,
    }


READ_SCHEMA = pa.schema(
    {
        "id": pa.string(),
        "uri": pa.string(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.string(),
        "payload": pa.binary(),
    }
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``; a revisit has no payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows, size = [], 0
                for headers, block in records(archive.as_py()):
                    rows.append(parsed(headers, block))
                    size += len(block)
                    if size >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)

    columns = "id string, uri string, payload_bytes bigint, payload_digest string, record_type string"
    return files.mapInArrow(parse, f"{columns}, refers_to string, payload binary")
