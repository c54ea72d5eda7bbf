"""WARC archives: written from pages, and reassembled from their segments.

Writing: each page becomes a record whose block is an HTTP response with a chunked body. Of pages with
equal payloads the smallest page id is written whole, the others as revisit records that refer to
it. A block longer than ``segment_bytes`` is cut into a first record and continuation records. Archives are
text files of Spark's writer (gzip): a record ends with CR LF CR LF, of which the last LF is the line end.

Reading: archives are parsed by Content-Length, so a payload may hold anything. Continuation records are
grouped by their origin id, ordered by segment number, checked against the total length, and the chunked
framing is decoded. A record that is incomplete, or whose payload does not have its digest, raises an error.

Odd input: a null html is an empty payload; equal rows each have a record, those that hold the smallest id of
a payload are all responses; a null page id is kept, and is the response only if all ids of its payload are null.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SEGMENT_BYTES, CHUNK_BYTES = 16 << 10, 4 << 10
#: Records an archive file holds at most, so that one fits in a task's memory.
RECORDS_PER_FILE = 2_000
#: Bytes of records, before gzip, that a task writes at least, as long as there are tasks for all cores.
TASK_BYTES = 16 << 20
#: What a page's headers take, roughly.
_HEAD_BYTES = 1 << 10
_END = b"\r\n"
_DATE = "2024-01-01T00:00:00Z"


def digest(payload: Column) -> Column:
    """Upper-case hex SHA-1."""
    return F.upper(F.sha1(payload))


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked framing of a body."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(_END, at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != _END:
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its last line feed, which the writer adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r"


def records(page: dict, segment_bytes: int) -> list[bytes]:
    """The record of a page, in as many segments as it needs."""
    payload = (page["html"] or "").encode()
    name = f"urn:page:{page['page_id']}:{page['row_key']}"
    url = "".join(c for c in page["url"] or "" if c.isprintable()) or "urn:unknown"
    common = [
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{base32(page['digest'])}"),
        ("X-Page-Id", "" if page["page_id"] is None else str(page["page_id"])),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if page["refers_to"] is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        to = f"<urn:page:{page['refers_to']}:{page['refers_key']}>"
        more = [("WARC-Type", "revisit"), ("WARC-Profile", profile), ("WARC-Refers-To", to)]
        return [_record(more + common, head)]
    block = head + chunked(payload)
    if len(block) <= segment_bytes:
        return [_record([("WARC-Type", "response"), *common], block)]
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<{name}:{n}>"),
            ("WARC-Date", _DATE),
            ("WARC-Segment-Origin-ID", f"<{name}>"),
            ("WARC-Segment-Number", str(n)),
        ]
        total = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        out.append(_record(own + total, part))
    return out


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with ``digest``, ``row_key`` and, for revisits, ``refers_to``."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", digest(F.col("html"))).withColumn("row_key", F.xxhash64("page_id", "url", "digest"))
    several = (
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row_key"))).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.row_key").alias("first_key"))
    )
    met = rows.join(several, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    refers = [F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, F.col("first_key")).alias("refers_key")]
    return met.select("page_id", "url", "html", "digest", "row_key", *refers)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, least_bytes: int = 0) -> None:
    """Write pages as gzipped archives under ``path``; a redone task leaves no second copy.

    Tasks, and so archives, follow the bytes to write and not the number of shuffle partitions: many small archives cost
    more than their bytes, and on a local file system without Hadoop's native library each is several ``chmod`` processes.
    """
    out = pa.schema([("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                made = [r for page in batch.slice(at, 100).to_pylist() for r in records(page, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], schema=out)

    length = F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0))
    size = pages.agg(F.sum(length.cast("bigint") + _HEAD_BYTES)).first()[0] or 0
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    written = with_revisits(pages, least_bytes).coalesce(tasks).mapInArrow(run, "record binary")
    lines = written.select(F.col("record").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins at byte {stream.tell() - len(version)}")
        headers = {}
        while line := stream.readline().strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


_PARSED = pa.schema(
    [("type", pa.string()), ("id", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.string()),
     ("refers_to", pa.string()), ("digest", pa.string()), ("length", pa.int64()), ("block", pa.binary())]
)
_PARSED_DDL = "type string, id string, segment int, total bigint, page_id string, refers_to string, digest string, length bigint, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives; ``id`` of a continuation is that of its origin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows: list[dict] = []
                for h, block in parse(data.as_py()):
                    number = lambda k, h=h: int(h[k]) if h.get(k) else None
                    rows.append(
                        {
                            "type": h["warc-type"],
                            "id": h.get("warc-segment-origin-id", h["warc-record-id"]),
                            "segment": number("warc-segment-number"),
                            "total": number("warc-segment-total-length"),
                            "page_id": h.get("x-page-id"),
                            "refers_to": h.get("warc-refers-to"),
                            "digest": h.get("warc-payload-digest", "").removeprefix("sha1:"),
                            "length": number("x-payload-length"),
                            "block": block,
                        }
                    )
                    if len(rows) == 200:
                        yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, _PARSED_DDL)


def reassembled(parts: DataFrame) -> DataFrame:
    """Whole records: segmented ones joined in order, with their total length checked.

    A group is one record (and its exact copies, told apart by how often its first segment occurs), so it is
    bounded by a record's size.
    """
    alone = parts.where("segment is null").select("type", "id", "page_id", "refers_to", "digest", "length", "block")
    pieces = parts.where("segment is not null").groupBy("id").agg(
        F.max(F.when(F.col("segment") == 1, F.struct("type", "page_id", "digest", "length"))).alias("first"),
        F.sum(F.when(F.col("segment") == 1, 1).otherwise(0)).alias("copies"),
        F.max("total").alias("total"),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("pieces"),
    )
    # Joined once: a block that grows by a piece is copied each time. In this code page a character is a byte.
    text = F.array_join(F.transform("pieces", lambda p: F.decode(p["block"], "ISO-8859-1")), "")
    block = F.encode(text, "ISO-8859-1")
    right = (
        (F.col("copies") > 0)
        & F.coalesce(F.octet_length("whole") == F.col("total"), F.lit(False))
        & (F.element_at("pieces", -1)["segment"] == F.size("pieces"))
    )
    fail = F.raise_error(F.concat(F.lit("segments missing of record "), F.col("id"))).cast("bigint")
    joined = pieces.withColumn("whole", block).withColumn("copies", F.when(right, F.col("copies")).otherwise(fail))
    joined = joined.select(
        "first.type", "id", "first.page_id", F.lit(None).cast("string").alias("refers_to"), "first.digest", "first.length",
        F.col("whole").alias("block"), F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"),
    ).drop("copy")
    return alone.unionByName(joined)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``."""
    out = pa.schema(
        [("page_id", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload = None
                if r["type"] == "response":
                    payload = unchunked(r["block"][r["block"].index(b"\r\n\r\n") + 4 :])
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != r["digest"]:
                        raise ValueError(f"the payload of {r['id']} does not have its digest")
                rows.append(
                    {
                        "page_id": int(r["page_id"]) if r["page_id"] else None,
                        "payload": payload,
                        "payload_bytes": r["length"] if payload is None else len(payload),
                        "payload_digest": r["digest"],
                        "record_type": r["type"],
                        "refers_to": int(r["refers_to"].split(":")[2]) if r["refers_to"] else None,
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    kind = "page_id bigint, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return reassembled(read_records(spark, path)).mapInArrow(run, kind)
