"""Granules of the 15-minute feeds as a Spark data source: rows and what was wrong with them, from one pass.

``spark.read.format("granules")`` has one input partition per granule (or ``per_task`` of them) of the days asked for. The
granules follow from the calendar, so nobody lists files: a task opens its granule's file, or its folder, once, and
gives the rows that can be read and one row that counts them (``kind`` tells which). A granule without a file
has that one row only. Filters on ``granule`` are taken over by the source, which then plans fewer tasks.

Files are opened through Arrow's file systems (local, HDFS, S3, GCS, Azure, by the scheme of the path), in the tasks.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import io
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.json
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from tidewatch.functions.keys import hash_threshold
from tidewatch.schemas import ARTICLE_COLUMNS, EMBEDDING_SCHEMA
from tidewatch.session import scratch_path

#: Rows of a batch that a task hands on.
BATCH_ROWS = 2_000
#: Compressed bytes that are inflated at a time.
_PIECE = 1 << 16
#: An object begins behind the end of another, or on a line of its own.
_NEXT_OBJECT = re.compile(r"[}\n]\s*\{")

COUNTS = T.StructType(
    [
        T.StructField("granule", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("found", T.BooleanType()),
        T.StructField("read", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("complete", T.BooleanType()),
    ]
)
SCHEMAS = {
    "embeddings": EMBEDDING_SCHEMA,
    "articles": T.StructType([T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS]),
}
#: Names a granule's file may have, the first found counts; one with a slash at the end is a folder.
NAMES = {
    "embeddings": "{stamp}.docembed.json.gz,{stamp}.gsg.docembed.json.gz,{stamp}.json.gz,{stamp}.docembed.json,{stamp}.json",
    "articles": "{stamp}.gkg.csv,{stamp}.gkg.csv.gz,{stamp}.translation.gkg.csv,{stamp}.csv,{stamp}.csv.gz",
}
_ARROW = {
    "embeddings": pa.schema([*[(f, pa.string()) for f in EMBEDDING_SCHEMA.fieldNames()[:-1]], ("docembed", pa.list_(pa.float32()))]),
    "articles": pa.schema([(c, pa.string()) for c in ARTICLE_COLUMNS]),
}
_ARROW_COUNTS = [("granule", pa.string()), ("kind", pa.string()), ("found", pa.bool_()), ("read", pa.int64()), ("rejected", pa.int64()), ("complete", pa.bool_())]


def inflated(data: bytes) -> tuple[bytes, bool]:
    """What a gzip file holds up to where it ends or breaks, and whether it ended."""
    out, at, ended = [], 0, True
    part = zlib.decompressobj(wbits=31)
    while at < len(data):
        piece, before = data[at : at + _PIECE], part.copy()
        try:
            out.append(part.decompress(piece))
        except zlib.error:
            # Again, up to the byte at which it breaks.
            try:
                for i in range(len(piece)):
                    out.append(before.decompress(piece[i : i + 1]))
            except zlib.error:
                pass
            return b"".join(out), False
        at += len(piece) - len(part.unused_data)
        ended = part.eof
        if ended:
            part = zlib.decompressobj(wbits=31)
    return b"".join(out), ended


def unpacked(content: bytes) -> tuple[bytes, bool]:
    """The bytes of a file without gzip, as far as they can be read, and whether that is all of them."""
    content = bytes(content)
    return inflated(content) if content[:2] == b"\x1f\x8b" else (content, True)


def objects(text: str) -> Iterator[dict | None]:
    """Objects written back to back, whatever lies between them; None for each place where one cannot be read."""
    decoder, at, end = json.JSONDecoder(), 0, len(text)
    while True:
        while at < end and text[at].isspace():
            at += 1
        if at >= end:
            return
        try:
            record, at = decoder.raw_decode(text, at)
            yield record if isinstance(record, dict) else None
        except ValueError:
            # Spoiled or cut off: on to where the next object begins.
            yield None
            following = _NEXT_OBJECT.search(text, at + 1)
            if following is None:
                return
            at = following.end() - 1


def _as_text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


def _as_vector(value: object) -> list | None:
    """A list of numbers; anything else is none, as a wrong type is null to a JSON reader."""
    if not isinstance(value, list) or any(isinstance(x, bool) or not isinstance(x, int | float | None) for x in value):
        return None
    return value


def embeddings_of(data: bytes) -> tuple[pa.Table, int]:
    """The objects of a granule, and the number of places where one cannot be read.

    Arrow reads whole granules, objects back to back or over several lines. It gives a spoiled one up as a
    whole, and then every object is read on its own.
    """
    schema = _ARROW["embeddings"]
    if not data.strip():
        return schema.empty_table(), 0
    try:
        table = pyarrow.json.read_json(
            io.BytesIO(data),
            read_options=pyarrow.json.ReadOptions(use_threads=False, block_size=len(data) + 64),
            parse_options=pyarrow.json.ParseOptions(
                explicit_schema=schema, newlines_in_values=True, unexpected_field_behavior="ignore"
            ),
        )
        nothing = functools.reduce(pc.and_, [pc.is_null(c) for c in table.columns])
        # Without any field it may be no object at all.
        if not pc.any(nothing).as_py():
            return table.cast(schema), 0
    except pa.ArrowInvalid:
        pass
    read, rejected = [], 0
    for record in objects(data.decode("utf-8", "ignore")):
        if record is None:
            rejected += 1
        else:
            read.append(record)
    columns = [[_as_text(r.get(name)) for r in read] for name in schema.names[:-1]]
    vectors = [_as_vector(r.get("docembed")) for r in read]
    return pa.table([*columns, pa.array(vectors, schema.types[-1])], schema=schema), rejected


def articles_of(data: bytes) -> tuple[pa.Table, int]:
    """The lines of a granule by field, and the number of lines with too many fields. Short lines are padded with nulls."""
    schema, width = _ARROW["articles"], len(ARTICLE_COLUMNS)
    text = data.decode("utf-8", "ignore").encode()
    lines = pa.array([x.rstrip(b"\r") for x in text.split(b"\n")], pa.binary()).cast(pa.string())
    lines = lines.filter(pc.not_equal(pc.binary_length(lines), 0))
    few = pc.less(pc.count_substring(lines, "\t"), width)
    kept = lines.filter(few)
    padded = pc.binary_join_element_wise(kept, "\t" * (width - 1), "")
    fields = pc.split_pattern(padded, "\t", max_splits=width)
    columns = []
    for i in range(width):
        value = pc.list_element(fields, i)
        columns.append(pc.if_else(pc.equal(value, ""), pa.scalar(None, pa.string()), value))
    return pa.table(columns, schema=schema), len(lines) - len(kept)


_READERS = {"embeddings": embeddings_of, "articles": articles_of}


def granule_batches(feed: str, granule: str, contents: list[bytes] | None) -> Iterator[pa.RecordBatch]:
    """Rows of a granule's files, and at the end the row that counts them. None: there is no file."""
    schema = pa.schema([*_ARROW[feed], *_ARROW_COUNTS])
    read = rejected = 0
    complete = contents is not None
    for content in contents or []:
        data, whole = unpacked(content)
        complete &= whole
        table, bad = _READERS[feed](data)
        read, rejected = read + table.num_rows, rejected + bad
        for batch in table.combine_chunks().to_batches(max_chunksize=BATCH_ROWS):
            n = len(batch)
            counts = [pa.array([v] * n, t) for v, (_, t) in zip((granule, "row", True, None, None, None), _ARROW_COUNTS, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], schema=schema)
    values = (*[None] * len(_ARROW[feed]), granule, "count", contents is not None, read, rejected, complete)
    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system for a path, and the path inside it."""
    scheme, _, rest = path.partition(":")
    # Hadoop's names for what Arrow calls s3 and plain files.
    path = {"s3a": f"s3:{rest}", "s3n": f"s3:{rest}", "file": "/" + rest.lstrip("/")}.get(scheme, path)
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def open_files(base: str, names: list[str], stamp: str) -> list[bytes] | None:
    """Contents of a granule's file, or of all files in its folder; None if there are none."""
    system, root = file_system(base)
    for name in names:
        path = f"{root.rstrip('/')}/{name.format(stamp=stamp)}"
        folder = path.endswith("/")
        info = system.get_file_info(path.rstrip("/"))
        if info.type == pyarrow.fs.FileType.NotFound:
            continue
        found = [info]
        if folder:
            inside = system.get_file_info(pyarrow.fs.FileSelector(path.rstrip("/")))
            found = sorted((f for f in inside if f.is_file and f.base_name[0] not in "._"), key=lambda f: f.path)
        contents = []
        for f in found:
            with system.open_input_stream(f.path, compression=None) as stream:
                contents.append(stream.read())
        if contents:
            return contents
    return None


@dataclass
class Granules(InputPartition):
    stamps: list[str]

    def __init__(self, stamps: list[str]):
        self.stamps = stamps


def stamps_between(start: datetime.datetime, end: datetime.datetime, every: str = "15 minutes") -> list[str]:
    """Stamps of the granules from ``start`` on and before ``end``. ``every`` is a number of minutes or days, or ``1 month``."""
    number, _, unit = every.partition(" ")
    unit = unit.rstrip("s")
    if unit not in ("minute", "day", "month") or int(number) < 1 or (unit == "month" and int(number) != 1):
        raise ValueError("every must be a number of minutes or days, or '1 month'")
    out, at = [], start
    while at < end:
        out.append(f"{at:%Y%m%d%H%M%S}")
        if unit == "month":
            at = (at.replace(day=1) + datetime.timedelta(days=32)).replace(day=1)
        else:
            at += datetime.timedelta(**{f"{unit}s": int(number)})
    return out


def feed_of(options: dict[str, str]) -> str:
    feed = options.get("feed", "embeddings")
    if feed not in SCHEMAS:
        raise ValueError(f"feed must be one of {sorted(SCHEMAS)}")
    return feed


class GranuleReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.feed = feed_of(options)
        self.path = options["path"]
        self.names = options.get("names", NAMES[self.feed]).split(",")
        start, end = (datetime.datetime.fromisoformat(options[k]) for k in ("start", "end"))
        stamps = stamps_between(start, end, options.get("every", "15 minutes"))
        # The same granules of every feed: a hash of seed and stamp, as `functions.keys.chosen` has it.
        bound, seed = hash_threshold(float(options.get("p", "1"))), options.get("seed", "4")
        whole = float(options.get("p", "1")) >= 1
        self.stamps = [s for s in stamps if whole or hashlib.md5(f"{seed}|{s}".encode()).hexdigest()[:8] < bound]
        self.per_task = int(options.get("per_task", "1"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over what is asked of the granule; Spark keeps the rest."""
        tests = {
            EqualTo: lambda s, v: s == v,
            EqualNullSafe: lambda s, v: s == v,
            In: lambda s, v: s in v,
            GreaterThan: lambda s, v: s > v,
            GreaterThanOrEqual: lambda s, v: s >= v,
            LessThan: lambda s, v: s < v,
            LessThanOrEqual: lambda s, v: s <= v,
        }
        for f in filters:
            test = tests.get(type(f))
            if test is None or f.attribute != ("granule",) or f.value is None:
                yield f
            else:
                self.stamps = [s for s in self.stamps if test(s, f.value)]

    def partitions(self) -> list[Granules]:
        return [Granules(self.stamps[i : i + self.per_task]) for i in range(0, len(self.stamps), self.per_task)]

    def read(self, partition: Granules) -> Iterator[pa.RecordBatch]:
        for stamp in partition.stamps:
            yield from granule_batches(self.feed, stamp, open_files(self.path, self.names, stamp))


class GranuleSource(DataSource):
    """Options: ``path``, ``start`` and ``end`` (ISO), ``feed`` (embeddings or articles), ``names`` (of files, with {stamp}),
    ``every`` (15 minutes), ``p`` and ``seed`` (a share of the granules), ``per_task``."""

    @classmethod
    def name(cls) -> str:
        return "granules"

    def schema(self) -> T.StructType:
        return T.StructType([*SCHEMAS[feed_of(self.options)].fields, *COUNTS.fields])

    def reader(self, schema: T.StructType) -> GranuleReader:
        return GranuleReader(dict(self.options))


def read_granules(
    spark: SparkSession, path: str, start: datetime.date, end: datetime.date, feed: str = "embeddings", **options: object
) -> DataFrame:
    """Rows (``kind`` row) and counts (``kind`` count) of the granules of ``[start, end)``; see `GranuleSource` for the options."""
    spark.dataSource.register(GranuleSource)
    # Python data sources see filters only if this is set.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    named = {"feed": feed, "start": start.isoformat(), "end": end.isoformat(), **{k: str(v) for k, v in options.items()}}
    return spark.read.format("granules").options(**named).load(path)


def landed(granules: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows and counts of `read_granules`, both from one reading: written to the shared folder, by ``kind``."""
    spark = granules.sparkSession
    path = scratch_path(spark, name)
    granules.write.partitionBy("kind").parquet(path)
    fields = [f for f in granules.schema if f.name != "kind"]
    table = spark.read.schema(T.StructType([*fields, T.StructField("kind", T.StringType())])).parquet(path)
    counts = table.where(F.col("kind") == "count").select("granule", "found", "read", "rejected", "complete")
    return table.where(F.col("kind") == "row").drop("kind", "found", "read", "rejected", "complete"), counts
