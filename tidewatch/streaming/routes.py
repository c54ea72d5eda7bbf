"""Ingest that routes every row: new, a copy, or late. Nothing is left out and no history is read again.

State is kept per key for a lifetime after it was first seen, in RocksDB. Each call between Spark and its Python worker costs far
more than a row does, so keys are not asked for one by one: a bucket of keys is one state value, read and
written once a batch if rows of the bucket come, and a timer releases what has expired. Nor do rows go there one by one: those
of a bucket that a task has read travel as one pack, of which the processor opens the hashes and times only.

The watermark is that of the batches before; rows behind it are late. They do not come back as copies: the first row of
an unknown key is written as ``late``, and remembered like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewatch.session import SPEED_CONF, scoped_conf

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NEW, COPY, LATE = ROUTES = ("new", "copy", "late")
#: Buckets of keys. A task holds the keys of one, 24 bytes each in state; a checkpoint stays with its number.
BUCKETS = 2048
#: Files of a route and day that one batch writes, at most.
FILES = 8
_OWN = ("_bucket", "_first", "_second", "_event_ms")
#: Bytes of rows that a task gathers before it packs them, and rows it unpacks at a time, at least.
PACK_BYTES, UNPACKED_ROWS = 8 << 20, 10_000
_PACKED = "_bucket int, first binary, second binary, event_ms binary, rows binary"
_ROUTED = "rows binary, routes binary"


class Router(StatefulProcessor):
    """One bucket's rows of a batch, and what is known of its keys. At most one row of each new key is held.

    A key is known by 128 bits of hashes, and as long as the watermark has not reached the end of its lifetime.
    """

    def __init__(self, names: list[str], lifetime_ms: int):
        self.names, self.lifetime_ms = [*names, "route"], lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.made = Row(*self.names)
        fields = [T.StructField(name, T.BinaryType()) for name in ("first", "second", "until")]
        self.seen = handle.getValueState("seen", T.StructType(fields))

    def _known(self, watermark: int) -> dict[tuple[int, int], int]:
        held = self.seen.get()
        if held is None:
            return {}
        first, second, until = (np.frombuffer(part, dtype=np.int64) for part in held)
        alive = until > watermark
        keys = zip(first[alive].tolist(), second[alive].tolist(), strict=True)
        return dict(zip(keys, until[alive].tolist(), strict=True))

    def _keep(self, known: dict[tuple[int, int], int]) -> None:
        if not known:
            self.seen.clear()
            return
        keys = np.array(list(known), dtype=np.int64).reshape(-1, 2)
        until = np.fromiter(known.values(), dtype=np.int64, count=len(known))
        self.seen.update((keys[:, 0].tobytes(), keys[:, 1].tobytes(), until.tobytes()))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # The last columns are those of _OWN: the time in milliseconds is the very last.
        watermark, own = timerValues.getCurrentWatermarkInMs(), len(_OWN)
        known, best = self._known(watermark), {}
        for row in rows:
            key_of = (row[-3], row[-2])
            if key_of not in known:
                held = best.get(key_of)
                # The earliest row of the batch stands for the key; the one it outdoes is a copy.
                if held is None or row[-1] < held[-1]:
                    best[key_of], row = row, held
            if row is not None:
                yield self.made(*row[:-own], COPY)
        if best:
            known.update({k: max(row[-1], watermark) + self.lifetime_ms for k, row in best.items()})
            self._keep(known)
            self.handle.registerTimer(max(known[k] for k in best))
            for row in best.values():
                yield self.made(*row[:-own], LATE if row[-1] < watermark else NEW)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._keep(self._known(timerValues.getCurrentWatermarkInMs()))
        return iter(())

    def close(self) -> None:
        pass


class PackRouter(Router):
    """The same for packs of rows: each comes back as it is, with a byte for the route of each of its rows."""

    def __init__(self, lifetime_ms: int):
        super().__init__(["pack", "place"], lifetime_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.made = lambda *values: values

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        packs, routes = [], []

        def opened():
            for number, (_, *hashes_and_times, packed) in enumerate(rows):
                first, second, millis = (np.frombuffer(part, dtype=np.int64).tolist() for part in hashes_and_times)
                packs.append(packed)
                routes.append(bytearray(len(first)))
                yield from zip(repeat(number), range(len(first)), repeat(key), first, second, millis)

        code = {route: number for number, route in enumerate(ROUTES)}
        for number, place, route in super().handleInputRows(key, opened(), timerValues):
            routes[number][place] = code[route]
        made = Row("rows", "routes")
        for packed, codes in zip(packs, routes, strict=True):
            yield made(packed, bytes(codes))


def _packs(rows: pa.Table) -> pa.RecordBatch:
    """A row for each bucket: the hashes and times of its rows, and the rows in Arrow's stream format."""
    buckets = rows["_bucket"].to_numpy()
    order = np.argsort(buckets, kind="stable")
    buckets, rows = buckets[order], rows.take(pa.array(order)).combine_chunks()
    parts = [rows[name].to_numpy() for name in _OWN[1:]]
    plain = rows.drop_columns(list(_OWN))
    starts = np.flatnonzero(np.diff(buckets, prepend=buckets[0] - 1))
    out = {name: [] for name in ("_bucket", "first", "second", "event_ms", "rows")}
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(buckets)], strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, plain.schema) as writer:
            writer.write_table(plain.slice(start, end - start))
        values = [int(buckets[start]), *(part[start:end].tobytes() for part in parts), sink.getvalue().to_pybytes()]
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds, strict=True)], names=list(out))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PACK_BYTES:
            yield _packs(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield _packs(pa.Table.from_batches(held))


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, held, count = pa.array(ROUTES), [], 0
    for batch in batches:
        for packed, codes in zip(batch.column(0), batch.column(1), strict=True):
            rows = pa.ipc.open_stream(packed.as_buffer()).read_all()
            held.append(rows.append_column("route", names.take(pa.array(np.frombuffer(codes.as_buffer(), dtype=np.uint8)))))
            count += rows.num_rows
            if count >= UNPACKED_ROWS:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, count = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def key_hash(keys: list[str], seed: int) -> Column:
    """64 bits of a key. Whether a part is null counts too: the hash itself passes nulls over."""
    return F.xxhash64(F.lit(seed), *[c for k in keys for c in (F.col(k).isNull(), F.col(k))])


def routed(
    stream: DataFrame, keys: list[str], time: str = "date", lateness: str = "1 day", lifetime: str = "1 day", buckets: int = BUCKETS
) -> DataFrame:
    """All rows of a stream with their ``route``. A null key is a key; a null time counts as the earliest.

    The watermark belongs to a column that goes no further than here, or Spark would drop late rows itself.
    """
    plain = T.StructType([*stream.schema.fields, T.StructField("route", T.StringType())])
    spark = stream.sparkSession
    lifetime_ms = spark.sql(f"SELECT CAST(unix_millis(TIMESTAMP_LTZ '1970-01-01 00:00:00Z' + INTERVAL {lifetime}) AS BIGINT)").first()[0]
    millis = F.coalesce(F.unix_millis(F.col(time).cast("timestamp")), F.lit(0))
    timed = stream.withColumn("_clock", F.col(time).cast("timestamp")).withWatermark("_clock", lateness)
    first, second = key_hash(keys, 1), key_hash(keys, 2)
    made = dict(zip(_OWN, (F.pmod(first, F.lit(buckets)).cast("int"), first, second, millis), strict=True))
    rows = timed.select(*stream.columns, *[c.alias(name) for name, c in made.items()])
    packed = rows.mapInArrow(pack, _PACKED).groupBy("_bucket")
    return packed.transformWithState(PackRouter(lifetime_ms), _ROUTED, "Append", "EventTime").mapInArrow(unpack, plain)


def stream_routes(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    keys: list[str],
    time: str = "date",
    lateness: str = "1 day",
    lifetime: str = "1 day",
) -> StreamingQuery:
    """Append every row to a table by ``route`` and ``day``, then stop when all that has arrived is done.

    The file sink commits a batch as a whole, so a batch that is run again adds nothing twice.
    """
    rows = routed(stream, keys, time, lateness, lifetime).withColumn("day", F.to_date(time))
    # A route and day is a few files of a batch, not one for each task with state.
    dealt = rows.repartition("route", "day", F.pmod(key_hash(keys, 3), F.lit(FILES)))
    # Keyed state of this kind is kept by RocksDB only. Lifetimes are compared with the watermark when rows
    # come, so a batch without rows would only start every task to release state a little earlier.
    settings = {_PROVIDER: SPEED_CONF[_PROVIDER], "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with scoped_conf(stream.sparkSession, settings):
        return (
            dealt.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .partitionBy("route", "day")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
