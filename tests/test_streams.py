import datetime
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.sinks.versions import published
from tidewatch.streaming import counts_so_far, ingested, stream_counts, stream_ingest, stream_routes, window_counts
from tidewatch.streaming.feeds import _merge_batch
from tidewatch.streaming.routes import PackRouter, Router, key_hash, pack, unpack

SCHEMA = "url string, date timestamp"


def at(day, hour, minute=0):
    return datetime.datetime(2020, 1, day, hour, minute)


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_ingest_drops_copies_across_runs(spark, tmp_path):
    src, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        stream_ingest(stream, out, state, ["url"]).awaitTermination()
        return sorted(((r["url"], str(r["day"])) for r in ingested(spark, out).collect()), key=str)

    arrive(spark, src, [("a", at(1, 1)), ("a", at(1, 2)), ("b", at(1, 3)), (None, at(1, 4)), (None, at(1, 5))])
    first = [("a", "2020-01-01"), ("b", "2020-01-01")]
    assert sorted_known(run()) == first
    arrive(spark, src, [("b", at(1, 4)), ("c", at(1, 5))])
    assert sorted_known(run()) == [*first, ("c", "2020-01-01")]
    assert sorted_known(run()) == [*first, ("c", "2020-01-01")]
    assert spark.read.parquet(out).count() == 7


def sorted_known(rows):
    return [r for r in rows if r[0] is not None]


def test_rows_are_new_copies_or_late(spark, tmp_path):
    src, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def run(rows):
        arrive(spark, src, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        stream_routes(stream, out, state, ["url"], "date", "1 day", "3 days").awaitTermination()
        return {(r["url"], r["date"]): r["route"] for r in spark.read.parquet(out).collect()}

    routes = run([("a", at(9, 1)), ("a", at(8, 1)), ("b", at(9, 2)), ("old", at(1, 1))])
    assert routes == {("a", at(8, 1)): "new", ("a", at(9, 1)): "copy", ("b", at(9, 2)): "new", ("old", at(1, 1)): "new"}
    # The watermark is now a day before the ninth at two.
    routes = run([("c", at(8, 1)), ("c", at(8, 5)), ("d", at(8, 3)), ("a", at(7, 1)), ("e", at(9, 3))])
    assert {k: v for k, v in routes.items() if k[0] in "cde" or k == ("a", at(7, 1))} == {
        ("c", at(8, 1)): "late", ("c", at(8, 5)): "copy", ("d", at(8, 3)): "new", ("a", at(7, 1)): "copy", ("e", at(9, 3)): "new",
    }
    # Late keys are remembered as well; after a lifetime they are forgotten.
    routes = run([("c", at(8, 2)), ("f", at(20, 1))])
    assert routes[("c", at(8, 2))] == "copy" and routes[("f", at(20, 1))] == "new"
    routes = run([("b", at(20, 2))])
    assert routes[("b", at(20, 2))] == "new"
    assert len(routes) == 12


def test_many_rows_of_one_key(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("url"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod(F.col("id") * 7919, F.lit(30_000))).alias("date"),
    )
    rows.write.parquet(src)
    stream_ingest(spark.readStream.schema(SCHEMA).parquet(src), out, f"{tmp_path}/state", ["url"]).awaitTermination()
    first = {r["url"]: r["date"] for r in rows.groupBy("url").agg(F.min("date").alias("date")).collect()}
    assert {r["url"]: r["date"] for r in ingested(spark, out, late=False).collect()} == first
    assert spark.read.parquet(out).count() == 30_000


def files_under(path):
    return sum(f.endswith((".parquet", ".json")) for _, _, names in os.walk(path) for f in names)


def test_counts_correct_themselves_and_stay_small(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    sizes = []
    for run in range(20):
        arrive(spark, src, [("a", at(1 + run % 5, 1)), ("a", at(1, 1, run % 30)), ("b", at(9, run % 24))])
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        stream_counts(stream, out, f"{tmp_path}/state", "date", "15 minutes", "url").awaitTermination()
        sizes.append(files_under(out))
    expected = window_counts(spark.read.parquet(src), "date", "15 minutes", "url")
    assert sorted(map(tuple, counts_so_far(spark, out).collect())) == sorted(map(tuple, expected.collect()))
    # Six days, their versions before the last run, and two pointers.
    assert max(sizes) <= 16 and sizes[-1] <= sizes[8] + 2


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    out = f"{tmp_path}/out"
    batches = [spark.createDataFrame(rows, SCHEMA) for rows in ([("a", at(1, 1)), ("a", None)], [("a", at(1, 2)), ("b", at(2, 1))])]
    settings = (out, "counts", "date", "1 day", "url")
    for number in (0, 1, 1, 0):
        _merge_batch(batches[number].where("date is not null"), number, *settings)
    assert {(r["url"], r["window_start"].day): r["count"] for r in counts_so_far(spark, out).collect()} == {("a", 1): 2, ("b", 2): 1}
    assert published(spark, out).mark == "counts:1"
    _merge_batch(batches[0].limit(0), 2, *settings)
    assert counts_so_far(spark, out).count() == 2


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing has been published"):
        counts_so_far(spark, f"{tmp_path}/none")


class FakeState:
    """A handle and its one value state, which count their calls."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.append(at)

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark


def test_a_bucket_of_keys_is_one_state_value():
    """A thousand keys cost three calls of the state store, and are forgotten with their lifetime."""
    state, router = FakeState(), Router(["id"], 100)
    router.init(state)
    rows = lambda times: [(i, 0, i % 3, i, t) for t in times for i in range(1000)]
    state.watermark = 0
    first = [tuple(r) for r in router.handleInputRows((0,), iter(rows([20, 10, 30])), state)]
    assert state.calls == 3 and len(first) == 3000
    assert sorted(r[0] for r in first if r[1] == "new") == list(range(1000))
    state.watermark = 15
    assert {r[1] for r in router.handleInputRows((0,), iter(rows([5])), state)} == {"copy"}
    state.watermark = 109
    list(router.handleExpiredTimer((0,), state, None))
    assert state.timers == [110] and len(state.value[0]) == 8000
    state.watermark = 110
    assert {r[1] for r in router.handleInputRows((0,), iter(rows([50])), state)} == {"late"}
    assert state.timers == [110, 210]
    state.watermark = 210
    list(router.handleExpiredTimer((0,), state, None))
    assert state.value is None


def test_rows_of_a_bucket_travel_as_one_pack():
    """Three thousand rows of ten buckets, in three batches, are ten rows for the processors, and come back whole."""
    rows = pa.table({"id": pa.array([*range(999), None] * 3), "_bucket": pa.array([i % 10 for i in range(3000)], pa.int32()),
                     "_first": [i % 1000 for i in range(3000)], "_second": [0] * 3000, "_event_ms": [(i * 7) % 3000 for i in range(3000)]})
    (packed,) = pack(iter(rows.to_batches(max_chunksize=1000)))
    assert packed.num_rows == 10
    sent = []
    for n in range(10):
        state, router = FakeState(), PackRouter(100)
        state.watermark = 50
        router.init(state)
        one = packed.slice(n, 1).to_pylist()
        sent += [tuple(r) for r in router.handleInputRows((n,), iter(tuple(r.values()) for r in one), state)]
        assert state.calls == 3
    assert len(sent) == 10
    table = pa.RecordBatch.from_arrays([pa.array([r[i] for r in sent], pa.binary()) for i in (0, 1)], names=["rows", "routes"])
    made = pa.Table.from_batches(list(unpack(iter([table])))).to_pylist()
    by_id = {}
    for r in made:
        by_id.setdefault(r["id"], []).append(r["route"])
    assert len(made) == 3000 and len(by_id) == 1000
    least = {i if i < 999 else None: min((j * 7) % 3000 for j in (i, i + 1000, i + 2000)) for i in range(1000)}
    assert all(sorted(routes) == ["copy", "copy", "late" if least[i] < 50 else "new"] for i, routes in by_id.items())


def test_columns_of_all_kinds_come_through_the_stream(spark, tmp_path):
    """Nulls, large numbers, nested values and times outside the range of nanoseconds are as they were."""
    src = f"{tmp_path}/in"
    rows = spark.range(500).selectExpr(
        "id AS url", "CAST('2020-01-01' AS timestamp) + make_interval(0, 0, 0, 0, 0, 0, id) AS date",
        "IF(id % 3 = 0, NULL, 9007199254740993 + id) AS large", "IF(id % 5 = 0, NULL, double('NaN')) AS number",
        "timestamp'0999-01-01 01:02:03.000004' AS old", "CAST(id AS decimal(38, 10)) AS exact", "unhex(hex(id)) AS raw",
        "named_struct('a', IF(id % 2 = 0, NULL, id), 'b', array('x', NULL)) AS nested", "map('k', id) AS pairs",
    )
    rows.write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    stream_routes(stream, f"{tmp_path}/out", f"{tmp_path}/state", ["url"], "date").awaitTermination()
    made = spark.read.parquet(f"{tmp_path}/out")
    assert {r["route"] for r in made.select("route").distinct().collect()} == {"new"}
    assert dict(made.drop("route", "day").dtypes) == dict(rows.dtypes)
    assert sorted(map(repr, made.select(*rows.columns).collect())) == sorted(map(repr, spark.read.parquet(src).collect()))


def test_null_parts_of_a_key_are_told_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("a", "a"), ("", "a")], "x string, y string")
    assert df.select(key_hash(["x", "y"], 1).alias("h")).distinct().count() == 5
