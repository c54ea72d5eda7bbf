"""The events table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.session import scratch_path
from tidewatch.streaming import counts_so_far, ingested, stream_counts, stream_ingest, stream_routes


def _stream(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _counts(spark: SparkSession, sf: str, width: str) -> DataFrame:
    path = scratch_path(spark, "window-counts")
    stream = _stream(spark, sf, "events.parquet")
    stream_counts(stream, f"{path}/counts", f"{path}/state", "ts", width, "event_type").awaitTermination()
    return counts_so_far(spark, f"{path}/counts")


@query(
    """SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, event_type, count(*) AS count
FROM events GROUP BY ALL""",
    stamps=("window_start", "window_end"),
)
def stream_quarter_hour_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts kept up to date by the stream alone, open windows included."""
    return _counts(spark, sf, "15 minutes")


@query(
    """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS count FROM events GROUP BY ALL""",
    stamps=("window_start", "window_end"),
)
def stream_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf, "1 day")


@query(
    """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS count FROM events GROUP BY ALL""",
    stamps=("window_start", "window_end"),
)
def stream_late_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events in three runs, each over all days: most rows of the later ones are late, and correct the counts."""
    path = scratch_path(spark, "late-counts")
    events = tables.table(spark, sf, "events").select("event_id", "event_type", "ts")
    for run in range(3):
        events.where(F.col("event_id") % 3 == run).write.mode("append").parquet(f"{path}/arrived")
        stream = _stream(spark, f"{path}/arrived", "*.parquet")
        stream_counts(stream, f"{path}/counts", f"{path}/state", "ts", "1 day", "event_type").awaitTermination()
    return counts_so_far(spark, f"{path}/counts")


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events", dates=("day",))
def stream_dedup_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """A first run lacks some events; the second has every event, copies and late ones. The stream writes each once."""
    path = scratch_path(spark, "stream-ingest")
    events = tables.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    for part in (events.where("event_id % 10 <> 3"), events):
        part.write.mode("append").parquet(f"{path}/arrived")
        stream = _stream(spark, f"{path}/arrived", "*.parquet")
        stream_ingest(stream, f"{path}/table", f"{path}/state", ["event_id"], "ts", lifetime="60 days").awaitTermination()
    return ingested(spark, f"{path}/table").select("event_id", "user_id", "event_type", "day")


#: Runs in which an event arrives: all but a tenth in the first, that tenth and some again in the second, some again in the third.
_ARRIVALS = ("event_id % 10 <> 3", "event_id % 10 = 3 OR event_id % 7 = 0", "event_id % 5 = 0")


@query(
    f"""WITH runs AS (
  SELECT 0 AS run, * FROM events WHERE {_ARRIVALS[0]}
  UNION ALL SELECT 1, * FROM events WHERE {_ARRIVALS[1]}
  UNION ALL SELECT 2, * FROM events WHERE {_ARRIVALS[2]}),
clocks AS (SELECT run, max(epoch_ms(ts)) AS latest FROM runs GROUP BY run),
marks AS (SELECT run, coalesce(max(latest) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000, 0) AS mark
  FROM clocks),
placed AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY run) AS nth FROM runs JOIN marks USING (run))
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
       CASE WHEN nth > 1 THEN 'copy' WHEN epoch_ms(ts) < mark THEN 'late' ELSE 'new' END AS route FROM placed""",
    dates=("day",),
)
def stream_ingest_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Events in three runs, some again; the stream says of each row whether it is new, a copy or late."""
    path = scratch_path(spark, "stream-routes")
    events = tables.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    for arrival in _ARRIVALS:
        events.where(arrival).write.mode("append").parquet(f"{path}/arrived")
        stream = _stream(spark, f"{path}/arrived", "*.parquet")
        stream_routes(stream, f"{path}/table", f"{path}/state", ["event_id"], "ts", lifetime="60 days").awaitTermination()
    return spark.read.parquet(f"{path}/table").select("event_id", "user_id", "event_type", "day", "route")
