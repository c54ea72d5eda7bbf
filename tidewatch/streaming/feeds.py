"""The 15-minute feed as a stream: incremental ingest and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.session import stored
from tidewatch.sinks.versions import publish_partitions, published, read_published
from tidewatch.streaming.routes import COPY, stream_routes


def stream_ingest(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    keys: list[str],
    time: str = "date",
    lateness: str = "1 day",
    lifetime: str | None = None,
) -> StreamingQuery:
    """Append new rows to a table partitioned by route and day, one row per key.

    A key seen again within ``lifetime`` (``lateness`` unless given) is a copy, also when it comes in a later run. Rows later than
    ``lateness`` go to the table's ``late`` route. `ingested` reads what was written.
    """
    return stream_routes(stream, out, checkpoint, keys, time, lateness, lifetime or lateness)


def ingested(spark: SparkSession, out: str, late: bool = True) -> DataFrame:
    """One row for each key that `stream_ingest` has written, with or without those that came too late."""
    rows = spark.read.parquet(out).where(F.col("route") != COPY)
    return rows if late else rows.where(F.col("route") == "new")


def window_counts(rows: DataFrame, time: str, width: str, key: str) -> DataFrame:
    """Rows per tumbling window and key, of a table or of one batch of a stream."""
    return (
        rows.groupBy(F.window(time, width).alias("_w"), key)
        .count()
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), key, "count")
    )


def _merge_batch(batch: DataFrame, number: int, out: str, run: str, time: str, width: str, key: str) -> None:
    """Add a batch to the counts of the days its windows start on, and publish those days in one step."""
    spark = batch.sparkSession
    mark = f"{run}:{number}"
    last = published(spark, out).mark
    # A batch that is run again has either published all of its days or none.
    if last is not None and last.startswith(f"{run}:") and int(last.rpartition(":")[2]) >= number:
        return
    counted = window_counts(batch, time, width, key).withColumn("day", F.to_date("window_start").cast("string"))
    new = stored(counted, "batch-counts")
    days = [r["day"] for r in new.select("day").distinct().collect() if r["day"] is not None]
    if not days:
        return
    both = new if last is None else new.unionByName(read_published(spark, out, days))
    groups = [F.col(c) for c in ("window_start", "window_end", key, "day")]
    publish_partitions(both.groupBy(*groups).agg(F.sum("count").alias("count")), out, "day", days, mark)


def stream_counts(
    stream: DataFrame, out: str, checkpoint: str, time: str, width: str, key: str, run: str = "counts"
) -> StreamingQuery:
    """Keep the count of each window and key up to date, however late its rows come. `counts_so_far` reads them.

    Each batch rewrites the days its windows start on, from their last version and the batch's own counts, so work follows the
    rows that arrive and the days they touch. A day is one version at a time and old ones are removed: the number of files
    is that of the days, not of the batches. Nothing is kept in state. A batch that is run again changes nothing;
    ``run`` names the checkpoint the batch numbers belong to. Rows without a time are not counted.
    """

    def write(batch: DataFrame, number: int) -> None:
        _merge_batch(batch.where(F.col(time).isNotNull()), number, out, run, time, width, key)

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def counts_so_far(spark: SparkSession, out: str) -> DataFrame:
    """The count of each window and key, of all rows that have arrived."""
    return read_published(spark, out).drop("day")
