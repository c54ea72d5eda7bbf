"""Writers. Each one runs the job it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import scoped_conf

# File and row-group limits of the written tables.
ROWS_PER_FILE = 600_000
ROW_GROUP_BYTES = 128 * 1024 * 1024
PARTITION_SIZE = "100MB"

WRITE_CONF = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARTITION_SIZE,
}


def rebalance(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Even out output partitions before a write.

    With keys, rows of one table folder come together so that each folder gets
    few files; AQE splits a folder that is too large for one task and merges small ones.
    """
    return df.hint("rebalance", *[F.col(f"`{k}`") for k in keys]) if keys else df.hint("rebalance")


def _write(
    df: DataFrame, path: str, keys: list[str] | None, mode: str, rows_per_file: int = ROWS_PER_FILE, **options: str
) -> None:
    with scoped_conf(df.sparkSession, WRITE_CONF):
        writer = (
            rebalance(df, keys)
            .write.mode(mode)
            .option("compression", "snappy")
            .option("maxRecordsPerFile", rows_per_file)
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .options(**options)
        )
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(path)


def write_table(
    df: DataFrame, path: str, keys: list[str] | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write a table, replacing all of it. ``keys`` become folders, of files of at most ``rows_per_file`` rows."""
    _write(df, path, keys, "overwrite", rows_per_file, partitionOverwriteMode="static")


def overwrite_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the folders ``df`` has rows for and leave the others: a rerun of a day changes nothing else."""
    _write(df, path, keys, "overwrite", partitionOverwriteMode="dynamic")


def append_table(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    _write(df, path, keys, "append")


def write_samples(df: DataFrame, path: str, max_rows: int) -> None:
    """Training samples, at most ``max_rows`` to a file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows).parquet(path)


def write_csv(df: DataFrame, path: str, keys: list[str] | None = None, mode: str = "overwrite") -> None:
    """CSV with a header, optionally one folder per key."""
    writer = df.write.mode(mode).option("header", "true")
    (writer.partitionBy(*keys) if keys else writer).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, gzip."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_manifest(df: DataFrame, path: str, description: dict[str, str]) -> None:
    """A small JSON table: ``df`` (counts, failed keys) with the settings it was made with."""
    settings = [F.lit(str(value)).alias(name) for name, value in description.items()]
    df.select("*", *settings).write.mode("overwrite").json(path)
