"""What the operators of this folder share: reading, row keys, model samples and scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

#: A row belongs to the held-out quarter when the CRC-32 of its id, as text, leaves this remainder by four.
HELD_OUT = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def row_key() -> Column:
    """Tells rows apart whose ids are equal or null: a hash of id and text.

    Rows equal in both have equal keys, so operators count them as copies.
    """
    return F.xxhash64("doc_id", "text")


def keyed(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("row_key", row_key())


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left["row_key"] == right["row_key"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def held_out() -> Column:
    """Rows no model may learn from. A row without an id is not held out, but not learnt from either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def may_learn() -> Column:
    return F.col("doc_id").isNotNull() & ~held_out()


def draw(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the seed and the columns alone."""
    hashed = F.xxhash64(F.lit(seed), *columns)
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the plan behind it is cut, and a
    lost executor costs nothing of what was done before."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
