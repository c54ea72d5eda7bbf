"""Mixing sources to target weights, in DataFrame functions only.

Sources, ordered by code point with null last, weigh 1, 2, 3 and so on again. They share all words by
weight; a target stops at `MOST` times its source, and what is above is shared anew by weight
among the rest. That end state has one level: a source has ``min(MOST * size, level * weight)``,
found with running totals over the sources sorted by ``size / weight``.

A document is taken ``floor(rate)`` times, plus once with the probability of the fraction; the draw
is a hash of seed, id, text and, among rows equal in id, source and text, their number. Rates never exceed `MOST`, so no
document is taken more often.

Odd input: a null or blank text has size 0; rows without an id or with one id draw each on their own, equal rows as well;
a source of size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

MOST = 3
SEED = 17


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target``: one row for each source, so the windows without
    partition see as many rows as there are sources."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.withColumn("weight", (place % 3 + 1).cast("bigint"))
    tight = (F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    onward = Window.orderBy(*tight).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = Window.orderBy(*tight).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(*tight).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    levels = weighed.select(
        "source", "source_size", "weight",
        # The level if all sources before this one are at their limit, and this one is not.
        (left / F.sum("weight").over(onward)).alias("level"),
    )
    free = levels.withColumn("free", F.col("level") * F.col("weight") < MOST * F.col("source_size"))
    first = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(everything)
    settled = free.withColumn("settled", first)
    reached = F.col("settled") * F.col("weight") < MOST * F.col("source_size")
    return settled.select(
        "source", "source_size",
        F.when(reached, F.col("settled") * F.col("weight")).otherwise((MOST * F.col("source_size")).cast("double")).alias("target"),
    )


#: Rows of one key are numbered in as many parts, so that a key with a third of all rows is no single task's.
PARTS = 64


def draw(doc_id: Column, text: Column, number: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of seed, id, text and the number among equal rows."""
    held = lambda c: F.coalesce(c, F.lit("null"))
    name = F.concat_ws(":", F.lit(str(seed)), held(doc_id.cast("string")), held(F.md5(text.cast("binary"))), number.cast("string"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def _numbered(rows: DataFrame) -> DataFrame:
    """Append ``number``, from 1, among rows equal in id, source and text; which of them has which number does not matter.

    Only rows whose key is there more than once are shuffled. Their keys are counted first and written, so that Spark
    knows the size of that table when it joins it.
    """
    keyed = rows.withColumn("key", F.xxhash64("doc_id", "source", F.col("doc.text").cast("string")))
    again = stored(keyed.groupBy("key").count().where("count > 1").select("key"), "repeated-rows")
    if again.isEmpty():
        return rows.withColumn("number", F.lit(1).cast("bigint"))
    single = keyed.join(again, "key", "left_anti").withColumn("number", F.lit(1).cast("bigint")).drop("key")
    part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))
    # Written, so that the parts counted are the parts numbered.
    several = stored(keyed.join(again, "key", "left_semi").withColumn("part", part), "repeated-texts")
    sizes = several.groupBy("key", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("key", "part").orderBy("key"))
    placed = several.withColumn("inside", inside).join(offsets, ["key", "part"])
    return single.unionByName(placed.withColumn("number", F.col("inside") + F.col("offset")).drop("key", "part", "inside", "offset"))


def with_copies(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc`` (all columns), ``doc_id``, ``size``, ``source_size``, ``target`` and ``copies`` of each document."""
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size_in_words(F.col("text").cast("string")).alias("size"),
    )
    # Written, so that its size is known when the join is planned: a small table of sources is sent to the
    # documents, and texts are not shuffled by a source that may hold a third of them.
    targets = stored(source_targets(rows.select("source", "size")).withColumnRenamed("source", "name"), "targets")
    numbered = _numbered(rows)
    met = numbered.join(targets, numbered["source"].eqNullSafe(targets["name"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = draw(F.col("doc_id"), F.col("doc.text").cast("string"), F.col("number"), seed)
    more = (drawn < F.col("rate") - F.floor("rate")).cast("bigint")
    return met.withColumn("rate", rate).select(
        "doc", "doc_id", "size", "source_size", "target", (F.floor("rate") + more).alias("copies")
    )


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns."""
    taken = with_copies(docs, seed).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")).select("doc.*")
