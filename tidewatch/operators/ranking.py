"""Total order without a single task.

A window without PARTITION BY, or over one hot key, pulls everything it ranks
into one task. Here the order is cut into ranges first: every range is ranked
on its own, and the small table of range totals gives each range its start.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.keys import hash_fraction, hash_key
from tidewatch.session import shuffle_width


def range_bounds(df: DataFrame, order: str, ranges: int) -> list[float]:
    """Inner bounds that cut ``order`` into about equal ranges: at most ``ranges - 1`` values.

    ``ranges`` is the caller's: it may grow with the number of shuffle partitions.

    The bounds become literals, so a task that is run again cuts the same way.
    """
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    # A quarter of a range is near enough: the bounds decide the work, not the result.
    number = F.col(order).cast("double")
    found = df.select(F.percentile_approx(number, shares, 4 * ranges).alias("b")).first()["b"]
    return sorted({b for b in found or [] if math.isfinite(b)})


def with_range(df: DataFrame, order: str, bounds: list[float]) -> DataFrame:
    """Add ``_range``, the number of the range a value falls in, by binary search in the JVM."""
    if not bounds:
        return df.withColumn("_range", F.lit(0.0))
    splits = [float("-inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_order", outputCol="_range", handleInvalid="keep")
    return cut.transform(df.withColumn("_order", F.col(order).cast("double"))).drop("_order")


def running_totals(
    df: DataFrame, order: str, values: list[str], ranges: int | None = None, bounds: list[float] | None = None
) -> DataFrame:
    """Add ``<value>_before``, the total over all rows with a smaller ``order``, and ``<value>_total``.

    ``order`` must be a number without repeats or nulls; aggregate by it first, which
    also takes care of one value held by very many rows. ``bounds`` from an earlier
    `range_bounds` saves a pass.
    """
    if bounds is None:
        bounds = range_bounds(df, order, ranges or shuffle_width(df.sparkSession))
    cut = with_range(df, order, bounds)
    totals = cut.groupBy("_range").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    # One row per range, so as many as were asked for: some bytes each in one task and in the broadcast.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        F.col("_range").alias("_start_range"),
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_start_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(everything).alias(f"{v}_total") for v in values],
    )
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.join(F.broadcast(starts), F.col("_range") == F.col("_start_range"))
    made = [
        (F.col(f"_start_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0))).alias(f"{v}_before") for v in values
    ]
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], *made, *[f"{v}_total" for v in values])


def overall_rank(df: DataFrame, order: str, ranges: int | None = None) -> DataFrame:
    """Add ``rank0``, the 0-based place of each row along a unique number column, and ``n_rows``."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], ranges)
    return ranked.withColumnsRenamed({"_one_before": "rank0", "_one_total": "n_rows"}).drop("_one")


def rank_in_group(df: DataFrame, keys: list[str], ids: list[str], seed: int, ranges: int | None = None) -> DataFrame:
    """Add ``rank0``, a reproducible random 0-based place of each row in its group.

    Groups are shuffled by the hash of seed and id, and each is spread over ``ranges``
    ranges of that hash, by default as many as there are shuffle partitions: a hot group
    is ranked by all tasks. ``ranges`` changes the work but not the ranks, and no job runs
    while the plan is built. Null keys form a group like any other.
    """
    ranges = ranges or shuffle_width(df.sparkSession)
    hashed = df.withColumn("_hash", hash_key(seed, *ids))
    part = F.shiftrightunsigned(hash_fraction(F.col("_hash")) * ranges, 32).cast("int")
    # As fields of a struct, null keys meet in the join too.
    parted = hashed.withColumn("_part", part).withColumn("_key", F.struct(*keys))
    sizes = parted.groupBy("_key", "_part").count()
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_key", "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    w = Window.partitionBy("_key", "_part").orderBy("_hash", *ids)
    ranked = parted.withColumn("_place", F.row_number().over(w) - 1)
    # Both sides are hashed by (key, part): the ranked rows are not moved again.
    return (
        ranked.join(starts, ["_key", "_part"])
        .withColumn("rank0", (F.col("_start") + F.col("_place")).cast("bigint"))
        .select(*[F.col(f"`{c}`") for c in df.columns], "rank0")
    )
