"""Reproducible draws, splits and spreads."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.keys import chosen, hash_index, hash_key
from tidewatch.operators.ranking import overall_rank, rank_in_group


def sample_granules(df: DataFrame, granule: str, p: float = 0.15, seed: int = 4) -> DataFrame:
    """Keep whole granules, a share ``p`` of them.

    The choice depends on the granule and the seed alone, so two feeds sampled
    with one seed keep the same granules and their articles still meet in a join.
    """
    return df.where(chosen(hash_key(seed, granule), p))


def sample_n(df: DataFrame, n: int, seed: int, ids: list[str], by: str | None = None) -> DataFrame:
    """``n`` rows drawn uniformly, or ``n`` per group of ``by``.

    Both forms keep at most ``n`` rows per task (and group) before the shuffle.
    """
    hashed = df.withColumn("_hash", hash_key(seed, *ids))
    order = ["_hash", *ids]
    if by is None:
        return hashed.orderBy(*order).limit(n).drop("_hash")
    w = Window.partitionBy(by).orderBy(*order)
    return hashed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_hash", "_rn")


def permute(df: DataFrame, seed: int, ids: list[str]) -> DataFrame:
    """All rows in a reproducible random order."""
    hashed = df.withColumn("_hash", hash_key(seed, *ids))
    return hashed.orderBy("_hash", *ids).drop("_hash")


def oversample(df: DataFrame, label: str, ids: list[str], seed: int, ranges: int | None = None) -> DataFrame:
    """Draw rows of the smaller classes with replacement until all classes are equal.

    The originals have ``draw`` 0, the copies 1, 2, ... Draw j of a class takes
    the row whose random rank equals hash(seed, class, j) modulo the class size.
    The driver sees one count per class; draws are made and joined on executors.
    """
    spark = df.sparkSession
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] is not None}
    columns = [F.col(f"`{c}`") for c in df.columns]
    result = df.select(*columns, F.lit(0).cast("bigint").alias("draw"))
    most = max(sizes.values(), default=0)
    short = {value: n for value, n in sizes.items() if n < most}
    if not short:
        return result
    kind = df.schema[label].dataType
    picks = functools.reduce(
        DataFrame.unionByName,
        [
            spark.range(1, most - n + 1).select(
                F.lit(value).cast(kind).alias("_label"),
                F.col("id").alias("draw"),
                hash_index(hash_key(seed, F.lit(value).cast(kind), F.col("id")), F.lit(n)).alias("_pick"),
            )
            for value, n in short.items()
        ],
    )
    ranked = rank_in_group(df.where(F.col(label).isin(list(short))), [label], ids, seed, ranges)
    copies = ranked.join(picks, (F.col(label) == F.col("_label")) & (F.col("rank0") == F.col("_pick")))
    return result.unionByName(copies.select(*columns, "draw"))


def split_by_time(df: DataFrame, column: str, cutoffs: list, names: list[str] | None = None) -> DataFrame:
    """Add ``split``: the name of the period a row falls in, each cutoff starting the next period."""
    names = names or ["train", "validation", "test"][: len(cutoffs) + 1]
    if len(names) != len(cutoffs) + 1:
        raise ValueError("one more name than cutoffs is needed")
    pairs = list(zip(cutoffs, names))
    first = F.when(F.col(column) < F.lit(pairs[0][0]), pairs[0][1])
    split = functools.reduce(lambda c, pair: c.when(F.col(column) < F.lit(pair[0]), pair[1]), pairs[1:], first)
    return df.withColumn("split", split.otherwise(names[-1]))


def ntile_of(rank0: Column, total: Column, k: int) -> Column:
    """Bucket 1..k of a 0-based rank; the first ``total mod k`` buckets hold one row more."""
    size = F.floor(total / k)
    extra = total - size * k
    wide = extra * (size + 1)
    return (
        F.when(rank0 < wide, F.floor(rank0 / (size + 1)))
        .otherwise(extra + F.floor(F.try_divide(rank0 - wide, size)))
        .cast("int")
        + 1
    )


def bucket_rows(df: DataFrame, order: str, k: int = 12, name: str = "bucket", ranges: int | None = None) -> DataFrame:
    """Spread all rows evenly over ``k`` buckets along a unique number column."""
    ranked = overall_rank(df, order, ranges)
    return ranked.withColumn(name, ntile_of(F.col("rank0"), F.col("n_rows"), k)).drop("rank0", "n_rows")
