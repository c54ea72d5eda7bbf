"""Training samples: random groups of articles as matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.arrays import pad_rows, reshape
from tidewatch.functions.keys import hash_key
from tidewatch.operators.joins import lagged_window_join
from tidewatch.operators.ranking import rank_in_group


def article_samples(
    df: DataFrame,
    keys: list[str],
    n: int,
    seed: int,
    width: int,
    id_column: str = "url",
    date: str = "date",
    vector: str = "docembed",
    ranges: int | None = None,
) -> DataFrame:
    """Random groups of ``n`` articles per key, each a matrix of ``n`` rows sorted by date.

    What is left after the last full group is dropped, but a key with fewer than
    ``n`` articles gives one group padded with zero rows. Groups are made from
    reproducible random ranks, so collecting one never holds more than ``n`` rows.
    """
    ranked = rank_in_group(df.select(*keys, id_column, date, vector), keys, [id_column], seed, ranges)
    grouped = (
        ranked.withColumn("sample", F.floor(F.col("rank0") / n).cast("int"))
        .groupBy(*keys, "sample")
        .agg(F.array_sort(F.collect_list(F.struct(date, id_column, vector))).alias("_rows"))
        .where((F.size("_rows") == n) | (F.col("sample") == 0))
    )
    matrix = pad_rows(F.col("_rows").getField(vector), n, width)
    return grouped.select(
        *keys,
        "sample",
        F.size("_rows").alias("n_articles"),
        F.col("_rows").getField(id_column).alias("article_ids"),
        F.flatten(matrix).alias("embeddings"),
        F.lit(n).cast("bigint").alias("height"),
        F.lit(width).cast("bigint").alias("width"),
    )


def labelled_samples(
    articles: DataFrame,
    labels: DataFrame,
    y: str,
    n: int,
    width: int,
    seed: int,
    lag: int = 2,
    n_months: int = 1,
    key: str = "country",
    month: str = "month",
    id_column: str = "url",
    date: str = "date",
    vector: str = "docembed",
    y_type: str = "bigint",
    ranges: int | None = None,
) -> DataFrame:
    """Samples of the articles in each label's look-back, with the label value ``y``.

    ``articles`` holds one row per article and ``key``. The label is attached
    after sampling, to the finished matrices.
    """
    dated = articles.select(key, id_column, date, vector, F.trunc(F.col(date), "MM").alias("_article_month"))
    wanted = labels.select(key, F.col(month).alias("target_month"))
    pooled = lagged_window_join(dated, wanted, key, "_article_month", "target_month", lag, n_months)
    samples = article_samples(
        pooled, [key, "target_month"], n, seed, width, id_column, date, vector, ranges
    )
    values = labels.select(key, F.col(month).alias("target_month"), F.col(y).cast(y_type).alias("label"))
    return samples.join(values, [key, "target_month"])


def failed_keys(wanted: DataFrame, built: DataFrame, keys: list[str]) -> DataFrame:
    """Keys no sample could be built for, as an error log."""
    missing = wanted.select(*keys).distinct().join(built.select(*keys).distinct(), keys, "left_anti")
    shown = F.concat_ws("_", *[F.col(k).cast("string") for k in keys])
    return missing.select(*keys, F.concat(F.lit("no sample for "), shown).alias("message"))


def stack_groups(samples: DataFrame, keys: list[str], vector: str, limit: int) -> DataFrame:
    """Sequences of group vectors per key, ordered by group number and ``limit`` to a sequence.

    ``vector`` is whatever a scorer made of each group. A key with more groups
    gives several sequences, numbered by ``stack``; the last one may be shorter.
    """
    placed = samples.withColumn("stack", F.floor(F.col("sample") / limit).cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct("sample", vector)))
    return placed.groupBy(*keys, "stack").agg(
        ordered.getField(vector).alias("sequence"), F.count(F.lit(1)).alias("n_groups")
    )


def as_matrix(samples: DataFrame) -> DataFrame:
    """Flat sample values back to ``height`` rows of ``width`` values."""
    return samples.withColumn("matrix", reshape("embeddings", F.col("height"), F.col("width")))


def shuffled(samples: DataFrame, seed: int, ids: list[str]) -> DataFrame:
    """Training order: samples by hash, so that neighbours are unrelated."""
    return samples.orderBy(hash_key(seed, *ids))
