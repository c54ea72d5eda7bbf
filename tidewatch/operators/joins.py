"""Joins between articles, embeddings, labels and dimensions.

No side is marked for broadcast here: Catalyst broadcasts a side only when its
size, from file statistics or measured by AQE, is under the session threshold,
and otherwise AQE splits the partitions of a hot key.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.dates import shift_key
from tidewatch.schemas import CODE_OVERRIDES


def join_articles(
    articles: DataFrame,
    embeddings: DataFrame,
    article_day: str = "day",
    article_url: str = "DocumentIdentifier",
    embedding_day: str = "day",
    embedding_url: str = "url",
) -> DataFrame:
    """Articles with their embedding of the same day; year and month come from the embedding date."""
    right = embeddings.withColumnRenamed(embedding_day, "_day").withColumnRenamed(embedding_url, "_url")
    same = (F.col(article_day) == F.col("_day")) & (F.col(article_url) == F.col("_url"))
    return (
        articles.join(right, same)
        .drop("_day", "_url")
        .withColumns(
            {
                "year": F.year("date"),
                "month": F.month("date"),
                "yearmonth": F.date_format("date", "yyyyMM"),
            }
        )
    )


def apply_overrides(codes: DataFrame, country: str = "Country", code: str = "Fips_10") -> DataFrame:
    """Replace codes by the manual ones, and add the countries the list lacks."""
    spark = codes.sparkSession
    manual = spark.createDataFrame(list(CODE_OVERRIDES.items()), f"`{country}` string, _manual string")
    merged = codes.join(manual, country, "full")
    kept = [F.col(f"`{c}`") for c in codes.columns if c not in (country, code)]
    return merged.select(country, F.coalesce("_manual", code).alias(code), *kept)


def with_country_code(df: DataFrame, codes: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Add columns of a country dimension; null for an unknown country."""
    return df.join(codes.select(on, *columns), on, "left")


def join_labels(features: DataFrame, labels: DataFrame, on: list[str]) -> DataFrame:
    return features.join(labels, on)


def label_months(labels: DataFrame, month: str, lag: int, n_months: int, name: str = "feature_month") -> DataFrame:
    """One row per label and feature month: the ``n_months`` months ending ``lag`` before the label."""
    back = F.explode(F.sequence(F.lit(lag), F.lit(lag + n_months - 1)))
    return labels.withColumn("_back", back).withColumn(name, F.add_months(F.col(month), -F.col("_back"))).drop("_back")


def lagged_window_join(
    features: DataFrame,
    labels: DataFrame,
    key: str,
    feature_month: str,
    label_month: str,
    lag: int = 2,
    n_months: int = 1,
) -> DataFrame:
    """Attach each feature row to the labels whose look-back holds its month.

    The range over months becomes an equi-join on (key, month): the labels, one
    row per key and month, are repeated ``n_months`` times; the features never are
    before the join.
    """
    wanted = label_months(labels, label_month, lag, n_months, "_feature_month").withColumnRenamed(key, "_key")
    match = (F.col(key) == F.col("_key")) & (F.col(feature_month) == F.col("_feature_month"))
    return features.join(wanted, match).drop("_key", "_feature_month")


def lookback(date: Column | str, target: Column, n: int) -> Column:
    """True from the first day of the month ``n`` back up to the first day of the target month."""
    date = F.col(date) if isinstance(date, str) else date
    first = F.trunc(target, "MM")
    return (date >= F.add_months(first, -n)) & (date < first)


def labelled_sample(
    articles: DataFrame,
    labels: DataFrame,
    country: str,
    month: str,
    n: int,
    y: str,
    date: str = "date",
) -> DataFrame:
    """Rows of ``country`` in the ``n`` months before ``month``, each with the label of that month."""
    target = F.to_date(F.lit(month))
    rows = articles.where((F.col("country") == country) & lookback(date, target, n))
    label = labels.where((F.col("country") == country) & (F.col("month") == target)).select("country", y)
    return rows.join(label, "country")


def pending(wanted: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Wanted keys that are not done yet."""
    return wanted.join(done.select(*on), on, "left_anti")


def common_categories(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Categories present on both sides."""
    return a.select(column).distinct().join(b.select(column).distinct(), column, "left_semi")


def union_all(*frames: DataFrame) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def mean_dataset(means: DataFrame, spikes: DataFrame, key: str = "fips", lag: int = 2) -> DataFrame:
    """Monthly mean embeddings with the spike label ``lag`` months later.

    Month columns are ``YYYY-MM`` text: ``window`` on the means, ``target_window`` on the spikes.
    """
    targeted = means.withColumn("target_window", shift_key("window", lag))
    labels = spikes.select(key, "target_window", F.col("spike").alias("lagged_spike")).distinct()
    return targeted.join(labels, [key, "target_window"])
