"""Which countries an article is about."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.arrays import first_distinct, item
from tidewatch.functions.text import country_codes
from tidewatch.schemas import COUNTRY_COLUMNS


def country_columns(n: int) -> list[str]:
    """``country-1`` and on; three unless asked for more."""
    return [f"country-{i}" for i in range(1, n + 1)]


def _slots(df: DataFrame) -> list[str]:
    """The country columns a table has, in order."""
    held = set(df.columns)
    return list(itertools.takewhile(held.__contains__, (f"country-{i}" for i in itertools.count(1))))


def _quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def extract_countries(df: DataFrame, locations: str = "V2Locations", names: str = "one_word") -> DataFrame:
    """Add ``countries``: all country-level codes in text order, repeats included."""
    return df.withColumn("countries", country_codes(locations, names))


def top_countries(
    df: DataFrame,
    locations: str = "V2Locations",
    names: str = "one_word",
    with_list: bool = False,
    n: int = len(COUNTRY_COLUMNS),
) -> DataFrame:
    """Add ``country-1`` .. ``country-n``, the first ``n`` distinct codes, null when fewer.

    ``with_list`` also adds all distinct codes and their number.
    """
    found = df.withColumn("top_countries", first_distinct(country_codes(locations, names)))
    spread = [item("top_countries", i).alias(c) for i, c in enumerate(country_columns(n))]
    if with_list:
        count = F.coalesce(F.size(F.col("top_countries")), F.lit(0)).alias("num_countries")
        return found.select("*", count, *spread)
    return found.select("*", *spread).drop("top_countries")


def drop_unlocated(df: DataFrame) -> DataFrame:
    """Keep articles with at least one country."""
    return df.where(F.col(f"`{COUNTRY_COLUMNS[0]}`").isNotNull())


def explode_countries(df: DataFrame, name: str = "country") -> DataFrame:
    """One row per article and country, of as many columns as there are; ``country_idx`` says which it was."""
    held = _slots(df)
    others = [c for c in df.columns if c not in held]
    slots = F.posexplode(F.array(*_quoted(held))).alias("_pos", name)
    return (
        df.select(*_quoted(others), slots)
        .where(F.col(name).isNotNull())
        .select(*_quoted(others), (F.col("_pos") + 1).alias("country_idx"), name)
    )


def mentions(country: str, n: int = len(COUNTRY_COLUMNS)) -> Column:
    """True when any of the ``n`` country columns is ``country``; never null."""
    return F.array_contains(F.array_compact(F.array(*_quoted(country_columns(n)))), F.lit(country))


def seen_countries(df: DataFrame) -> DataFrame:
    """Every code that appears in any of the columns."""
    return explode_countries(df.select(*_quoted(_slots(df)))).select("country").distinct()


def stack_manifest(df: DataFrame, yearmonth: str = "yearmonth") -> DataFrame:
    """Articles per month and country, with the name of that pair."""
    counted = explode_countries(df).groupBy(yearmonth, "country").count()
    name = F.concat_ws("_", F.col(yearmonth), F.col("country"))
    return counted.select(name.alias("filename"), F.col(yearmonth), "country", "count")
