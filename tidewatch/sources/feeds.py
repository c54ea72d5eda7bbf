"""The 15-minute feed: which files there are and where a row came from."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.dates import parse_stamp
from tidewatch.functions.text import feed_kind, feed_stamp


def feed_index(files: DataFrame, url: str = "url", kind: str = "gkg", first_year: int | None = None) -> DataFrame:
    """Stamp, kind and year of every listed feed file, for one kind and, if given, from a year on."""
    stamp = feed_stamp(url)
    index = (
        files.select(
            F.col(url),
            parse_stamp(stamp).alias("ts"),
            feed_kind(url).alias("kind"),
            F.coalesce(F.substr(stamp, F.lit(1), F.lit(4)).cast("int"), F.lit(0)).alias("year"),
        )
        .where(F.col("kind") == kind)
    )
    return index if first_year is None else index.where(F.col("year") >= first_year)


def with_source_file(df: DataFrame, name: str) -> DataFrame:
    """Add the stamp of the file each row was read from. Call it right after a read."""
    return df.withColumn(name, feed_stamp(F.col("_metadata.file_path")))


def granule_glob(path: str, start: datetime.date, end: datetime.date, ending: str) -> str:
    """One pattern for the files of the days ``[start, end)``; files of other days are not read."""
    days = [f"{start + datetime.timedelta(days=i):%Y%m%d}" for i in range((end - start).days)]
    return f"{path}/{{{','.join(days)}}}*{ending}"
