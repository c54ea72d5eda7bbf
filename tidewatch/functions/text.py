"""Text extraction expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a country-level block of a locations string is recognised.
# ``(?U)`` makes \w match letters of every script.
ONE_WORD_COUNTRY = r"(?U)1#\w+#(\w{2})#"
ANY_NAME_COUNTRY = r"(?U)(?:^|;)1#[^#]+#(\w{2})#"

# The stamp in a file's own name, or in its folder's when a job wrote part files there.
FEED_STAMP = r"(\d{14})[^/]*(?:/part-[^/]*)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_codes(locations: Column | str, names: str = "one_word") -> Column:
    """Every two-letter code of the country-level blocks, in text order.

    ``names="one_word"`` needs a country name without spaces; ``names="any"``
    anchors the match at a block start and accepts any name.
    """
    patterns = {"one_word": ONE_WORD_COUNTRY, "any": ANY_NAME_COUNTRY}
    if names not in patterns:
        raise ValueError(f"names must be one of {sorted(patterns)}")
    return F.regexp_extract_all(_col(locations), F.lit(patterns[names]), F.lit(1))


def feed_stamp(name: Column | str) -> Column:
    """The 14-digit stamp of a feed file's name, path or address, null when absent."""
    return F.nullif(F.regexp_extract(_col(name), FEED_STAMP, 1), F.lit(""))


def feed_kind(url: Column | str) -> Column:
    """The three characters in front of an eight-character ending such as ``.csv.zip``."""
    url = _col(url)
    return F.when(F.length(url) >= 11, F.substr(url, F.lit(-11), F.lit(3)))


def without_undecodable(c: Column | str) -> Column:
    """Drop the bytes that are not UTF-8 and keep the rest of the text."""
    c = _col(c)
    repaired = F.replace(F.make_valid_utf8(c), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(c), c).otherwise(repaired)
