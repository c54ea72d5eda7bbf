"""Hash keys: reproducible draws and schema fingerprints.

A draw that depends on ``rand()`` changes when a lost executor makes Spark
recompute a task. Every draw here is a pure function of a seed and an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_key(seed: int, *columns: Column | str) -> Column:
    """32 hexadecimal digits, uniform, from a seed and the id columns."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_fraction(key: Column) -> Column:
    """The key's first 32 bits as a number in [0, 2**32)."""
    return F.conv(F.substr(key, F.lit(1), F.lit(8)), 16, 10).cast("bigint")


def hash_index(key: Column, size: Column) -> Column:
    """The key's first 48 bits modulo ``size``: a 0-based place in a list."""
    return F.pmod(F.conv(F.substr(key, F.lit(1), F.lit(12)), 16, 10).cast("bigint"), size)


def hash_threshold(p: float) -> str:
    """Hexadecimal bound that a share ``p`` of all keys falls below."""
    return format(min(int(round(p * 16**8)), 16**8), "08x")


def chosen(key: Column, p: float) -> Column:
    """True for a share ``p`` of all keys."""
    if p >= 1:
        return F.lit(True)
    return F.substr(key, F.lit(1), F.lit(8)) < F.lit(hash_threshold(p))


def schema_key(columns: list[str] | DataFrame) -> Column:
    """First six digits of the md5 of all column names run together."""
    names = columns.columns if isinstance(columns, DataFrame) else columns
    return F.substr(F.md5(F.lit("".join(names))), F.lit(1), F.lit(6))
