"""Date and month-key expressions. All take and return columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.schemas import MONTH_NAMES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_stamp(c: Column | str) -> Column:
    """14-digit ``yyyyMMddHHmmss`` text or integer to timestamp, null when malformed."""
    return F.try_to_timestamp(_col(c).cast("string"), F.lit("yyyyMMddHHmmss"))


def parse_iso(c: Column | str) -> Column:
    """``2020-01-01T00:00:00Z`` text to timestamp, null when malformed."""
    return F.try_to_timestamp(_col(c), F.lit("yyyy-MM-dd'T'HH:mm:ssX"))


def yearmonth(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMM")


def window_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "MM")


def day(c: Column | str) -> Column:
    return F.to_date(_col(c))


def month_number(name: Column | str) -> Column:
    """English month name to 1..12, null for anything else."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return F.nullif(F.array_position(names, _col(name)), F.lit(0)).cast("int")


def quarter_number(month: Column | str) -> Column:
    return F.ceil(_col(month) / F.lit(3)).cast("int")


def month_date(name: Column | str, year: Column | str) -> Column:
    """Month name and year to the first of that month."""
    return F.make_date(_col(year), month_number(name), F.lit(1))


def key_to_month(key: Column | str) -> Column:
    """``YYYY-MM`` or ``YYYYMM`` to the first of that month, null when malformed."""
    digits = F.replace(_col(key), F.lit("-"), F.lit(""))
    return F.to_date(F.try_to_timestamp(F.concat(digits, F.lit("01")), F.lit("yyyyMMdd")))


def shift_key(key: Column | str, months: int, pattern: str = "yyyy-MM") -> Column:
    """Move a month key by whole months, rolling over years."""
    return F.date_format(F.add_months(key_to_month(key), months), pattern)


def quarter_hours(start: Column | str, end: Column | str, minutes: int = 15) -> Column:
    """Every ``minutes`` from ``start`` on, up to but without ``end``."""
    start, end = _col(start), _col(end)
    step = F.expr(f"interval {int(minutes)} minutes")
    last = end - F.expr("interval 1 microsecond")
    empty = F.array().cast("array<timestamp>")
    return F.when(start < end, F.sequence(start, last, step)).otherwise(empty)


def month_range(first: Column | str, last: Column | str) -> Column:
    """First of every month from ``first`` to ``last``, both included."""
    first, last = month_start(first), month_start(last)
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def gap_exceeds(later: Column | str, earlier: Column | str, minutes: int = 5) -> Column:
    return (_col(later) - _col(earlier)) > F.expr(f"interval {int(minutes)} minutes")
