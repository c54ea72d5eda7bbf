"""Operators on a panel: one row per (key, month).

A key's rows are bounded by the calendar (a century is 1,200 rows), so the
windows below partition by key alone. `monthly_panel` is what makes that true:
it reduces raw rows of any skew to one row per key and month, with partial sums
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import dates


def monthly_panel(df: DataFrame, key: str, date: str, value: Column, name: str = "fatalities") -> DataFrame:
    """Aggregate raw rows to one row per key and month, month as its first day."""
    return (
        df.select(F.col(key), F.trunc(F.col(date), "MM").alias("month"), value.alias(name))
        .groupBy(key, "month")
        .agg(F.sum(name).alias(name))
    )


def _frame(key: str, month: str, first: int, last: int) -> str:
    """Calendar frame from ``first`` months back to ``last`` months back.

    Month steps can be stated in the SQL text of OVER only, hence text here.
    """

    def bound(back: int) -> str:
        return "CURRENT ROW" if back == 0 else f"INTERVAL {back} MONTHS PRECEDING"

    return f"OVER (PARTITION BY `{key}` ORDER BY `{month}` RANGE BETWEEN {bound(first)} AND {bound(last)})"


def slope(values: Column) -> Column:
    """Least-squares slope over positions 0..k-1: sum((i - mean(i)) * y) / sum((i - mean(i))^2).

    0 for a single value. The doubled deviations 2i - (k - 1) keep the weights
    integral, so small integer inputs give the exact slope.
    """
    k = F.size(values)
    weighted = F.aggregate(
        F.transform(values, lambda y, i: y.cast("double") * (i * 2 - (k - 1))),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    # sum((2i - (k-1))^2) = k (k^2 - 1) / 3
    spread = (k * (k * k - 1) / F.lit(3)).cast("double")
    return F.when(k > 1, F.lit(2.0) * weighted / spread).otherwise(F.lit(0.0))


def trend_features(
    panel: DataFrame, key: str = "country", month: str = "month", y: str = "fatalities", n: int = 3
) -> DataFrame:
    """Trailing-window features of ``y``: the ``n`` months before, and the current one for the trend."""
    before = _frame(key, month, n, 1)
    window = _frame(key, month, n, 0)
    with_frames = panel.selectExpr(
        "*",
        f"last(`{y}`) {before} AS last_month",
        f"avg(`{y}`) {before} AS mean_before",
        f"stddev_samp(`{y}`) {before} AS std_before",
        f"collect_list(`{y}`) {window} AS _recent",
    )
    # The last n rows of the window; slice(a, -n, n) would be empty for a shorter one.
    size = F.size("_recent")
    recent = F.slice(F.col("_recent"), F.greatest(size - n + 1, F.lit(1)), F.lit(n))
    trended = with_frames.withColumn("trend", slope(recent)).drop("_recent")
    value = F.col(y)
    return trended.select(
        "*",
        F.atan("trend").alias("theta"),
        (value - F.col("mean_before")).alias("deviation"),
        (value > 0).alias("any_event"),
        F.coalesce(value > F.col("last_month"), F.lit(False)).alias("more_than_last"),
        F.coalesce(value > F.col("mean_before"), F.lit(False)).alias("more_than_mean"),
        F.coalesce((value - F.col("mean_before")) > F.col("std_before"), F.lit(False)).alias("outside_std"),
        (F.col("trend") > 0).alias("trend_increasing"),
    )


def spike(
    panel: DataFrame,
    key: str = "country",
    month: str = "month",
    trend: str = "trend",
    q: float = 0.75,
    months: int = 24,
    strict: bool = True,
) -> DataFrame:
    """Mark months whose trend is above the ``q`` quantile of the key's previous ``months``.

    Null where there is no earlier month. ``strict=False`` also counts a tie.
    """
    history = _frame(key, month, months, 1)
    with_level = panel.selectExpr("*", f"percentile(`{trend}`, {float(q)}D) {history} AS spike_level")
    above = F.col(trend) > F.col("spike_level") if strict else F.col(trend) >= F.col("spike_level")
    return with_level.withColumn("spike", above)


def fill_months(panel: DataFrame, key: str, month: str, values: list[str], fill: float = 0) -> DataFrame:
    """Add the months missing between a key's first and last month, values set to ``fill``.

    Each row fills the gap up to the next one, so no second pass or join is
    needed: the months after a row up to the next row are generated in place.
    """
    following = F.lead(month).over(Window.partitionBy(key).orderBy(month))
    last = F.coalesce(F.add_months("_following", -1), F.col(month))
    spread = panel.withColumn("_following", following).withColumn(
        "_m", F.explode(F.sequence(F.col(month), last, F.expr("interval 1 month")))
    )
    filled = [
        F.when(F.col("_m") == F.col(month), F.coalesce(F.col(v), F.lit(fill))).otherwise(F.lit(fill))
        .cast(panel.schema[v].dataType)
        .alias(v)
        for v in values
    ]
    return spread.select(key, F.col("_m").alias(month), *filled)


def shift_months(panel: DataFrame, month: str, k: int) -> DataFrame:
    """Move a series along the calendar by ``k`` months."""
    return panel.withColumn(month, F.add_months(month, k))


def lag_features(panel: DataFrame, key: str, month: str, columns: list[str], lags: int = 3) -> DataFrame:
    """``column_lag1`` .. ``column_lagN`` for every column, one window sort for all."""
    w = Window.partitionBy(key).orderBy(month)
    made = [F.lag(c, i).over(w).alias(f"{c}_lag{i}") for c in columns for i in range(1, lags + 1)]
    return panel.select("*", *made)


def split_last(panel: DataFrame, key: str, month: str, k: int = 6) -> DataFrame:
    """``held_out`` is true for the last ``k`` rows of each series."""
    w = Window.partitionBy(key).orderBy(F.col(month).desc())
    return panel.withColumn("held_out", F.row_number().over(w) <= k)


def spike_ranges(panel: DataFrame, key: str, month: str, flag: str = "spike") -> DataFrame:
    """Display range (index - 0.5, index + 0.5) of every flagged row, index 0-based in its series."""
    w = Window.partitionBy(key).orderBy(month)
    indexed = panel.withColumn("_i", F.row_number().over(w) - 1).where(F.col(flag))
    return indexed.select(
        key, month, (F.col("_i") - 0.5).alias("range_start"), (F.col("_i") + 0.5).alias("range_end")
    )


def conflict_months(raw: DataFrame) -> DataFrame:
    """Month number, quarter and first-of-month date for rows with an English month name."""
    number = dates.month_number("Month")
    return raw.select(
        "*",
        number.alias("month_num"),
        dates.quarter_number(number).alias("quarter"),
        dates.month_date("Month", "Year").alias("date"),
    )
