"""Monthly panels, labels and calendar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.functions import dates
from tidewatch.operators import aggregates, panel
from tidewatch.plans import label_panel
from tidewatch.session import scratch_path
from tidewatch.sinks import write_csv
from tidewatch.sources import read_conflict


def _round(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


@query(f"WITH {tables.SPIKED} SELECT country, month, fatalities, trend, spike_level, spike FROM spiked",
    dates=("month",), flags=("spike",),
)
def spike_labels(spark: SparkSession, sf: str) -> DataFrame:
    labels = label_panel(tables.panel(spark, sf))
    return labels.select("country", "month", "fatalities", "trend", "spike_level", "spike")


@query(
    f"WITH {tables.SPIKED} SELECT country, month, trend, spike_level, trend >= spike_level AS spike FROM spiked",
    dates=("month",), flags=("spike",),
)
def spike_labels_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    labels = label_panel(tables.panel(spark, sf), strict=False)
    return labels.select("country", "month", "trend", "spike_level", "spike")


@query(
    f"""WITH {tables.TRENDED}
SELECT country, month, fatalities, last_month, round(mean_before, 6) AS mean_before,
       round(std_before, 6) AS std_before, trend, round(atan(trend), 6) AS theta,
       round(fatalities - mean_before, 6) AS deviation, fatalities > 0 AS any_event,
       coalesce(fatalities > last_month, false) AS more_than_last,
       coalesce(fatalities > mean_before, false) AS more_than_mean,
       coalesce(fatalities - mean_before > std_before, false) AS outside_std, trend > 0 AS trend_increasing
FROM trended""",
    dates=("month",), counts=("last_month",),
)
def trend_features(spark: SparkSession, sf: str) -> DataFrame:
    made = panel.trend_features(tables.panel(spark, sf))
    return made.select(
        "country",
        "month",
        "fatalities",
        "last_month",
        *_round("mean_before", "std_before"),
        "trend",
        *_round("theta", "deviation"),
        "any_event",
        "more_than_last",
        "more_than_mean",
        "outside_std",
        "trend_increasing",
    )


FILLED = (
    tables.PANEL
    + """,
calendar AS (
  SELECT country, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM panel GROUP BY country),
filled AS (
  SELECT country, month, coalesce(fatalities, 0) AS fatalities FROM calendar LEFT JOIN panel USING (country, month))"""
)


@query(f"WITH {FILLED} SELECT country, month, fatalities FROM filled",
    dates=("month",),
)
def fill_month_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return panel.fill_months(tables.panel(spark, sf), "country", "month", ["fatalities"])


@query(f"WITH {FILLED} SELECT country, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, fatalities FROM filled",
    dates=("month",),
)
def shift_series(spark: SparkSession, sf: str) -> DataFrame:
    filled = panel.fill_months(tables.panel(spark, sf), "country", "month", ["fatalities"])
    return panel.shift_months(filled, "month", 1)


@query(
    f"""WITH {FILLED}
SELECT country, month, fatalities, lag(fatalities, 1) OVER w AS fatalities_lag1,
       lag(fatalities, 2) OVER w AS fatalities_lag2, lag(fatalities, 3) OVER w AS fatalities_lag3
FROM filled WINDOW w AS (PARTITION BY country ORDER BY month)""",
    dates=("month",), counts=("fatalities_lag1", "fatalities_lag2", "fatalities_lag3"),
)
def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    filled = panel.fill_months(tables.panel(spark, sf), "country", "month", ["fatalities"])
    return panel.lag_features(filled, "country", "month", ["fatalities"], 3)


@query(
    f"""WITH {FILLED}
SELECT country, month, fatalities,
       row_number() OVER (PARTITION BY country ORDER BY month DESC) <= 6 AS held_out FROM filled""",
    dates=("month",),
)
def holdout_last6(spark: SparkSession, sf: str) -> DataFrame:
    filled = panel.fill_months(tables.panel(spark, sf), "country", "month", ["fatalities"])
    return panel.split_last(filled, "country", "month", 6)


@query(
    f"""WITH {tables.SPIKED}, indexed AS (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY month) - 1 AS i FROM spiked)
SELECT country, month, CAST(i - 0.5 AS DOUBLE) AS range_start, CAST(i + 0.5 AS DOUBLE) AS range_end
FROM indexed WHERE spike""",
    dates=("month",),
)
def spike_ranges(spark: SparkSession, sf: str) -> DataFrame:
    found = panel.spike_ranges(label_panel(tables.panel(spark, sf)), "country", "month")
    return found.select(
        "country", "month", F.col("range_start").cast("double"), F.col("range_end").cast("double")
    )


@query(
    f"""WITH {tables.SPIKED}
SELECT country, CAST(coalesce(max(CAST(spike AS INT)), 0) AS INT) AS any_conflict FROM spiked GROUP BY country"""
)
def any_conflict(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.any_conflict(label_panel(tables.panel(spark, sf)))


@query(
    f"""WITH {tables.PANEL}
SELECT country, count(*) AS n_months, count(*) FILTER (WHERE fatalities > 0) AS with_fatalities
FROM panel GROUP BY country"""
)
def count_true(spark: SparkSession, sf: str) -> DataFrame:
    return (
        tables.panel(spark, sf)
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("n_months"), F.count_if(F.col("fatalities") > 0).alias("with_fatalities"))
    )


@query(
    """SELECT o_custkey, o_orderkey FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 10)"""
)
def min_support(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return aggregates.min_support(orders, "o_custkey", 10)


@query(
    f"""WITH {tables.PANEL}
SELECT country AS "Country", monthname(month) AS "Month", CAST(year(month) AS INT) AS "Year",
       fatalities AS "Fatalities", CAST(month(month) AS INT) AS month_num,
       CAST(quarter(month) AS INT) AS quarter, month AS date FROM panel""",
    dates=("date",),
)
def conflict_counts_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Write the panel the way the counts arrive, with English month names, and read it."""
    path = scratch_path(spark, "conflict")
    raw = tables.panel(spark, sf).select(
        F.col("country").alias("Country"),
        F.date_format("month", "MMMM").alias("Month"),
        F.year("month").alias("Year"),
        F.col("fatalities").alias("Fatalities"),
    )
    write_csv(raw, path)
    return read_conflict(spark, path)


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS yearmonth, strftime(o_orderdate, '%Y-%m') AS window_key,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(o_orderdate AS DATE) AS day,
       CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       CAST(quarter(o_orderdate) AS INT) AS quarter,
       concat(strftime(o_orderdate, '%Y-%m'), '-01') AS window_day,
       lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS padded_month
FROM orders""",
    dates=("month_start", "day"),
)
def month_keys(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("o_orderdate")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey",
        dates.yearmonth(ts).alias("yearmonth"),
        dates.window_key(ts).alias("window_key"),
        dates.month_start(ts).alias("month_start"),
        dates.day(ts).alias("day"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        dates.quarter_number(F.month(ts)).alias("quarter"),
        F.concat(dates.window_key(ts), F.lit("-01")).alias("window_day"),
        F.lpad(F.month(ts).cast("string"), 2, "0").alias("padded_month"),
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 2 MONTH, '%Y-%m') AS target_window,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 3 MONTH, '%Y%m') AS earlier
FROM orders"""
)
def add_months_rollover(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("o_orderdate")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey",
        dates.shift_key(dates.window_key(ts), 2).alias("target_window"),
        dates.shift_key(dates.yearmonth(ts), -3, "yyyyMM").alias("earlier"),
    )


# Stamps as text, those of `error` events spoiled on purpose.
_STAMPS = """stamps AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a date' ELSE strftime(ts, '%Y%m%d%H%M%S') END AS stamp,
         CASE WHEN event_type = 'error' THEN '2024-99-99' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS iso
  FROM events)"""


@query(
    f"""WITH {_STAMPS}
SELECT event_id, CAST(try_strptime(stamp, '%Y%m%d%H%M%S') AS TIMESTAMP) AS from_stamp,
       CAST(try_strptime(iso, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS from_iso FROM stamps""",
    stamps=("from_stamp", "from_iso"),
)
def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.col("event_type") == "error"
    stamps = tables.table(spark, sf, "events").select(
        "event_id",
        F.when(bad, "not a date").otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("stamp"),
        F.when(bad, "2024-99-99").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso"),
    )
    return stamps.select(
        "event_id", dates.parse_stamp("stamp").alias("from_stamp"), dates.parse_iso("iso").alias("from_iso")
    )


@query(
    """SELECT o_orderpriority, CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
       date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month
FROM orders GROUP BY o_orderpriority""",
    dates=("month",),
)
def month_sequence(spark: SparkSession, sf: str) -> DataFrame:
    ends = tables.table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return ends.select("o_orderpriority", F.explode(dates.month_range("first", "last")).alias("month"))


@query(
    """SELECT event_type, strftime(unnest(range(min(ts), max(ts), INTERVAL 15 MINUTE)), '%Y%m%d%H%M%S') AS stamp
FROM events GROUP BY event_type"""
)
def quarter_hour_sequence(spark: SparkSession, sf: str) -> DataFrame:
    ends = tables.table(spark, sf, "events").groupBy("event_type").agg(
        F.min("ts").cast("timestamp").alias("first"), F.max("ts").cast("timestamp").alias("last")
    )
    return ends.select(
        "event_type",
        F.explode(
            F.transform(dates.quarter_hours("first", "last"), lambda t: F.date_format(t, "yyyyMMddHHmmss"))
        ).alias("stamp"),
    )


@query(
    f"""WITH {tables.ARTICLES}, {tables.EMBEDDED}
SELECT doc_id, date - published > INTERVAL 5 MINUTE AS late FROM articles JOIN embedded USING (url)"""
)
def timestamp_gap(spark: SparkSession, sf: str) -> DataFrame:
    both = tables.articles(spark, sf).join(tables.embedded(spark, sf), "url")
    return both.select("doc_id", dates.gap_exceeds("date", "published", 5).alias("late"))


@query(
    """SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands,
       CAST(ceil(month(o_orderdate) / 3.0) AS BIGINT) AS quarter, round(atan(o_totalprice - 250000), 6) AS angle,
       round(abs(o_totalprice - 250000), 6) AS distance FROM orders"""
)
def numeric_functions(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey",
        F.floor(price / 1000).alias("thousands"),
        F.ceil(F.month("o_orderdate") / 3).alias("quarter"),
        F.round(F.atan(price - 250000), 6).alias("angle"),
        F.round(F.abs(price - 250000), 6).alias("distance"),
    )
