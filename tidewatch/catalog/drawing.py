"""Samples, splits and training matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.functions.keys import hash_threshold
from tidewatch.operators import ranking, samples, sampling
from tidewatch.session import scratch_path
from tidewatch.sinks import write_samples
from tidewatch.sources import read_samples

WIDTH = 64


def key_sql(seed: int, *columns: str) -> str:
    """The hash key of `hash_key` in SQL."""
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)}))"


_QUARTER = "strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S')"


@query(
    f"""SELECT event_id, {_QUARTER} AS granule FROM events
WHERE substr({key_sql(4, _QUARTER)}, 1, 8) < '{hash_threshold(0.15)}'"""
)
def sample_granules(spark: SparkSession, sf: str) -> DataFrame:
    """A share of 15% of the quarter hours, with all their events."""
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    start = F.timestamp_seconds(seconds - seconds % 900)
    events = tables.table(spark, sf, "events").select(
        "event_id", F.date_format(start, "yyyyMMddHHmmss").alias("granule")
    )
    return sampling.sample_granules(events, "granule")


@query(
    f"""WITH ends AS (SELECT event_type, min(ts) AS a, max(ts) AS b FROM events GROUP BY event_type),
w AS (SELECT event_type, strftime(unnest(range(a, b, INTERVAL 15 MINUTE)), '%Y%m%d%H%M%S') AS stamp FROM ends)
SELECT event_type, stamp FROM w WHERE substr({key_sql(4, 'stamp')}, 1, 8) < '{hash_threshold(0.15)}'"""
)
def sample_windows(spark: SparkSession, sf: str) -> DataFrame:
    """A share of 15% of the quarter hours between the first and last event of each type."""
    from tidewatch.catalog.panels import quarter_hour_sequence

    return sampling.sample_granules(quarter_hour_sequence(spark, sf), "stamp")


@query("SELECT event_id, event_type FROM events ORDER BY value DESC, event_id LIMIT 20")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 events with the largest value."""
    events = tables.table(spark, sf, "events").orderBy(F.col("value").desc(), "event_id")
    return events.limit(20).select("event_id", "event_type")


@query(f"SELECT event_id, event_type FROM events ORDER BY {key_sql(7, 'event_id')}, event_id LIMIT 100")
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    """A uniform sample of 100 events."""
    return sampling.sample_n(tables.table(spark, sf, "events").select("event_id", "event_type"), 100, 7, ["event_id"])


@query(
    f"""SELECT * FROM (SELECT event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {key_sql(7, 'event_id')}, event_id) <= 20)"""
)
def sample_n_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """A uniform sample of 20 events of each type."""
    events = tables.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.sample_n(events, 20, 7, ["event_id"], by="event_type")


@query(
    f"""SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {key_sql(4, 'doc_id')}, doc_id) - 1 AS rank0
FROM documents"""
)
def permute_in_group(spark: SparkSession, sf: str) -> DataFrame:
    """The place of each document in a random order of its language."""
    docs = tables.table(spark, sf, "documents").select("doc_id", "lang")
    return ranking.rank_in_group(docs, ["lang"], ["doc_id"], 4)


@query(
    f"""WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY {key_sql(82, 'doc_id')}, doc_id) - 1 AS r FROM labels),
sizes AS (SELECT toxic, count(*) AS n, max(count(*)) OVER () AS most FROM labels GROUP BY toxic),
draws AS (SELECT toxic, n, unnest(range(1, most - n + 1)) AS draw FROM sizes WHERE n < most),
picks AS (SELECT toxic, draw, CAST('0x' || substr({key_sql(82, 'toxic', 'draw')}, 1, 12) AS BIGINT) % n AS pick FROM draws)
SELECT doc_id, quality, toxic, 0 AS draw FROM labels
UNION ALL SELECT r.doc_id, r.quality, r.toxic, p.draw FROM picks p JOIN ranked r ON p.toxic = r.toxic AND p.pick = r.r"""
)
def oversample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.oversample(tables.table(spark, sf, "labels"), "toxic", ["doc_id"], 82)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train'
WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'validation' ELSE 'test' END AS split FROM orders"""
)
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("m"))
    return sampling.split_by_time(orders, "m", ["1999-01", "2001-01"]).select("o_orderkey", "split")


@query("SELECT doc_id, CAST(ntile(12) OVER (ORDER BY doc_id) AS INT) AS bucket FROM documents")
def bucket_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.bucket_rows(tables.table(spark, sf, "documents").select("doc_id"), "doc_id", 12)


def _grouped_sql(source: str, month: str, n: int) -> str:
    return f"""placed AS (
  SELECT country, {month} AS target_month, url, date, embedding,
         row_number() OVER (PARTITION BY country, {month} ORDER BY {key_sql(4, 'url')}, url) - 1 AS r FROM {source}),
numbered AS (SELECT *, CAST(r // {n} AS INT) AS sample FROM placed),
grouped AS (
  SELECT country, target_month, sample, CAST(count(*) AS INT) AS n_articles,
         string_agg(url, ',' ORDER BY date, url) AS ids,
         round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 4) AS total
  FROM numbered GROUP BY country, target_month, sample HAVING count(*) = {n} OR sample = 0)"""


def _shown(made: DataFrame, *more: str) -> DataFrame:
    total = F.aggregate("embeddings", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return made.select(
        "country",
        "target_month",
        "sample",
        "n_articles",
        F.array_join("article_ids", ",").alias("ids"),
        F.round(total, 4).alias("total"),
        F.size("embeddings").alias("n_values"),
        *more,
    )


@query(
    f"""WITH {tables.JOINED}, {_grouped_sql('located', 'month', 5)}
SELECT country, target_month, sample, n_articles, ids, total, {5 * WIDTH} AS n_values FROM grouped""",
    dates=("target_month",),
)
def article_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Random groups of 5 articles per country and month."""
    rows = tables.located(spark, sf).withColumnRenamed("month", "target_month")
    return _shown(samples.article_samples(rows, ["country", "target_month"], 5, 4, WIDTH))


_LABELLED_SAMPLES = f"""WITH {tables.JOINED}, {tables.LABELLED},
pooled AS (
  SELECT f.country, l.month AS target, f.url, f.date, f.embedding FROM located f JOIN labels_by_code l
    ON f.country = l.country AND f.month BETWEEN l.month - INTERVAL 3 MONTH AND l.month - INTERVAL 2 MONTH),
{_grouped_sql('pooled', 'target', 5)}"""


@query(
    f"""{_LABELLED_SAMPLES}
SELECT g.country, target_month, sample, n_articles, ids, total, {5 * WIDTH} AS n_values,
       CAST(l.trend_increasing AS BIGINT) AS label
FROM grouped g JOIN labels_by_code l ON g.country = l.country AND target_month = l.month""",
    dates=("target_month",),
)
def labelled_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of 5 from the two months that end two before the label's."""
    made = _labelled(spark, sf)
    return _shown(made, "label")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return samples.labelled_samples(
        tables.located(spark, sf), tables.labels_by_code(spark, sf), "trend_increasing", 5, WIDTH, 4, 2, 2
    )


@query(
    f"""{_LABELLED_SAMPLES}
SELECT country, month AS target_month, concat('no sample for ', country, '_', CAST(month AS VARCHAR)) AS message
FROM labels_by_code l WHERE NOT EXISTS (SELECT 1 FROM grouped g WHERE g.country = l.country AND g.target_month = l.month)""",
    dates=("target_month",),
)
def failed_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Labels no sample could be built for."""
    wanted = tables.labels_by_code(spark, sf).select("country", F.col("month").alias("target_month"))
    return samples.failed_keys(wanted, _labelled(spark, sf), ["country", "target_month"])


@query(
    f"""WITH {tables.JOINED}, {_grouped_sql('located', 'month', 5)}
SELECT country, target_month, CAST(sample // 2 AS INT) AS stack, CAST(count(*) AS BIGINT) AS n_groups,
       round(list_sum(list(total ORDER BY sample)), 4) AS stacked,
       round(arg_max(total, sample), 4) AS last_total
FROM grouped GROUP BY country, target_month, sample // 2""",
    dates=("target_month",),
)
def stack_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups scored by the sum of their values, two to a sequence."""
    rows = tables.located(spark, sf).withColumnRenamed("month", "target_month")
    made = samples.article_samples(rows, ["country", "target_month"], 5, 4, WIDTH)
    total = F.aggregate("embeddings", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    scored = made.withColumn("vector", F.array(F.round(total, 4)))
    stacked = samples.stack_groups(scored, ["country", "target_month"], "vector", 2)
    flat = F.flatten("sequence")
    return stacked.select(
        "country",
        "target_month",
        "stack",
        "n_groups",
        F.round(F.aggregate(flat, F.lit(0.0), lambda a, x: a + x), 4).alias("stacked"),
        F.element_at(flat, -1).alias("last_total"),
    )


@query(
    f"""WITH {tables.JOINED}, {_grouped_sql('located', 'month', 5)},
flat AS (
  SELECT country, target_month, sample, n_articles,
         list_sum(CAST(embedding AS DOUBLE[])) AS s, row_number() OVER (PARTITION BY country, target_month, sample ORDER BY date, url) - 1 AS matrix_row
  FROM numbered JOIN grouped USING (country, target_month, sample)),
padded AS (SELECT country, target_month, sample, CAST(unnest(range(5)) AS INT) AS matrix_row FROM grouped)
SELECT country, target_month, sample, matrix_row, round(coalesce(s, 0), 5) AS row_sum
FROM padded LEFT JOIN flat USING (country, target_month, sample, matrix_row)""",
    dates=("target_month",),
)
def samples_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """Write samples in files of at most 50 and read them as matrices."""
    rows = tables.located(spark, sf).withColumnRenamed("month", "target_month")
    path = scratch_path(spark, "samples")
    write_samples(samples.article_samples(rows, ["country", "target_month"], 5, 4, WIDTH), path, 50)
    read = read_samples(spark, path).select(
        "country", "target_month", "sample", F.posexplode("matrix").alias("matrix_row", "r")
    )
    total = F.aggregate("r", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return read.select("country", "target_month", "sample", "matrix_row", F.round(total, 5).alias("row_sum"))
