"""Joins, deduplication, counts and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.operators import aggregates, joins, metrics
from tidewatch.operators.tagging import stack_manifest
from tidewatch.plans import label_panel, spike_dataset, country_month_means
from tidewatch.schemas import CODE_OVERRIDES

# ---------------------------------------------------------------- joins


@query(
    f"""WITH {tables.ARTICLES}, {tables.EMBEDDED}
SELECT a.doc_id, a.url, CAST(year(e.date) AS INT) AS year, CAST(month(e.date) AS INT) AS month,
       strftime(e.date, '%Y%m') AS yearmonth, e.label
FROM articles a JOIN embedded e ON a.url = e.url AND CAST(a.published AS DATE) = CAST(e.date AS DATE)"""
)
def join_articles(spark: SparkSession, sf: str) -> DataFrame:
    left = tables.articles(spark, sf).withColumn("day", F.to_date("published"))
    right = tables.embedded(spark, sf).withColumn("day", F.to_date("date"))
    joined = joins.join_articles(left, right, article_url="url")
    return joined.select("doc_id", "url", "year", "month", "yearmonth", "label")


@query(
    f"""WITH {tables.PANEL}
SELECT country, month, fatalities, r_name FROM panel
LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) ON country = n_name""",
    dates=("month",),
)
def country_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = tables.table(spark, sf, "nation"), tables.table(spark, sf, "region")
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("n_name", "country")
    return joins.with_country_code(tables.panel(spark, sf), dim, "country", ["r_name"])


_MANUAL = ", ".join(f"('{name}', '{code}')" for name, code in CODE_OVERRIDES.items())


@query(
    f"""WITH listed AS (
  SELECT CASE n_nationkey WHEN 3 THEN 'Monaco' WHEN 7 THEN 'South Sudan' ELSE n_name END AS "Country",
         {tables.code_of('n_nationkey')} AS code FROM nation),
manual("Country", manual_code) AS (VALUES {_MANUAL})
SELECT "Country", coalesce(manual_code, code) AS "Fips_10" FROM listed FULL JOIN manual USING ("Country")"""
)
def country_code_overrides(spark: SparkSession, sf: str) -> DataFrame:
    """Two listed countries have a manual code; the other twelve manual ones are added."""
    name = "CASE n_nationkey WHEN 3 THEN 'Monaco' WHEN 7 THEN 'South Sudan' ELSE n_name END AS Country"
    listed = tables.table(spark, sf, "nation").selectExpr(name, f"{tables.code_of('n_nationkey')} AS Fips_10")
    return joins.apply_overrides(listed)


@query(
    f"""WITH {tables.JOINED}, {tables.LABELLED},
monthly AS (SELECT country, month, count(*) AS n_articles FROM located GROUP BY ALL)
SELECT country, month, n_articles, trend, spike FROM monthly JOIN labels_by_code USING (country, month)""",
    dates=("month",),
    flags=("spike",),
)
def label_join(spark: SparkSession, sf: str) -> DataFrame:
    monthly = tables.located(spark, sf).groupBy("country", "month").agg(F.count(F.lit(1)).alias("n_articles"))
    joined = joins.join_labels(monthly, tables.labels_by_code(spark, sf), ["country", "month"])
    return joined.select("country", "month", "n_articles", "trend", "spike")


@query(
    f"""WITH {tables.JOINED}, {tables.LABELLED}
SELECT f.country, l.month AS target_month, f.month AS feature_month, f.doc_id, l.fatalities
FROM located f JOIN labels_by_code l ON f.country = l.country
 AND f.month BETWEEN l.month - INTERVAL 4 MONTH AND l.month - INTERVAL 2 MONTH""",
    dates=("target_month", "feature_month"),
)
def lagged_window_join(spark: SparkSession, sf: str) -> DataFrame:
    features = tables.located(spark, sf).select("country", F.col("month").alias("feature_month"), "doc_id")
    labels = tables.labels_by_code(spark, sf).select("country", F.col("month").alias("target_month"), "fatalities")
    joined = joins.lagged_window_join(features, labels, "country", "feature_month", "target_month", 2, 3)
    return joined.select("country", "target_month", "feature_month", "doc_id", "fatalities")


# Two models' predictions of the spike: "trend above its level" and "more than last month".
_PREDICTIONS = (
    tables.LABELLED
    + f""",
truth AS (
  SELECT concat(strftime(month, '%Y%m'), '_', country) AS country_ym, country, month, spike,
         trend > 1 AS a_predicted, fatalities > 2 AS b_predicted
  FROM labels_by_code WHERE spike IS NOT NULL),
manifest AS (
  SELECT concat(strftime(published, '%Y%m'), '_', country) AS country_ym, count(*) AS count
  FROM by_country GROUP BY 1)"""
)


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    labels = tables.labels_by_code(spark, sf).where(F.col("spike").isNotNull())
    return labels.select(
        F.concat_ws("_", F.date_format("month", "yyyyMM"), "country").alias("country_ym"),
        "country",
        F.col("spike").alias("truth"),
        (F.col("trend") > 1).alias("a_predicted"),
        (F.col("fatalities") > 2).alias("b_predicted"),
    )


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    from tidewatch.operators.tagging import top_countries

    tagged = top_countries(tables.articles(spark, sf), "locations")
    dated = tagged.withColumn("yearmonth", F.date_format("published", "yyyyMM"))
    return stack_manifest(dated).withColumnRenamed("filename", "country_ym")


@query(
    f"""WITH {tables.EXPLODED}, {_PREDICTIONS}
SELECT country_ym, a_predicted, count FROM truth LEFT JOIN manifest USING (country_ym)""",
    counts=("count",),
)
def manifest_left_join(spark: SparkSession, sf: str) -> DataFrame:
    sized = _predictions(spark, sf).join(_manifest(spark, sf), "country_ym", "left")
    return sized.select("country_ym", "a_predicted", "count")


@query(
    f"""WITH {tables.EXPLODED}, {_PREDICTIONS}
SELECT country, count(*) AS months, CAST(sum(coalesce(count, 0)) AS BIGINT) AS articles,
       round(avg(CAST(spike = a_predicted AS INT)), 6) AS a_accuracy,
       round(avg(CAST(spike = b_predicted AS INT)), 6) AS b_accuracy
FROM truth LEFT JOIN manifest USING (country_ym) GROUP BY country"""
)
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    scored = _predictions(spark, sf)
    a = scored.select("country", "country_ym", "truth", F.col("a_predicted").alias("predicted"))
    b = scored.select("country", "country_ym", "truth", F.col("b_predicted").alias("predicted"))
    compared = metrics.compare_models(a, b, _manifest(spark, sf))
    return compared.select(
        "country",
        "months",
        "articles",
        F.round("a_accuracy", 6).alias("a_accuracy"),
        F.round("b_accuracy", 6).alias("b_accuracy"),
    )


@query(
    f"""WITH {tables.EXPLODED}, {_PREDICTIONS}
SELECT country, round(avg(CAST(spike = a_predicted AS INT)), 6) AS accuracy FROM truth GROUP BY country"""
)
def accuracy_by_country(spark: SparkSession, sf: str) -> DataFrame:
    found = aggregates.accuracy_by(_predictions(spark, sf), "country", "truth", "a_predicted")
    return found.select("country", F.round("accuracy", 6).alias("accuracy"))


@query(
    f"""WITH {tables.EXPLODED}, {tables.LABELLED}
SELECT country, strftime(month, '%Y%m') AS yearmonth FROM labels_by_code
WHERE (country, strftime(month, '%Y%m')) NOT IN (SELECT country, strftime(published, '%Y%m') FROM by_country)"""
)
def pending_months(spark: SparkSession, sf: str) -> DataFrame:
    wanted = tables.labels_by_code(spark, sf).select("country", F.date_format("month", "yyyyMM").alias("yearmonth"))
    return joins.pending(wanted, _manifest(spark, sf), ["country", "yearmonth"])


@query(
    """SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
INTERSECT SELECT source FROM documents WHERE lang = 'de'"""
)
def common_categories(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id", "lang", "source")
    toxic = docs.join(tables.table(spark, sf, "labels").where("toxic = 1"), "doc_id")
    return joins.common_categories(toxic, docs.where("lang = 'de'"), "source")


@query(
    """SELECT doc_id AS item, lang AS kind, n_chars FROM documents
UNION ALL SELECT page_id, NULL, NULL FROM pages UNION ALL SELECT event_id, event_type, NULL FROM events""",
    counts=("n_chars",),
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").selectExpr("doc_id AS item", "lang AS kind", "n_chars")
    pages = tables.table(spark, sf, "pages").selectExpr("page_id AS item")
    events = tables.table(spark, sf, "events").selectExpr("event_id AS item", "event_type AS kind")
    return joins.union_all(docs, pages, events)


@query(
    f"""WITH {tables.JOINED}
SELECT doc_id, country FROM located WHERE date >= TIMESTAMP '2020-03-01' AND date < TIMESTAMP '2020-06-01'"""
)
def lookback_rows(spark: SparkSession, sf: str) -> DataFrame:
    target = F.lit("2020-06-01").cast("date")
    return tables.located(spark, sf).where(joins.lookback("date", target, 3)).select("doc_id", "country")


@query(
    f"""WITH {tables.JOINED}, {tables.LABELLED}
SELECT f.doc_id, f.country, CAST(generate_subscripts(f.embedding, 1) - 1 AS INT) AS place,
       round(CAST(unnest(f.embedding) AS DOUBLE), 6) AS v, l.trend_increasing AS y
FROM located f JOIN labels_by_code l ON f.country = l.country AND l.month = DATE '2020-09-01'
WHERE f.country = 'AZ' AND f.date >= TIMESTAMP '2020-06-01' AND f.date < TIMESTAMP '2020-09-01'"""
)
def labelled_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = joins.labelled_sample(
        tables.located(spark, sf).drop("month"),
        tables.labels_by_code(spark, sf),
        "AZ",
        "2020-09-01",
        3,
        "trend_increasing",
    )
    parts = rows.select(
        "doc_id", "country", F.col("trend_increasing").alias("y"), F.posexplode("docembed").alias("place", "v")
    )
    return parts.withColumn("v", F.round(F.col("v").cast("double"), 6))


@query(
    f"""WITH {tables.JOINED}, {tables.LABELLED},
parts AS (
  SELECT country, strftime(date, '%Y-%m') AS embedding_window, strftime(month + INTERVAL 2 MONTH, '%Y-%m') AS target_window,
         CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS place FROM located),
means AS (
  SELECT country, embedding_window, target_window, CAST(place AS INT) AS place, count(*) AS n_articles,
         round(avg(v), 6) AS mean
  FROM parts GROUP BY ALL),
spikes AS (SELECT DISTINCT country, strftime(month, '%Y-%m') AS target_window, spike AS lagged_spike FROM labels_by_code)
SELECT country, embedding_window, target_window, n_articles, place, mean, lagged_spike,
       CASE WHEN target_window < '2020-12' THEN 'train' ELSE 'test' END AS split
FROM means JOIN spikes USING (country, target_window)""",
    flags=("lagged_spike",),
)
def mean_dataset(spark: SparkSession, sf: str) -> DataFrame:
    means = country_month_means(tables.joined_articles(spark, sf))
    made = spike_dataset(means, tables.labels_by_code(spark, sf), ["2020-12"])
    return made.select(
        "country",
        F.col("window").alias("embedding_window"),
        "target_window",
        "n_articles",
        F.posexplode("docembed").alias("place", "mean"),
        "lagged_spike",
        "split",
    ).withColumn("mean", F.round("mean", 6))


# ---------------------------------------------------------------- aggregates


@query(
    """SELECT * FROM (SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)"""
)
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    events = tables.table(spark, sf, "events")
    kept = aggregates.dedup_located(events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return kept.select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"))


@query(
    """SELECT * FROM (SELECT doc_id, lang, source, n_chars FROM documents
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id DESC) = 1)"""
)
def dedup_last(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return aggregates.dedup_located(docs, ["lang", "source"], [F.col("doc_id")], keep="last")


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "events").select("user_id", "event_type").distinct()


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS count FROM events GROUP BY 1", dates=("day",))
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = tables.table(spark, sf, "events").select(F.to_date("ts").alias("day"))
    return aggregates.value_counts(events, "day")


@query(
    """SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type,
       count(DISTINCT props) AS props FROM events"""
)
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.nunique(tables.table(spark, sf, "events"), ["user_id", "event_type", "props"])


@query(
    """WITH d AS (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'doc_id' AS "column", count(*) AS n_rows, count(*) - count(doc_id) AS nulls,
       round((count(*) - count(doc_id)) / count(*), 6) AS null_share FROM d
UNION ALL SELECT 'quality', count(*), count(*) - count(quality), round((count(*) - count(quality)) / count(*), 6) FROM d
UNION ALL SELECT 'toxic', count(*), count(*) - count(toxic), round((count(*) - count(toxic)) / count(*), 6) FROM d"""
)
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id")
    profile = aggregates.null_profile(docs.join(tables.table(spark, sf, "labels"), "doc_id", "left"))
    return profile.select("column", "n_rows", "nulls", F.round("null_share", 6).alias("null_share"))


@query(
    """SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(CAST(toxic AS VARCHAR), '') AS toxic
FROM documents LEFT JOIN labels USING (doc_id)"""
)
def fill_nulls(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id")
    joined = docs.join(tables.table(spark, sf, "labels"), "doc_id", "left")
    return joined.withColumn("toxic", F.col("toxic").cast("string")).fillna({"quality": 0, "toxic": ""})


# ---------------------------------------------------------------- scores


@query(
    """WITH c AS (
  SELECT count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS tp, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS fp,
         count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS fn, count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS tn
  FROM labels),
s AS (
  SELECT *, (tp + tn) / (tp + fp + fn + tn) AS po,
         ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS pe FROM c)
SELECT tp, fp, fn, tn, round(po, 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
       round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((po - pe) / (1 - pe), 6) AS kappa
FROM s"""
)
def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = tables.table(spark, sf, "labels").withColumn("predicted", 1 - F.col("quality"))
    scores = metrics.binary_metrics(scored, "toxic", "predicted")
    names = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "kappa"]
    return scores.select("tp", "fp", "fn", "tn", *[F.round(n, 6).alias(n) for n in names])


@query(
    """WITH d AS (SELECT quality AS y, CAST(n_chars AS DOUBLE) AS p FROM documents JOIN labels USING (doc_id)),
r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS midrank FROM d),
n AS (SELECT CAST(sum(y) AS BIGINT) AS positives, count(*) - CAST(sum(y) AS BIGINT) AS negatives,
             sum(midrank) FILTER (WHERE y = 1) AS ranks FROM r)
SELECT positives, negatives,
       round((ranks - positives * (positives + 1) / 2) / (positives * negatives), 6) AS roc_auc FROM n"""
)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id", "n_chars")
    scored = docs.join(tables.table(spark, sf, "labels"), "doc_id")
    found = metrics.roc_auc(scored, "quality", "n_chars")
    return found.select("positives", "negatives", F.round("roc_auc", 6).alias("roc_auc"))


@query(
    f"""WITH {tables.TRENDED}
SELECT country, round(avg(abs(fatalities - mean_before)), 6) AS mae FROM trended GROUP BY country"""
)
def mae_by_series(spark: SparkSession, sf: str) -> DataFrame:
    labels = label_panel(tables.panel(spark, sf))
    found = metrics.mae_by_series(labels, "country", "fatalities", "mean_before")
    return found.select("country", F.round("mae", 6).alias("mae"))


@query(
    f"""WITH {tables.TRENDED},
m AS (SELECT country, avg(abs(fatalities - mean_before)) AS mae FROM trended GROUP BY country)
SELECT round(avg(mae), 6) AS mean_mae FROM m"""
)
def mean_mae(spark: SparkSession, sf: str) -> DataFrame:
    labels = label_panel(tables.panel(spark, sf))
    found = metrics.mean_mae(labels, "country", "fatalities", "mean_before")
    return found.select(F.round("mean_mae", 6).alias("mean_mae"))
