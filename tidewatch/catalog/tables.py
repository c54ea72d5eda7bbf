"""The given tables, and the inputs derived from them.

Each derived input is written twice: as a DataFrame and as the same SQL text
for the check, so that both sides start from the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.joins import join_articles, with_country_code
from tidewatch.operators.panel import monthly_panel, shift_months
from tidewatch.operators.tagging import explode_countries, top_countries
from tidewatch.plans import label_panel


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(
    spark: SparkSession, sf_dir: str, priority: str = "1-URGENT", name: str = "fatalities"
) -> DataFrame:
    """Monthly counts per country: urgent orders stand for fatalities."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    located = placed.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counted = (F.col("o_orderpriority") == priority).cast("long")
    return monthly_panel(located, "country", "o_orderdate", counted, name)


PANEL = """panel AS (
  SELECT n_name AS country, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS fatalities
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""

TRENDED = (
    PANEL
    + """,
recent AS (
  SELECT *, list(fatalities) OVER (PARTITION BY country ORDER BY month
            RANGE BETWEEN INTERVAL 3 MONTHS PRECEDING AND CURRENT ROW) AS l,
         last_value(fatalities) OVER b AS last_month, avg(fatalities) OVER b AS mean_before,
         CASE WHEN count(*) OVER b > 1 THEN stddev_samp(fatalities) OVER b END AS std_before
  FROM panel
  WINDOW b AS (PARTITION BY country ORDER BY month
               RANGE BETWEEN INTERVAL 3 MONTHS PRECEDING AND INTERVAL 1 MONTH PRECEDING)),
sliced AS (SELECT * EXCLUDE (l), l[greatest(len(l) - 2, 1):len(l)] AS s FROM recent),
trended AS (
  SELECT * EXCLUDE (s), CASE len(s) WHEN 1 THEN 0.0::DOUBLE WHEN 2 THEN (s[2] - s[1])::DOUBLE
         ELSE (s[3] - s[1]) / 2.0::DOUBLE END AS trend FROM sliced)"""
)

SPIKED = (
    TRENDED
    + """,
levelled AS (
  SELECT *, quantile_cont(trend, 0.75) OVER (PARTITION BY country ORDER BY month
            RANGE BETWEEN INTERVAL 24 MONTHS PRECEDING AND INTERVAL 1 MONTH PRECEDING) AS spike_level
  FROM trended),
spiked AS (SELECT *, trend > spike_level AS spike FROM levelled)"""
)

# A country index per document and block: a third of all blocks name country 0,
# so every query below meets one hot key. Names have one word, one word with a
# non-ASCII letter, or two words.
_IDX = "(CASE WHEN ({id} + i) % 3 = 0 THEN 0 ELSE ({id} * 7 + i * 11) % 25 END)"


def code_of(idx: str) -> str:
    return f"concat(chr(CAST(65 + {idx} AS INT)), chr(CAST(90 - {idx} AS INT)))"


def _block(doc: str) -> str:
    idx = _IDX.format(id=doc)
    code = code_of(idx)
    name = (
        f"CASE {idx} % 5 WHEN 4 THEN concat('Old Land ', {idx}) "
        f"WHEN 1 THEN concat('Türk', {idx}) ELSE concat('Land', {idx}) END"
    )
    kind = f"CASE WHEN ({doc} + i) % 4 = 3 THEN '2' ELSE '1' END"
    return f"concat({kind}, '#', {name}, '#', {code}, '#', {code}, '##', {idx}, '#', 10 + {idx}, '#', {code}, '#', 100 + i)"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article metadata derived from `documents`: record id, address, stamp, locations text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    blocks = "transform(sequence(1, CAST(doc_id % 6 AS INT)), i -> " + _block("doc_id") + ")"
    return docs.selectExpr(
        "doc_id",
        "concat('rec-', doc_id) AS record_id",
        "concat('https://news.example/', doc_id) AS url",
        "timestampadd(MINUTE, 15 * ((doc_id * 97) % 35136), TIMESTAMP '2020-01-01 00:00:00') AS published",
        "lang",
        "source",
        "n_chars",
        f"CASE WHEN doc_id % 6 > 0 THEN array_join({blocks}, ';') END AS locations",
    )


ARTICLES = f"""articles AS (
  SELECT doc_id, concat('rec-', doc_id) AS record_id, concat('https://news.example/', doc_id) AS url,
         TIMESTAMP '2020-01-01 00:00:00' + to_minutes(15 * ((doc_id * 97) % 35136)) AS published,
         lang, source, n_chars,
         CASE WHEN doc_id % 6 > 0 THEN
           array_to_string(list_transform(range(1, doc_id % 6 + 1), lambda i: {_block('doc_id')}), ';') END AS locations
  FROM documents)"""


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article embeddings derived from `embeddings`; those of one label are dated a day late."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "concat('https://news.example/', vec_id) AS url",
        "timestampadd(MINUTE, 15 * ((vec_id * 97) % 35136) + CASE WHEN label = 0 THEN 1440 ELSE 0 END,"
        " TIMESTAMP '2020-01-01 00:00:00') AS date",
        "embedding",
        "label",
    )


EMBEDDED = """embedded AS (
  SELECT vec_id, concat('https://news.example/', vec_id) AS url,
         TIMESTAMP '2020-01-01 00:00:00'
           + to_minutes(15 * ((vec_id * 97) % 35136) + CASE WHEN label = 0 THEN 1440 ELSE 0 END) AS date,
         embedding, label
  FROM embeddings)"""

# First three distinct codes in text order.
TAGGED = (
    ARTICLES
    + r""",
coded AS (SELECT *, coalesce(regexp_extract_all(locations, '1#[\pL\pN_]+#([\pL\pN_]{2})#', 1), []) AS codes FROM articles),
tagged AS (
  SELECT * EXCLUDE (tops), tops[1] AS "country-1", tops[2] AS "country-2", tops[3] AS "country-3"
  FROM (SELECT *, list_filter(codes, lambda x, i: list_position(codes, x) = i) AS tops FROM coded))"""
)

EXPLODED = (
    TAGGED
    + """,
by_country AS (
  SELECT doc_id, url, published, lang, source, n_chars, k AS country_idx, country
  FROM tagged, LATERAL (VALUES (1, "country-1"), (2, "country-2"), (3, "country-3")) AS v(k, country)
  WHERE country IS NOT NULL)"""
)

# Articles joined with their embedding of the same day, one row per country.
JOINED = (
    EXPLODED
    + ",\n"
    + EMBEDDED
    + """,
located AS (
  SELECT b.doc_id, b.url, b.lang, b.country, e.date, e.embedding, e.label,
         CAST(date_trunc('month', e.date) AS DATE) AS month
  FROM by_country b JOIN embedded e ON b.url = e.url AND CAST(b.published AS DATE) = CAST(e.date AS DATE))"""
)


def joined_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged articles with their same-day embedding, still one row per article."""
    tagged = top_countries(articles(spark, sf_dir), "locations").withColumn("day", F.to_date("published"))
    vectors = embedded(spark, sf_dir).withColumn("day", F.to_date("date")).withColumnRenamed("embedding", "docembed")
    return join_articles(tagged, vectors, article_url="url").drop("month")


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_countries(joined_articles(spark, sf_dir))
    return rows.withColumn("month", F.trunc("date", "MM"))


# The panel's labels, moved 20 years on to meet the article dates, keyed by country code.
LABELLED = (
    SPIKED
    + f""",
labels_by_code AS (
  SELECT {code_of('n_nationkey')} AS country, CAST(month + INTERVAL 240 MONTH AS DATE) AS month,
         fatalities, trend, spike, trend > 0 AS trend_increasing
  FROM spiked JOIN nation ON country = n_name)"""
)


def labels_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "nation").selectExpr("n_name AS country", f"{code_of('n_nationkey')} AS code")
    coded = with_country_code(label_panel(panel(spark, sf_dir)), codes, "country", ["code"])
    moved = shift_months(coded, "month", 240)
    return moved.select(
        F.col("code").alias("country"), "month", "fatalities", "trend", "spike", "trend_increasing"
    )
