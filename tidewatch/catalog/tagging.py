"""Locations text, countries, feed names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.functions import arrays, keys
from tidewatch.operators import tagging
from tidewatch.sources import feed_index as index_feed


def _tagged(spark: SparkSession, sf: str, **options) -> DataFrame:
    return tagging.top_countries(tables.articles(spark, sf), "locations", **options)


@query(
    f"""WITH {tables.TAGGED}
SELECT doc_id, CAST(generate_subscripts(codes, 1) - 1 AS INT) AS place, unnest(codes) AS code FROM coded"""
)
def extract_codes(spark: SparkSession, sf: str) -> DataFrame:
    found = tagging.extract_countries(tables.articles(spark, sf), "locations")
    return found.select("doc_id", F.posexplode("countries").alias("place", "code"))


@query(
    rf"""WITH {tables.ARTICLES}
SELECT doc_id, unnest(regexp_extract_all(locations, '(?:^|;)1#[^#]+#([\pL\pN_]{{2}})#', 1)) AS code FROM articles"""
)
def extract_codes_any_name(spark: SparkSession, sf: str) -> DataFrame:
    found = tagging.extract_countries(tables.articles(spark, sf), "locations", names="any")
    return found.select("doc_id", F.explode("countries").alias("code"))


@query(
    f"""WITH {tables.TAGGED}
SELECT doc_id, "country-1", "country-2", "country-3", CAST(len(list_distinct(codes)) AS INT) AS num_countries
FROM tagged"""
)
def top_codes(spark: SparkSession, sf: str) -> DataFrame:
    found = _tagged(spark, sf, with_list=True)
    return found.select("doc_id", "`country-1`", "`country-2`", "`country-3`", "num_countries")


@query(f"WITH {tables.TAGGED} SELECT doc_id, codes[2] AS second_code FROM tagged")
def nth_code(spark: SparkSession, sf: str) -> DataFrame:
    found = tagging.extract_countries(tables.articles(spark, sf), "locations")
    return found.select("doc_id", arrays.item("countries", 1).alias("second_code"))


@query(f"WITH {tables.EXPLODED} SELECT doc_id, country_idx, country FROM by_country")
def explode_codes(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.explode_countries(_tagged(spark, sf)).select("doc_id", "country_idx", "country")


@query(
    f"""WITH {tables.TAGGED}
SELECT doc_id, lang FROM tagged WHERE 'AZ' IN ("country-1", "country-2", "country-3")"""
)
def membership_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf).where(tagging.mentions("AZ")).select("doc_id", "lang")


@query(f"""WITH {tables.TAGGED} SELECT doc_id, lang FROM tagged WHERE "country-1" = 'AZ' AND lang IN ('en', 'fr')""")
def first_country_filter(spark: SparkSession, sf: str) -> DataFrame:
    found = _tagged(spark, sf)
    return found.where((F.col("`country-1`") == "AZ") & F.col("lang").isin("en", "fr")).select("doc_id", "lang")


@query(f"""WITH {tables.TAGGED} SELECT doc_id, "country-1" FROM tagged WHERE "country-1" IS NOT NULL""")
def drop_unlocated(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.drop_unlocated(_tagged(spark, sf)).select("doc_id", "`country-1`")


@query(f"WITH {tables.EXPLODED} SELECT DISTINCT country FROM by_country")
def seen_values(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.seen_countries(_tagged(spark, sf))


@query(
    f"""WITH {tables.EXPLODED}
SELECT concat(strftime(published, '%Y%m'), '_', country) AS filename, strftime(published, '%Y%m') AS yearmonth,
       country, count(*) AS count
FROM by_country GROUP BY ALL"""
)
def stack_manifest(spark: SparkSession, sf: str) -> DataFrame:
    dated = _tagged(spark, sf).withColumn("yearmonth", F.date_format("published", "yyyyMM"))
    return tagging.stack_manifest(dated)


_FILES = """files AS (
  SELECT event_id, concat('http://feed.example/v2/', strftime(ts, '%Y%m%d%H%M%S'),
         CASE event_type WHEN 'view' THEN '.gkg.csv.zip' WHEN 'click' THEN '.mentions.CSV.zip'
         WHEN 'error' THEN '.gkg.csv.zip' ELSE '.export.CSV.zip' END) AS url FROM events)"""


@query(
    rf"""WITH {_FILES}
SELECT url, strptime(regexp_extract(url, '(\d{{14}})', 1), '%Y%m%d%H%M%S') AS ts, substr(url, -11, 3) AS kind,
       CAST(substr(regexp_extract(url, '(\d{{14}})', 1), 1, 4) AS INT) AS year
FROM files WHERE substr(url, -11, 3) = 'gkg'""",
    stamps=("ts",),
)
def feed_index(spark: SparkSession, sf: str) -> DataFrame:
    ending = (
        F.when(F.col("event_type").isin("view", "error"), ".gkg.csv.zip")
        .when(F.col("event_type") == "click", ".mentions.CSV.zip")
        .otherwise(".export.CSV.zip")
    )
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    files = tables.table(spark, sf, "events").select(
        F.concat(F.lit("http://feed.example/v2/"), stamp, ending).alias("url")
    )
    return index_feed(files, first_year=2020)


@query(
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, split_part(url, '/', 4) AS section,
       len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS n_links FROM pages"""
)
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
        F.split_part(F.col("url"), F.lit("/"), F.lit(4)).alias("section"),
        F.size(F.regexp_extract_all(F.col("html"), F.lit(r'href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"),
    )


@query(
    """SELECT lang, substr(md5('doc_idtextlangsourcen_chars'), 1, 6) AS dataset_key, count(*) AS n_rows
FROM documents GROUP BY lang"""
)
def schema_key(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents")
    counted = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("lang", keys.schema_key(docs).alias("dataset_key"), "n_rows")


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       concat('{"event_id":', event_id, ',"event_type":"', event_type, '"}') AS encoded FROM events"""
)
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    parsed = tables.table(spark, sf, "events").withColumn("p", F.from_json("props", "k bigint"))
    return parsed.select(
        "event_id", F.col("p.k").alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("encoded")
    )


@query(
    "SELECT doc_id, concat_ws('_', lang, source) AS lang_source, text = '' AS is_empty FROM documents"
)
def composite_key(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "documents").select(
        "doc_id", F.concat_ws("_", "lang", "source").alias("lang_source"), (F.col("text") == "").alias("is_empty")
    )


@query(
    rf"""WITH {tables.ARTICLES}
SELECT doc_id, regexp_extract(url, '(\d+)$', 1) AS tail, md5(url) AS url_key, coalesce(length(locations), 0) AS n FROM articles"""
)
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    return tables.articles(spark, sf).select(
        "doc_id",
        F.regexp_extract("url", r"(\d+)$", 1).alias("tail"),
        F.md5("url").alias("url_key"),
        F.coalesce(F.length("locations"), F.lit(0)).cast("long").alias("n"),
    )


