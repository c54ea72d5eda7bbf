"""Reading and writing: every query writes derived data to the shared folder and reads it back."""

from __future__ import annotations

import datetime
import functools
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import plans
from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.operators.aggregates import assert_rows, expect_rows
from tidewatch.operators.joins import join_articles, pending
from tidewatch.operators.tagging import top_countries
from tidewatch.schemas import ARTICLE_COLUMNS, PREDICTION_SCHEMA
from tidewatch.session import scratch_path
from tidewatch.sinks import (
    append_table,
    overwrite_partitions,
    publish_partitions,
    read_published,
    rebalance,
    write_csv,
    write_json_lines,
    write_manifest,
    write_table,
    write_version,
)
from tidewatch.sources import (
    landed,
    missing_granules,
    read_article_embeddings,
    read_articles,
    read_country_months,
    read_granules,
    read_labels,
    read_many,
    read_table,
    typed_articles,
    typed_embeddings,
    with_source_file,
)
from tidewatch.sources.granules import file_system
from tidewatch.sources.news import drop_unused


def _granule(date: str) -> Column:
    """Feed files of the derived articles hold one month each."""
    return F.date_format(F.trunc(F.col(date), "MM"), "yyyyMMdd000000")


def write_article_feed(spark: SparkSession, sf: str) -> str:
    """Articles as tab-separated lines in one folder per granule.

    The lines of one source get two fields too many, those of another end after the
    fifth field.
    """
    values = {
        "GKGRECORDID": "record_id",
        "DATE": "date_format(published, 'yyyyMMddHHmmss')",
        "SourceCommonName": "source",
        "DocumentIdentifier": "url",
        "V2Locations": "coalesce(locations, '')",
        "V2Themes": "concat('\"', lang)",
    }
    fields = F.array(*[F.expr(values.get(c, "''")) for c in ARTICLE_COLUMNS])
    line = (
        F.when(F.col("source") == "src3", F.concat(fields, F.array(F.lit("x"), F.lit("y"))))
        .when(F.col("source") == "src5", F.slice(fields, 1, 5))
        .otherwise(fields)
    )
    path = scratch_path(spark, "article-feed")
    lines = tables.articles(spark, sf).select(F.array_join(line, "\t").alias("value"), _granule("published").alias("feed"))
    rebalance(lines, ["feed"]).write.partitionBy("feed").text(path)
    return path


def write_embedding_feed(spark: SparkSession, sf: str) -> str:
    """Embeddings as gzip JSON; the lines of one label hold their object twice."""
    record = F.to_json(
        F.struct(
            F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
            F.lit("ENGLISH").alias("lang"),
            F.concat(F.lit("Title } { "), F.col("vec_id")).alias("title"),
            F.lit("m").alias("model"),
            "url",
            F.col("embedding").alias("docembed"),
        )
    )
    line = F.when(F.col("label") == 4, F.concat(record, record)).otherwise(record)
    path = scratch_path(spark, "embedding-feed")
    lines = tables.embedded(spark, sf).select(line.alias("value"), _granule("date").alias("feed"))
    rebalance(lines, ["feed"]).write.partitionBy("feed").option("compression", "gzip").text(path)
    return path


_FEED = """feed AS (
  SELECT doc_id, record_id, url, source, concat('"', lang) AS themes, published,
         strftime(date_trunc('month', published), '%Y%m%d000000') AS granule,
         CASE WHEN source <> 'src5' THEN locations END AS locations, source = 'src5' AS is_short
  FROM articles WHERE source <> 'src3')"""


@query(
    f"""WITH {tables.ARTICLES}, {_FEED}
SELECT record_id AS "GKGRECORDID", CAST(strftime(published, '%Y%m%d%H%M%S') AS BIGINT) AS "DATE",
       source AS "SourceCommonName", url AS "DocumentIdentifier",
       CASE WHEN NOT is_short THEN themes END AS "V2Themes", locations AS "V2Locations", granule FROM feed"""
)
def articles_from_feed(spark: SparkSession, sf: str) -> DataFrame:
    read = read_articles(spark, write_article_feed(spark, sf), keep_all=True)
    return read.select(
        "GKGRECORDID", "DATE", "SourceCommonName", "DocumentIdentifier", "V2Themes", "V2Locations", "granule"
    )


@query(
    f"""WITH {tables.ARTICLES}, {_FEED}
SELECT record_id AS "GKGRECORDID", source AS "SourceCommonName", url AS "DocumentIdentifier",
       CAST(NULL AS VARCHAR) AS "V2Counts", CASE WHEN NOT is_short THEN themes END AS "V2Themes",
       locations AS "V2Locations", CAST(NULL AS VARCHAR) AS "V2Persons", CAST(NULL AS VARCHAR) AS "V2Organizations", granule
FROM feed"""
)
def used_columns(spark: SparkSession, sf: str) -> DataFrame:
    """All 27 fields are read, and those that no later stage reads are dropped."""
    return drop_unused(read_articles(spark, write_article_feed(spark, sf), keep_all=True))


_DECODED = """SELECT url, date, 'ENGLISH' AS lang, concat('Title } { ', vec_id) AS title,
       strftime(date_trunc('month', date), '%Y%m%d000000') AS granule,
       round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total
FROM embedded, range(CASE WHEN label = 4 THEN 2 ELSE 1 END) AS copies"""


@query(f"WITH {tables.EMBEDDED} {_DECODED}", stamps=("date",))
def embeddings_from_feed(spark: SparkSession, sf: str) -> DataFrame:
    read = read_article_embeddings(spark, write_embedding_feed(spark, sf))
    total = F.aggregate("docembed", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return read.select("url", "date", "lang", "title", "granule", F.round(total, 5).alias("total"))


@query(
    f"""WITH {tables.EMBEDDED}
SELECT url, date, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total,
       'granule-' || strftime(date_trunc('month', date), '%Y%m') AS month FROM embedded""",
    stamps=("date",),
)
def embeddings_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The fast path: one object per line, decoded inside the JVM."""
    path = scratch_path(spark, "embedding-lines")
    record = tables.embedded(spark, sf).select(
        F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), "url", F.col("embedding").alias("docembed")
    )
    write_json_lines(record, path)
    read = read_article_embeddings(spark, path, layout="lines")
    total = F.aggregate("docembed", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return read.select(
        "url",
        "date",
        F.round(total, 5).alias("total"),
        F.concat(F.lit("granule-"), F.date_format("date", "yyyyMM")).alias("month"),
    )


@query(
    rf"""WITH {tables.ARTICLES}, {_FEED}, {tables.EMBEDDED},
coded AS (SELECT *, coalesce(regexp_extract_all(locations, '1#[\pL\pN_]+#([\pL\pN_]{{2}})#', 1), []) AS codes FROM feed),
tops AS (SELECT *, list_filter(codes, lambda x, i: list_position(codes, x) = i) AS t FROM coded)
SELECT record_id AS "GKGRECORDID", t.url AS "DocumentIdentifier", t[1] AS "country-1", t[2] AS "country-2",
       t[3] AS "country-3", granule AS gkg_file, CAST(year(e.date) AS INT) AS year, CAST(month(e.date) AS INT) AS month,
       strftime(e.date, '%Y%m') AS yearmonth
FROM tops t JOIN embedded e ON t.url = e.url AND granule = strftime(date_trunc('month', e.date), '%Y%m%d000000')"""
)
def ingested_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds read, tagged, deduplicated, joined, published and read back. Every file is opened once."""
    span = {"start": datetime.date(2020, 1, 1), "end": datetime.date(2021, 2, 1), "every": "1 month", "names": "feed={stamp}/"}
    raw, _ = landed(read_granules(spark, write_article_feed(spark, sf), feed="articles", **span), "landed-articles")
    vectors, _ = landed(read_granules(spark, write_embedding_feed(spark, sf), **span), "landed-embeddings")
    articles = plans.tagged_articles(typed_articles(raw))
    path = scratch_path(spark, "joined")
    publish_partitions(join_articles(articles, plans.unique_embeddings(typed_embeddings(vectors), located=True)), path, "day")
    return read_published(spark, path).select(
        "GKGRECORDID",
        "DocumentIdentifier",
        "`country-1`",
        "`country-2`",
        "`country-3`",
        "gkg_file",
        "year",
        "month",
        "yearmonth",
    )


@query(
    f"""WITH {tables.ARTICLES}
SELECT doc_id, strftime(date_trunc('month', published), '%Y%m%d000000') AS gkg_file FROM articles"""
)
def source_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "source-files")
    rows = tables.articles(spark, sf).select("doc_id", _granule("published").alias("feed"))
    rebalance(rows, ["feed"]).write.partitionBy("feed").parquet(path)
    return with_source_file(spark.read.parquet(path), "gkg_file").select("doc_id", "gkg_file")


@query(
    f"""WITH {tables.ARTICLES}
SELECT DISTINCT strftime(published, '%Y%m%d000000') AS granule FROM articles
WHERE strftime(published, '%Y%m%d000000') NOT IN (
  SELECT strftime(date_trunc('month', published), '%Y%m%d000000') FROM articles WHERE source <> 'src3')"""
)
def quarantined_granules(spark: SparkSession, sf: str) -> DataFrame:
    """Days expected as granules of a feed that holds months: all but the first of each month are missing."""
    day = F.date_format("published", "yyyyMMdd000000").alias("granule")
    read = read_articles(spark, write_article_feed(spark, sf))
    return missing_granules(tables.articles(spark, sf).select(day), read)


#: Of the spoiled feed: every third granule is cut off, and loses these rows.
_LOST = "(month(date) % 3 = 0 AND vec_id % 2 = 0)"


def _spoiled_files(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write the objects of each granule, which come one after another, as a gzip file; one that loses rows ends early."""
    system, root = file_system(path)
    out = packer = current = None

    def close() -> None:
        out.write(packer.flush(zlib.Z_FULL_FLUSH if cut else zlib.Z_FINISH))
        out.close()

    for batch in batches:
        for granule, lost, text in zip(*[batch.column(c).to_pylist() for c in ("granule", "lost", "value")], strict=True):
            if granule != current:
                if out is not None:
                    close()
                current, cut = granule, False
                out, packer = system.open_output_stream(f"{root}/{granule}.json.gz", compression=None), zlib.compressobj(wbits=31)
            cut |= lost
            if not lost:
                out.write(packer.compress(text.encode()))
        yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])
    if out is not None:
        close()


def write_spoiled_feed(spark: SparkSession, sf: str) -> str:
    """Embeddings back to back, a gzip file per month: some objects spoiled, some lines long, some files cut off."""
    path = scratch_path(spark, "spoiled-feed")
    title = F.when(F.col("label") == 3, F.repeat(F.lit("long } { "), 2000)).otherwise("short")
    record = F.to_json(F.struct("url", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), title.alias("title"), F.col("embedding").alias("docembed")))
    value = F.when(F.col("label") == 2, '{"url": oops}').otherwise(record)
    rows = tables.embedded(spark, sf).select(_granule("date").alias("granule"), F.expr(_LOST).alias("lost"), "vec_id", value.alias("value"))
    system, root = file_system(path)
    system.create_dir(root)
    placed = rows.repartition("granule").sortWithinPartitions("granule", "lost", "vec_id")
    placed.mapInArrow(functools.partial(_spoiled_files, path), "n bigint").agg(F.sum("n")).collect()
    return path


@query(
    f"""WITH {tables.EMBEDDED},
held AS (
  SELECT strftime(date_trunc('month', date), '%Y%m%d000000') AS granule, label, {_LOST} AS lost FROM embedded),
counted AS (
  SELECT granule, count(*) FILTER (label <> 2 AND NOT lost) AS read, count(*) FILTER (label = 2 AND NOT lost) AS rejected,
         NOT bool_or(lost) AS complete FROM held GROUP BY granule),
months AS (SELECT strftime(m, '%Y%m%d000000') AS granule
  FROM (SELECT unnest(generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2021-06-01', INTERVAL 1 MONTH)) AS m))
SELECT granule, read IS NOT NULL AS found, coalesce(read, 0) AS read, coalesce(rejected, 0) AS rejected,
       coalesce(complete, false) AS complete FROM months LEFT JOIN counted USING (granule)""",
    flags=("found", "complete"),
)
def granule_report(spark: SparkSession, sf: str) -> DataFrame:
    """What could be read of each granule of a spoiled feed, counted in the pass that reads the rows; some are not there."""
    feed = write_spoiled_feed(spark, sf)
    granules = read_granules(spark, feed, datetime.date(2020, 1, 1), datetime.date(2021, 7, 1), every="1 month", names="{stamp}.json.gz")
    rows, counts = landed(granules, "landed-spoiled")
    read = rows.groupBy("granule").agg(F.count(F.lit(1)).alias("landed"))
    # The rows that came, not only those the count speaks of.
    met = counts.join(read, "granule", "left")
    return met.select("granule", "found", F.coalesce("landed", F.lit(0)).alias("read"), "rejected", "complete")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.round("o_totalprice", 2).alias("price"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )


@query(
    """SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders
WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3 AND o_orderpriority = '1-URGENT'"""
)
def partitioned_read(spark: SparkSession, sf: str) -> DataFrame:
    """A table by year and month, read for one month, two columns and some rows."""
    path = scratch_path(spark, "by-month")
    write_table(_orders(spark, sf), path, ["year", "month"])
    return read_table(
        spark, path, ["o_orderkey", "price"], F.col("o_orderpriority") == "1-URGENT", year=1996, month=3
    )


@query(
    """SELECT o_orderkey, round(CASE WHEN year(o_orderdate) = 1997 THEN 2 * round(o_totalprice, 2)
       ELSE round(o_totalprice, 2) END, 2) AS price, CAST(year(o_orderdate) AS VARCHAR) AS year
FROM orders WHERE year(o_orderdate) <> 1995"""
)
def rewritten_partition(spark: SparkSession, sf: str) -> DataFrame:
    """One year is published again, twice, with other values; one loses all its rows; a run that breaks before it publishes
    changes nothing; the other years stay."""
    path = scratch_path(spark, "rewritten")
    orders = _orders(spark, sf).select("o_orderkey", "price", "year")
    publish_partitions(orders, path, "year")
    again = orders.where("year = 1997").withColumn("price", F.round(F.col("price") * 2, 2))
    publish_partitions(again, path, "year", ["1997", "1995"])
    publish_partitions(again, path, "year", ["1997"])
    # Written and never published.
    write_version(orders.where("year in (1995, 1996)").withColumn("price", F.lit(0.0)), path, "year")
    return read_published(spark, path).select("o_orderkey", "price", "year")


@query(
    """SELECT o_orderkey, round(CASE WHEN year(o_orderdate) = 1997 THEN 2 * round(o_totalprice, 2)
       ELSE round(o_totalprice, 2) END, 2) AS price, CAST(year(o_orderdate) AS INT) AS year FROM orders"""
)
def overwritten_folder(spark: SparkSession, sf: str) -> DataFrame:
    """One year's folder is written again, twice, with other values; the other folders stay."""
    path = scratch_path(spark, "overwritten")
    orders = _orders(spark, sf).select("o_orderkey", "price", "year")
    write_table(orders, path, ["year"])
    again = orders.where("year = 1997").withColumn("price", F.round(F.col("price") * 2, 2))
    overwrite_partitions(again, path, ["year"])
    overwrite_partitions(again, path, ["year"])
    return spark.read.parquet(path).select("o_orderkey", "price", "year")


@query(
    """SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n_rows FROM orders GROUP BY 1
UNION ALL SELECT 0, count(*) FROM labels"""
)
def appended_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "appended")
    append_table(_orders(spark, sf).select("o_orderkey", "year"), path, ["year"])
    labels = tables.table(spark, sf, "labels").select(F.col("doc_id").alias("o_orderkey"), F.lit(0).alias("year"))
    append_table(labels, path, ["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """SELECT o_orderpriority, count(*) AS n_rows, CAST(ceil(count(*) / 1000) AS BIGINT) AS n_files,
       least(count(*), 1000) AS largest_file FROM orders GROUP BY o_orderpriority"""
)
def file_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """One folder per priority, each of files of 1,000 rows and one of the rest."""
    path = scratch_path(spark, "file-sizes")
    orders = _orders(spark, sf).select("o_orderkey", "o_orderpriority")
    write_table(orders, path, ["o_orderpriority"], rows_per_file=1000)
    files = spark.read.parquet(path).groupBy("o_orderpriority", F.col("_metadata.file_path").alias("file")).count()
    return files.groupBy("o_orderpriority").agg(
        F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.max("count").alias("largest_file")
    )


@query("SELECT o_orderpriority, count(*) AS n_rows, 1 AS n_tasks FROM orders GROUP BY o_orderpriority")
def rebalanced_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Before a write the rows of a folder come together in one task, unless they are too large for one."""
    orders = rebalance(_orders(spark, sf).select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])
    return (
        orders.withColumn("task", F.spark_partition_id())
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("task").alias("n_tasks"))
    )


@query(
    """SELECT 'orders' AS output, count(*) AS observed, count(*) AS written FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) FROM lineitem"""
)
def observed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted while a table is written, next to those read back; an output without rows would raise."""
    made = []
    for name in ("orders", "lineitem"):
        path = scratch_path(spark, name)
        counted, seen = expect_rows(tables.table(spark, sf, name), name)
        write_table(counted, path)
        made.append(
            spark.read.parquet(path).agg(
                F.lit(name).alias("output"),
                F.lit(assert_rows(seen, name)).cast("bigint").alias("observed"),
                F.count(F.lit(1)).alias("written"),
            )
        )
    return functools.reduce(DataFrame.unionByName, made)


@query(f"WITH {tables.PANEL} SELECT strftime(month, '%Y-%m') AS month, fatalities FROM panel")
def many_csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """One CSV folder per country, read by pattern as one table."""
    path = scratch_path(spark, "many-csv")
    rows = tables.panel(spark, sf).select("country", F.date_format("month", "yyyy-MM").alias("month"), "fatalities")
    write_csv(rows, path, ["country"], mode="append")
    schema = T.StructType([T.StructField("month", T.StringType()), T.StructField("fatalities", T.LongType())])
    return read_many(spark, f"{path}/*/*.csv", schema)


@query(
    f"WITH {tables.SPIKED} SELECT country, month, fatalities, trend, spike FROM spiked",
    dates=("month",),
    flags=("spike",),
)
def labels_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    labels = plans.label_panel(tables.panel(spark, sf))
    write_csv(labels.select("country", "month", "fatalities", "trend", "spike"), path)
    return read_labels(spark, path)


@query(
    f"""WITH {tables.LABELLED}
SELECT strftime(month - INTERVAL 2 MONTH, '%Y-%m') AS embedding_window, strftime(month, '%Y-%m') AS target_window,
       country AS fips, spike AS lagged_spike, CAST(trend > 1 AS INT) AS prediction,
       round(1 / (1 + exp(-trend)), 6) AS probabilities
FROM labels_by_code WHERE spike IS NOT NULL""",
)
def predictions_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions written as CSV with a header and read back."""
    path = scratch_path(spark, "predictions")
    labels = tables.labels_by_code(spark, sf).where(F.col("spike").isNotNull())
    write_csv(
        labels.select(
            F.date_format(F.add_months("month", -2), "yyyy-MM").alias("embedding_window"),
            F.date_format("month", "yyyy-MM").alias("target_window"),
            F.col("country").alias("fips"),
            F.col("spike").alias("lagged_spike"),
            (F.col("trend") > 1).cast("int").alias("prediction"),
            F.round(1 / (1 + F.exp(-F.col("trend"))), 6).alias("probabilities"),
        ),
        path,
    )
    return read_many(spark, f"{path}/*.csv", PREDICTION_SCHEMA)


@query(
    f"""WITH {tables.EXPLODED}
SELECT doc_id, country, strftime(published, '%Y%m') AS yearmonth FROM by_country
WHERE country = 'AZ' AND strftime(published, '%Y%m') IN ('202002', '202003')"""
)
def country_months(spark: SparkSession, sf: str) -> DataFrame:
    """Articles stacked by month and country; one country and two months are read."""
    path = scratch_path(spark, "stacked")
    tagged = top_countries(tables.articles(spark, sf), "locations").withColumnRenamed("published", "date")
    plans.stack_months(tagged.select("doc_id", "date", "`country-1`", "`country-2`", "`country-3`"), path)
    rows = read_country_months(spark, path, "AZ", ["202002", "202003"])
    return rows.select("doc_id", "country", F.col("yearmonth").cast("string").alias("yearmonth"))


@query(
    f"""WITH {tables.EXPLODED}
SELECT country, strftime(published, '%Y%m') AS yearmonth, count(*) AS count, '5' AS articles_per_sample
FROM by_country GROUP BY ALL"""
)
def written_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per month and country as a JSON table, stamped with a setting; a rerun of done months adds none."""
    tagged = top_countries(tables.articles(spark, sf), "locations").withColumnRenamed("published", "date")
    rows = tagged.select("doc_id", "date", "`country-1`", "`country-2`", "`country-3`")
    path = scratch_path(spark, "manifest")
    first = plans.stack_months(rows, f"{path}/stacked").drop("filename")
    write_manifest(first, f"{path}/manifest", {"articles_per_sample": "5"})
    done = spark.read.schema("country string, yearmonth string, count bigint, articles_per_sample string").json(
        f"{path}/manifest"
    )
    months = rows.select(F.date_format("date", "yyyyMM").alias("yearmonth")).distinct()
    left = pending(months, done, ["yearmonth"]).selectExpr("'' AS country", "yearmonth", "0L AS count", "'' AS articles_per_sample")
    return done.select("country", "yearmonth", "count", "articles_per_sample").unionByName(left)
