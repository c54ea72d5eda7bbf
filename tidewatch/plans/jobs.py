"""The multi-step jobs, each one lineage over the operators."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.arrays import widen
from tidewatch.functions.dates import parse_stamp
from tidewatch.operators.aggregates import dedup, dedup_located, mean_embedding
from tidewatch.operators.joins import join_articles, mean_dataset, pending
from tidewatch.operators.metrics import mae_by_series
from tidewatch.operators.models import lag_forecast, train_and_predict
from tidewatch.operators.panel import fill_months, spike, trend_features
from tidewatch.operators.samples import failed_keys, labelled_samples
from tidewatch.operators.sampling import split_by_time
from tidewatch.operators.tagging import explode_countries, stack_manifest, top_countries
from tidewatch.session import stored
from tidewatch.sinks.tables import overwrite_partitions, rebalance, write_csv, write_manifest, write_samples
from tidewatch.sinks.versions import publish_version, version_rows, write_version
from tidewatch.sources.granules import landed, read_granules
from tidewatch.sources.news import typed_articles, typed_embeddings


def tagged_articles(raw: DataFrame) -> DataFrame:
    """Raw article rows of one or more days: one row per address and per record and day, countries tagged.

    Of copies, the earliest granule's row stays.
    """
    dated = raw.withColumn("day", F.to_date(parse_stamp("granule")))
    by_url = dedup(dated, ["day", "DocumentIdentifier"], [F.col("granule"), F.col("GKGRECORDID")])
    by_record = dedup(by_url, ["day", "GKGRECORDID"], [F.col("granule"), F.col("DocumentIdentifier")])
    return top_countries(by_record).withColumnRenamed("granule", "gkg_file")


def unique_embeddings(raw: DataFrame, located: bool = False) -> DataFrame:
    """Raw embedding rows of one or more days: one row per address and day. ``located`` rows have been written to files."""
    dated = raw.withColumn("day", F.to_date(parse_stamp("granule")))
    unique = dedup_located if located else dedup
    return unique(dated, ["day", "url"], [F.col("granule"), F.col("date")]).withColumnRenamed("granule", "gsg_file")


def ingest_days(
    spark: SparkSession,
    articles_path: str,
    embeddings_path: str,
    out: str,
    start: datetime.date,
    end: datetime.date,
    p: float = 1.0,
    seed: int = 4,
    report: str | None = None,
    require_rows: bool = False,
    **options: str,
) -> int:
    """Read, tag, deduplicate and join the feeds of ``[start, end)``; publish those days of ``out`` in one step.

    Each file is opened once. Both feeds keep the same sampled granules. A day without files or rows is published as
    empty; with ``require_rows`` a run without any row fails instead and publishes nothing. What was read and rejected in
    each granule goes to ``report``, if given. ``options`` are those of the granule source. Returns the rows written;
    `sinks.read_published` reads them.
    """
    raw, article_counts = landed(
        read_granules(spark, articles_path, start, end, "articles", p=p, seed=seed, **options), "landed-articles"
    )
    vectors, vector_counts = landed(
        read_granules(spark, embeddings_path, start, end, "embeddings", p=p, seed=seed, **options), "landed-embeddings"
    )
    if report is not None:
        counts = [c.withColumn("feed", F.lit(n)) for n, c in (("articles", article_counts), ("embeddings", vector_counts))]
        counts[0].unionByName(counts[1]).write.mode("overwrite").json(report)
    joined = join_articles(tagged_articles(typed_articles(raw)), unique_embeddings(typed_embeddings(vectors), located=True))
    version = write_version(joined, out, "day")
    rows = version_rows(spark, out, version)
    if require_rows and not rows:
        raise ValueError(f"articles of {start} to {end}: expected rows, got none")
    days = [str(start + datetime.timedelta(days=i)) for i in range((end - start).days)]
    publish_version(joined, out, "day", version, days)
    return rows


def label_panel(panel: DataFrame, n: int = 3, q: float = 0.75, months: int = 24, strict: bool = True) -> DataFrame:
    """Monthly counts to trend features and the spike label."""
    return spike(trend_features(panel, n=n), q=q, months=months, strict=strict)


def country_month_means(articles: DataFrame, vector: str = "docembed", date: str = "date") -> DataFrame:
    """Mean embedding per country and month; an article counts for each of its countries.

    ``window`` is ``YYYY-MM`` text.
    """
    per_country = explode_countries(articles.select("`country-1`", "`country-2`", "`country-3`", date, vector))
    windowed = per_country.withColumn("window", F.date_format(date, "yyyy-MM"))
    return mean_embedding(windowed, ["country", "window"], vector)


def spike_dataset(
    means: DataFrame, labels: DataFrame, cutoffs: list[str], lag: int = 2, key: str = "country"
) -> DataFrame:
    """Mean embeddings with the spike ``lag`` months later, split by target month."""
    spikes = labels.select(F.col(key), F.date_format("month", "yyyy-MM").alias("target_window"), "spike")
    names = ["train", "test"] if len(cutoffs) == 1 else None
    return split_by_time(mean_dataset(means, spikes, key, lag), "target_window", cutoffs, names)


def stack_months(articles: DataFrame, out: str, done: DataFrame | None = None) -> DataFrame:
    """Write articles by (yearmonth, country), skipping months already done; returns the manifest of those written.

    The manifest counts what lies in the table, so the articles are tagged and exploded once.
    """
    dated = articles.withColumn("yearmonth", F.date_format("date", "yyyyMM"))
    if done is not None:
        dated = pending(dated, done, ["yearmonth"])
    months = stored(dated.select("yearmonth").distinct(), "months")
    overwrite_partitions(explode_countries(dated), out, ["yearmonth", "country"])
    if months.isEmpty():
        return stack_manifest(dated)
    written = articles.sparkSession.read.parquet(out).select(F.col("yearmonth").cast("string").alias("yearmonth"), "country")
    counted = written.join(months, "yearmonth", "left_semi").groupBy("yearmonth", "country").count()
    return counted.select(F.concat_ws("_", "yearmonth", "country").alias("filename"), "yearmonth", "country", "count")


def training_samples(
    articles: DataFrame,
    labels: DataFrame,
    out: str,
    y: str = "trend_increasing",
    n: int = 50,
    width: int = 512,
    lag: int = 2,
    n_months: int = 1,
    seed: int = 4,
    max_rows: int = 1000,
) -> DataFrame:
    """Write labelled samples, a manifest of their settings and the keys that failed; returns the failures.

    ``articles`` holds one row per article and country. The samples are read back
    from ``out``, not computed again, to find the labels without any.
    """
    samples = labelled_samples(articles, labels, y, n, width, seed, lag, n_months)
    write_samples(samples, f"{out}/data", max_rows)
    written = articles.sparkSession.read.parquet(f"{out}/data")
    wanted = labels.select("country", F.col("month").alias("target_month"))
    failures = failed_keys(wanted, written, ["country", "target_month"])
    settings = {"articles_per_sample": n, "label_column": y, "months_per_sample": n_months, "lag_months": lag}
    write_manifest(written.groupBy("label").count(), f"{out}/manifest", settings)
    return failures


def country_mean_files(articles: DataFrame, out: str, width: int) -> None:
    """Mean embedding per month as CSV, one folder per country and one column per component."""
    wide = widen(country_month_means(articles), "docembed", width)
    write_csv(rebalance(wide, ["country"]), out, ["country"])


def predict_spikes(dataset: DataFrame, out: str, key: str = "country", vector: str = "docembed", **options) -> None:
    """Fit the ensemble on the train rows of `spike_dataset`, score the test rows and write the predictions as CSV.

    Rows without a label are neither learnt from nor scored.
    """
    labelled = dataset.where(F.col("lagged_spike").isNotNull())
    rows = stored(labelled.withColumn("label", F.col("lagged_spike").cast("double")), "spike-dataset")
    train, test = (rows.where(F.col("split") == side) for side in ("train", "test"))
    scored = train_and_predict(train, test, vector, "label", [key, "window", "target_window"], key, **options)
    predictions = scored.select(
        F.col("window").alias("embedding_window"),
        "target_window",
        F.col(key).alias("fips"),
        F.col("label").cast("boolean").alias("lagged_spike"),
        "prediction",
        F.col("probability").alias("probabilities"),
    )
    write_csv(predictions, out)


def forecast_scores(
    panel: DataFrame, target: str, covariates: list[str], horizon: int = 6, lags: int = 3
) -> DataFrame:
    """Mean absolute error of the lag regressions, every series counting the same.

    Missing months are filled with zeros first. Series too short for a forecast
    have no error; ``skipped`` says how many of the ``series`` they are.
    """
    filled = fill_months(panel, "country", "month", [target, *covariates])
    forecast = lag_forecast(filled, "country", "month", target, covariates, lags, horizon=horizon)
    return mae_by_series(forecast, "country", "actual", "predicted").agg(
        F.count(F.lit(1)).alias("series"), F.count_if(F.col("mae").isNull()).alias("skipped"), F.avg("mae").alias("mean_mae")
    )
