"""Scores of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import range_bounds, running_totals
from tidewatch.session import shuffle_width


def _ratio(a: Column, b: Column) -> Column:
    """a / b as a double, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Confusion counts and the scores made from them, in one pass."""
    y, p = F.col(truth).cast("boolean"), F.col(predicted).cast("boolean")
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    return scores_of_counts(counts)


def scores_of_counts(counts: DataFrame) -> DataFrame:
    """The scores of the four counts of a confusion table."""
    # As doubles: products of counts of billions do not fit a long.
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    expected = _ratio((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    observed = _ratio(tp + tn, n)
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        observed.alias("accuracy"),
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("balanced_accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(observed - expected, 1 - expected).alias("kappa"),
    )


def roc_auc(df: DataFrame, truth: str, score: str, ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when a class is missing.

    Rows without a label or a score do not count.
    Rows are first reduced to one per distinct score. Each score then needs the
    number of negatives below it, a running total over ranges of the score.
    """
    y = F.col(truth).cast("boolean")
    scored = df.select(F.col(score).cast("double").alias("score"), y.alias("y")).dropna()
    by_score = scored.groupBy("score").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    # Bounds of the rows' scores do as well as those of the distinct ones, without the grouping.
    bounds = range_bounds(scored, "score", ranges or shuffle_width(df.sparkSession))
    below = running_totals(by_score, "score", ["neg"], bounds=bounds)
    won = F.sum((F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2))).cast("double"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return below.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.try_divide(won, pairs).alias("roc_auc")
    )


def mae_by_series(df: DataFrame, series: str, truth: str, predicted: str) -> DataFrame:
    """Mean absolute error of each series."""
    return df.groupBy(series).agg(F.avg(F.abs(F.col(truth) - F.col(predicted))).alias("mae"))


def mean_mae(df: DataFrame, series: str, truth: str, predicted: str) -> DataFrame:
    """The series' errors averaged, every series counting the same."""
    return mae_by_series(df, series, truth, predicted).agg(F.avg("mae").alias("mean_mae"))


def compare_models(
    a: DataFrame, b: DataFrame, manifest: DataFrame, key: str = "country", on: str = "country_ym"
) -> DataFrame:
    """Accuracy per country of two models on the country-months both scored.

    ``a`` and ``b`` carry ``key``, ``on``, ``truth`` and ``predicted``; ``manifest``
    carries ``on`` and ``count`` (articles behind the prediction).
    """
    left = a.distinct().select(
        key, on, (F.col("truth").cast("int") == F.col("predicted").cast("int")).cast("int").alias("a_right")
    )
    right = b.select(on, (F.col("truth").cast("int") == F.col("predicted").cast("int")).cast("int").alias("b_right"))
    sized = left.join(manifest.select(on, "count").distinct(), on, "left")
    return (
        sized.join(right, on)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.sum(F.coalesce("count", F.lit(0))).alias("articles"),
            F.avg("a_right").alias("a_accuracy"),
            F.avg("b_right").alias("b_accuracy"),
        )
    )
