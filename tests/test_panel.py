import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import panel


def month(i):
    return datetime.date(2020 + i // 12, i % 12 + 1, 1)


def frame(spark, series):
    rows = [(c, month(i), y) for c, points in series.items() for i, y in points]
    return spark.createDataFrame(rows, "country string, month date, fatalities bigint")


def by_key(df):
    return {(r["country"], r["month"]): r for r in df.collect()}


def naive_features(points, i, n=3):
    """Row i of a series, worked out from the definition."""
    window = [y for m, y in points if i - n <= m <= i]
    before = window[:-1]
    recent = window[-n:]
    slope = np.polyfit(range(len(recent)), recent, 1)[0] if len(recent) > 1 else 0.0
    return (
        before[-1] if before else None,
        float(np.mean(before)) if before else None,
        float(np.std(before, ddof=1)) if len(before) > 1 else None,
        float(slope),
    )


def test_golden_rows(spark):
    got = by_key(panel.trend_features(frame(spark, {"a": [(0, 1), (1, 5), (2, 2)], "b": [(4, 7)]})))
    last = got["a", month(2)]
    assert (last["trend"], last["last_month"], last["mean_before"]) == (0.5, 5, 3.0)
    assert last["std_before"] == pytest.approx(2.828427, abs=1e-6)
    alone = got["b", month(4)]
    assert alone["trend"] == 0.0 and alone["any_event"]
    assert [alone[c] for c in ("last_month", "mean_before", "std_before")] == [None] * 3
    assert not any(alone[c] for c in ("more_than_last", "more_than_mean", "outside_std", "trend_increasing"))


@pytest.mark.parametrize("n", [2, 3, 5])
def test_features_equal_the_naive_loop(spark, n):
    rng = np.random.default_rng(n)
    series = {
        c: [(int(i), int(rng.integers(0, 9))) for i in sorted(rng.choice(40, 25, replace=False))] for c in "abc"
    }
    got = by_key(panel.trend_features(frame(spark, series), n=n))
    for c, points in series.items():
        for i, _ in points:
            row = got[c, month(i)]
            want = naive_features(points, i, n)
            for value, expected in zip((row["last_month"], row["mean_before"], row["std_before"], row["trend"]), want):
                if expected is None:
                    assert value is None
                else:
                    assert value == pytest.approx(expected, abs=1e-9)
            assert row["theta"] == pytest.approx(math.atan(want[3]))


def test_spike_against_numpy(spark):
    rng = np.random.default_rng(0)
    points = [(i, int(rng.integers(0, 20))) for i in range(40) if i % 7]
    got = by_key(panel.spike(panel.trend_features(frame(spark, {"a": points}))))
    trends = {i: got["a", month(i)]["trend"] for i, _ in points}
    for i, _ in points:
        history = [trends[m] for m, _ in points if i - 24 <= m < i]
        row = got["a", month(i)]
        if not history:
            assert row["spike"] is None
        else:
            assert row["spike"] == (trends[i] > np.percentile(history, 75))


def test_all_zero_country_never_spikes_unless_ties_count(spark):
    zero = panel.trend_features(frame(spark, {"z": [(i, 0) for i in range(10)]}))
    assert panel.spike(zero).where("spike").count() == 0
    assert panel.spike(zero, strict=False).where("spike").count() == 9


def test_monthly_panel_merges_rows_of_one_month(spark):
    raw = spark.createDataFrame(
        [("a", "2020-01-03", 2), ("a", "2020-01-30", 3), ("a", "2020-02-01", 1)], "country string, d string, n bigint"
    ).withColumn("d", F.to_date("d"))
    got = by_key(panel.monthly_panel(raw, "country", "d", F.col("n")))
    assert got["a", month(0)]["fatalities"] == 5 and len(got) == 2


def test_fill_months(spark):
    got = by_key(panel.fill_months(frame(spark, {"a": [(11, 4), (14, 6)], "b": [(3, 1)]}), "country", "month", ["fatalities"]))
    assert {k: r["fatalities"] for k, r in got.items()} == {
        ("a", month(11)): 4,
        ("a", month(12)): 0,
        ("a", month(13)): 0,
        ("a", month(14)): 6,
        ("b", month(3)): 1,
    }


def test_split_last_and_lags(spark):
    df = frame(spark, {"a": [(i, i) for i in range(8)]})
    assert panel.split_last(df, "country", "month", 6).where("held_out").count() == 6
    lagged = by_key(panel.lag_features(df, "country", "month", ["fatalities"], 3))
    row = lagged["a", month(5)]
    assert [row[f"fatalities_lag{i}"] for i in (1, 2, 3)] == [4, 3, 2]
    assert lagged["a", month(1)]["fatalities_lag2"] is None


def test_spike_ranges(spark):
    df = frame(spark, {"a": [(0, 1), (1, 2), (2, 3)]}).withColumn("spike", F.col("fatalities") == 2)
    row = panel.spike_ranges(df, "country", "month").first()
    assert (float(row["range_start"]), float(row["range_end"])) == (0.5, 1.5)
