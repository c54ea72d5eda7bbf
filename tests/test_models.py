import datetime
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewatch.catalog import QUERIES, vectors
from tidewatch.operators import models
from tidewatch.plans import forecast_scores


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(160) < 0.3).astype(float)
    x = rng.normal(size=(160, 6)) * [3, 1, 1, 1, 0.2, 0.1] + y[:, None] * [4, 0, 0, 0, 0, 0]
    rows = [(i, x[i].tolist(), float(y[i]), "AB"[i % 2] if i < 120 else "AC"[i % 2]) for i in range(160)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y double, country string")
    return df.where("id < 120"), df.where("id >= 120")


def test_one_hot_keeps_common_categories_only(points):
    train, test, slots = models.one_hot(*points, "country", "slots")
    assert slots == ["A"]
    assert {(r["country"], tuple(r["slots"])) for r in test.select("country", "slots").distinct().collect()} == {
        ("A", (1.0,)),
        ("C", (0.0,)),
    }
    assert train.where("country = 'B'").first()["slots"] == [0.0]


def test_standardise_uses_the_population_deviation(points):
    train, test = (models.as_vector(d, "v") for d in points)
    scaled, other = models.standardise(train, test)
    raw = np.array([r["v"] for r in train.orderBy("id").collect()])
    got = np.array([r[0] for r in scaled.orderBy("id").select(vector_to_array("scaled")).collect()])
    assert np.allclose(got, (raw - raw.mean(0)) / raw.std(0))
    late = np.array([r["v"] for r in test.orderBy("id").collect()])
    got = np.array([r[0] for r in other.orderBy("id").select(vector_to_array("scaled")).collect()])
    assert np.allclose(got, (late - raw.mean(0)) / raw.std(0))


def test_pca_keeps_the_fewest_components(points):
    train, test = (models.as_vector(d, "v") for d in points)
    scaled, other = models.standardise(train, test)
    projected, _, kept = models.pca_variance(scaled, other, 0.8)
    raw = np.array([r[0] for r in scaled.select(vector_to_array("scaled")).collect()])
    shares = np.linalg.eigvalsh(np.cov(raw.T))[::-1]
    shares = np.cumsum(shares / shares.sum())
    assert kept == int(np.argmax(shares >= 0.8)) + 1
    assert projected.select(F.size(vector_to_array("projected"))).first()[0] == kept


def test_ensemble_averages_and_breaks_ties_low(spark):
    a = spark.createDataFrame([(1, [0.4, 0.6]), (2, [0.5, 0.5])], "id int, probabilities array<double>")
    b = spark.createDataFrame([(1, [0.2, 0.8]), (2, [0.5, 0.5])], "id int, probabilities array<double>")
    got = {r["id"]: r for r in models.ensemble([a, b], "id").collect()}
    assert got[1]["prediction"] == 1 and got[1]["probabilities"] == pytest.approx([0.3, 0.7])
    assert got[2]["prediction"] == 0


def test_train_and_predict_learns(points):
    train, test = points
    got = models.train_and_predict(train, test, "v", "y", "id", "country", rounds=10, rate=0.1, depth=2, k=5)
    rows = got.collect()
    assert len(rows) == 40 and {r["id"] for r in rows} == set(range(120, 160))
    assert sum(r["prediction"] == r["y"] for r in rows) >= 30
    assert all(0 <= r["probability"] <= 1 and r["prediction"] == int(r["probability"] > 0.5) for r in rows)


def test_fitted_ensemble_scores_any_table(points):
    train, test = points
    model = models.fit_ensemble(train, "v", "y", ["id", "country"], "country", rounds=5, rate=0.2, depth=2, k=5)
    # Repeated keys and an unknown category are scored like any row.
    twice = test.unionByName(test).unionByName(test.withColumn("country", F.lit("Z")))
    scored = model.predict_proba(twice)
    assert scored.count() == 120
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 for r in scored.collect())
    again = {(r["id"], r["country"], r["prediction"]) for r in model.predict(test).collect()}
    assert again <= {(r["id"], r["country"], r["prediction"]) for r in scored.collect()}


def test_short_series_get_no_forecast(spark):
    rows = [(c, datetime.date(2018 + i // 12, i % 12 + 1, 1), float(i % 4)) for c, n in (("a", 30), ("b", 8)) for i in range(n)]
    panel = spark.createDataFrame(rows, "country string, month date, y double")
    got = forecast_scores(panel, "y", []).first()
    assert got["series"] == 2 and got["skipped"] == 1 and got["mean_mae"] >= 0


def test_dense_network(points):
    train, test = models.standardise(*(models.as_vector(d, "v") for d in points))
    got = models.dense_classifier(train, test, "y", "scaled", hidden=8)
    deep = models.dense_classifier(train, test, "y", "scaled", hidden=[8, 4], epochs=20)
    assert deep.count() == 40
    rows = got.collect()
    assert len(rows) == 40 and sum(r["prediction"] == r["y"] for r in rows) >= 28


@pytest.mark.parametrize("model", ["forest", "boosted"])
def test_lag_forecast_follows_a_season(spark, model):
    rows = [
        (c, datetime.date(2018 + i // 12, i % 12 + 1, 1), float(10 * (i % 3 == 0) + shift), float(i % 3))
        for c, shift in (("a", 0), ("b", 1))
        for i in range(42)
    ]
    panel = spark.createDataFrame(rows, "country string, month date, y double, x double")
    got = models.lag_forecast(panel, "country", "month", "y", ["x"], model=model).collect()
    assert len(got) == 12
    assert np.mean([abs(r["actual"] - r["predicted"]) for r in got]) < 2
    with pytest.raises(ValueError):
        models.lag_forecast(panel, "country", "month", "y", [], step=4)


def test_with_context(spark):
    dim = spark.createDataFrame([("a", 1.5, "low"), ("b", 2.5, "high")], "country string, rate double, band string")
    got = models.with_context(spark.createDataFrame([("a",), ("z",)], "country string"), dim, "country", ["rate"], ["band"])
    assert {r["country"]: (r["rate"], r["band_low"], r["band_high"]) for r in got.collect()} == {
        "a": (1.5, 1, 0),
        "z": (None, None, None),
    }


@pytest.mark.parametrize("name", ["boosted_predictions", "ensemble_predictions", "spike_predictions"])
def test_registered_models_boost_as_the_operator_does(spark, monkeypatch, name):
    class Asked(Exception):
        pass

    def asked(maxIter, stepSize, **_):  # noqa: N803
        raise Asked(maxIter, stepSize)

    monkeypatch.setattr(models, "GBTClassifier", asked)
    with pytest.raises(Asked) as found:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert found.value.args == (200, 0.01)


def test_forecast_scores_takes_the_whole_panel(spark, monkeypatch):
    rows = [(c, datetime.date(1998 + i // 12, i % 12 + 1, 1), float(i % 4), float(i % 3)) for c in ("KENYA", "CHINA", "PERU") for i in range(30)]
    panel = spark.createDataFrame(rows, "country string, month date, fatalities double, others double")
    monkeypatch.setattr(vectors, "_counts", lambda spark, sf: panel)
    got = QUERIES["forecast_scores"](spark, "").first()
    assert (got["series"], got["skipped"]) == (3, 0)


def test_a_saved_ensemble_scores_alike_in_a_new_session(spark, points, tmp_path):
    train, test = points
    test = test.withColumn("v", F.when(F.col("id") % 10 == 0, F.array_repeat(F.lit(0.5), 6)).otherwise(F.col("v")))
    maker = models.EnsembleClassifier(vector="v", label="y", ids=["id"], category="country", rounds=5, rate=0.2, depth=2, k=5)
    maker.write().overwrite().save(f"{tmp_path}/maker")
    again = models.EnsembleClassifier.load(f"{tmp_path}/maker")
    assert {p.name: v for p, v in again.extractParamMap().items()} == {p.name: v for p, v in maker.extractParamMap().items()}
    model = again.fit(train)
    expected = sorted((r["id"], r["prediction"], r["probability"]) for r in model.transform(test).collect())
    test.write.parquet(f"{tmp_path}/test")
    for _ in range(2):
        model.save(f"{tmp_path}/model")
    script = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from tidewatch.operators.models import EnsembleModel
from tidewatch.session import build_session
spark = build_session("loaded", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path / "shared")!r}, "spark.sql.shuffle.partitions": "2"}})
spark.sparkContext.setLogLevel("ERROR")
rows = EnsembleModel.load(spark, {f"{tmp_path}/model"!r}).transform(spark.read.parquet({f"{tmp_path}/test"!r})).collect()
print("ROWS", sorted((r["id"], r["prediction"], r["probability"]) for r in rows))
"""
    said = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    line = next((x for x in said.stdout.splitlines() if "ROWS" in x), said.stderr[-2000:])
    assert line[line.index("ROWS") + 5 :] == str(expected)


def test_projection_multiplies_by_the_kept_components_only(points):
    train, test = (models.as_vector(d, "v") for d in points)
    whole, kept_all = models.projection_step(train, 2.0, "features")
    cut, kept = models.projection_step(train, 0.8, "features")
    assert kept < kept_all == 6
    full = {r["id"]: r["projected"].toArray() for r in whole(test).collect()}
    for r in cut(test).collect():
        assert len(r["projected"]) == kept and np.allclose(r["projected"].toArray(), full[r["id"]][:kept])


def test_rounds_get_equal_parts_of_a_table_of_one_part(spark, points, monkeypatch):
    """Each round waits for its largest part, so one file or row group must not stay one task; few rows stay together."""
    train, seen = points[0].coalesce(1), []

    class Asked(Exception):
        pass

    class Maker:
        def __init__(self, **_):
            pass

        def fit(self, ready):
            seen.append([r["n"] for r in ready.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()])
            raise Asked

    monkeypatch.setattr(models, "GBTClassifier", Maker)
    runs = (
        lambda: models.fit_ensemble(train, "v", "y", ["id"], "country"),
        lambda: models.boosted_classifier(models.as_vector(train, "v"), models.as_vector(train, "v"), "y", "features"),
    )
    for rows, parts in ((10, 4), (4096, 1)):
        monkeypatch.setattr(models, "PART_ROWS", rows, raising=False)
        for run in runs:
            with pytest.raises(Asked):
                run()
            sizes = seen.pop()
            assert len(sizes) == parts and max(sizes) <= 2 * sum(sizes) / parts and sum(sizes) >= 120
