"""Features, classifiers and forecasts with Spark ML."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (
    PCA,
    ElementwiseProduct,
    PCAModel,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.arrays import argmax, mean_vectors
from tidewatch.operators.joins import common_categories
from tidewatch.operators.neighbours import knn_proba
from tidewatch.operators.panel import lag_features
from tidewatch.operators.sampling import oversample
from tidewatch.session import stored

#: A fitted step: a table with the step's column added.
Step = Callable[[DataFrame], DataFrame]

#: Rows below which a part of its own costs a boosted round more than it saves.
PART_ROWS = 4096


def dealt(df: DataFrame, name: str, *by: str) -> DataFrame:
    """The rows stored in equal parts, one for each core, however the input is cut.

    A table of one file or row group is otherwise one task in every step that follows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return stored(df.repartition(cores, *by), name)


def rounds_of(held: DataFrame) -> DataFrame:
    """Stored rows with fewer parts if they are few: each level of each boosted tree is a job over all parts."""
    return held.coalesce(max(1, -(-held.count() // PART_ROWS)))


def as_vector(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(column).cast("array<double>")))


def one_hot_step(categories: DataFrame, column: str, name: str) -> tuple[Step, list[str]]:
    """One slot per given category, all zero for any other, and the slots in order.

    The categories are a dimension's codes, a few hundred.
    """
    index = StringIndexer(
        inputCol=column, outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc"
    ).fit(categories)
    # "keep" numbers unknown categories after the last slot.
    last = len(index.labels) - 1
    places = F.sequence(F.lit(0), F.lit(last)) if last >= 0 else F.array().cast("array<int>")
    slots = F.transform(places, lambda place: (place == F.col("_index")).cast("double"))

    def encode(df: DataFrame) -> DataFrame:
        return index.transform(df).withColumn(name, slots).drop("_index")

    return encode, list(index.labels)


def one_hot(
    train: DataFrame, test: DataFrame, column: str, name: str | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """One slot per category present on both sides, all zero for any other category."""
    encode, slots = one_hot_step(common_categories(train, test, column), column, name or f"{column}_one_hot")
    return encode(train), encode(test), slots


def scaling_stages(train: DataFrame, column: str = "features", name: str = "scaled") -> list[Transformer]:
    """Mean 0 and population standard deviation 1 on ``train``, measured in one pass: stages that can be saved."""
    seen = Observation()
    counted = train.observe(seen, F.count(F.lit(1)).alias("n"))
    scaler = StandardScaler(withMean=True, withStd=True, inputCol=column, outputCol=f"_sample_{name}").fit(counted)
    n = seen.get["n"]
    # Spark divides by the sample deviation; this turns it into the population one.
    ratio = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    stretch = ElementwiseProduct(
        scalingVec=Vectors.dense([ratio] * len(scaler.mean)), inputCol=f"_sample_{name}", outputCol=name
    )
    return [scaler, stretch]


def scaling_step(train: DataFrame, column: str = "features", name: str = "scaled") -> Step:
    scale = PipelineModel(scaling_stages(train, column, name))
    return lambda df: scale.transform(df).drop(f"_sample_{name}")


def standardise(
    train: DataFrame, test: DataFrame, column: str = "features", name: str = "scaled"
) -> tuple[DataFrame, DataFrame]:
    """Both sides by the step that is fitted on ``train``."""
    scale = scaling_step(train, column, name)
    return scale(train), scale(test)


def _with_components(model: PCAModel, kept: int) -> PCAModel:
    """The same projection with its first components alone, so that no row is multiplied by the others."""
    rows = model.pc.numRows
    context = SparkContext.getOrCreate()
    matrix = DenseMatrix(rows, kept, model.pc.toArray()[:, :kept].flatten(order="F").tolist())
    shares = Vectors.dense(model.explainedVariance.toArray()[:kept].tolist())
    made = context._jvm.org.apache.spark.ml.feature.PCAModel(model.uid, _py2java(context, matrix), _py2java(context, shares))
    for name, value in (("k", kept), ("inputCol", model.getInputCol()), ("outputCol", model.getOutputCol())):
        made.set(made.getParam(name), value)
    cut = PCAModel(made)
    cut._resetUid(model.uid)
    cut._transfer_params_from_java()
    return cut


def projection_stage(
    train: DataFrame, share: float = 0.8, column: str = "scaled", name: str = "projected"
) -> tuple[PCAModel, int]:
    """The fewest principal components that explain ``share`` of the variance of ``train``; all if none do."""
    width = len(train.select(column).first()[0])
    model = PCA(k=width, inputCol=column, outputCol=name).fit(train)
    total, kept = 0.0, 0
    for part in model.explainedVariance:
        total, kept = total + part, kept + 1
        if total >= share:
            break
    return _with_components(model, kept), kept


def projection_step(
    train: DataFrame, share: float = 0.8, column: str = "scaled", name: str = "projected"
) -> tuple[Step, int]:
    model, kept = projection_stage(train, share, column, name)
    return model.transform, kept


def pca_variance(
    train: DataFrame, test: DataFrame, share: float = 0.8, column: str = "scaled", name: str = "projected"
) -> tuple[DataFrame, DataFrame, int]:
    """Both sides by the step that is fitted on ``train``, and the components it keeps."""
    project, kept = projection_step(train, share, column, name)
    return project(train), project(test), kept


def _probabilities(scored: DataFrame, kept: list[str]) -> DataFrame:
    return scored.select(
        *kept, vector_to_array("probability").alias("probabilities"), F.col("prediction").cast("int").alias("prediction")
    )


def boosted_classifier(
    train: DataFrame,
    test: DataFrame,
    label: str = "label",
    features: str = "projected",
    rounds: int = 200,
    rate: float = 0.01,
    depth: int = 6,
    seed: int = 82,
) -> DataFrame:
    """Gradient-boosted trees: ``test`` with class probabilities and prediction."""
    held = dealt(train.select(label, features), "training")
    model = GBTClassifier(
        labelCol=label, featuresCol=features, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed
    ).fit(rounds_of(held))
    return _probabilities(model.transform(test), test.columns)


def dense_classifier(
    train: DataFrame,
    test: DataFrame,
    label: str = "label",
    features: str = "features",
    hidden: list[int] | int = 32,
    epochs: int = 100,
    seed: int = 82,
) -> DataFrame:
    """Small fully connected network with the given hidden layers."""
    hidden = [hidden] if isinstance(hidden, int) else hidden
    width = len(train.select(features).first()[0])
    model = MultilayerPerceptronClassifier(
        labelCol=label, featuresCol=features, layers=[width, *hidden, 2], maxIter=epochs, seed=seed
    ).fit(train)
    return _probabilities(model.transform(test), test.columns)


def ensemble(scored: list[DataFrame], on: str) -> DataFrame:
    """Element-wise mean of the models' probability vectors, and its larger class (first on a tie)."""
    named = [s.select(on, F.col("probabilities").alias(f"_p{i}")) for i, s in enumerate(scored)]
    joined = functools.reduce(lambda a, b: a.join(b, on), named)
    mean = mean_vectors(*[f"_p{i}" for i in range(len(named))])
    return joined.select(on, mean.alias("probabilities")).withColumn("prediction", argmax("probabilities"))


def two_classes(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Probability of class 1 to the vector of both classes."""
    p = F.col(probability)
    return df.withColumn("probabilities", F.array(1 - p, p)).drop(probability)


class VectorWithSlots(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """An array column and one slot per category, all zero for any other, as one vector."""

    def __init__(self, vector: str = "vector", category: str = "", categories: list[str] | None = None, name: str = "features"):
        super().__init__()
        self.vector, self.category = Param(self, "vector", "array column"), Param(self, "category", "column, or empty")
        self.categories, self.name = Param(self, "categories", "categories in order"), Param(self, "name", "output column")
        self._set(vector=vector, category=category, categories=categories or [], name=name)

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        slots = [F.coalesce((F.col(get(self.category)).cast("string") == c).cast("double"), F.lit(0.0)) for c in get(self.categories)]
        values = F.col(get(self.vector)).cast("array<double>")
        return df.withColumn(get(self.name), array_to_vector(F.concat(values, F.array(*slots)) if slots else values))


class EnsembleModel(Model):
    """Boosted trees and k nearest neighbours behind the stages they were fitted with. It can be saved and loaded.

    It holds models and a table of neighbours in the shared folder, and no cache.
    """

    def __init__(self, prepare: PipelineModel, boosted: GBTClassificationModel, neighbours: DataFrame, k: int):
        super().__init__()
        self.prepare, self.boosted, self.neighbours, self.k = prepare, boosted, neighbours, k

    def predict_proba(self, rows: DataFrame) -> DataFrame:
        """All rows and columns with ``probabilities`` of both classes and ``prediction``. Keys may repeat."""
        # The number is stored with the row, so both models and the join below see the same one.
        cores = rows.sparkSession.sparkContext.defaultParallelism
        numbered = rows.repartition(cores).withColumn("_nn", F.monotonically_increasing_id())
        asked = stored(self.prepare.transform(numbered).drop("features", "_sample_scaled", "scaled"), "asked")
        trees = _probabilities(self.boosted.transform(asked), ["_nn"])
        points = asked.select("_nn", vector_to_array("projected").alias("_v"))
        near = two_classes(knn_proba(self.neighbours, points, self.k, "_nn", "_v", "_y"))
        both = ensemble([trees, near], "_nn")
        return asked.drop("projected").join(both, "_nn").drop("_nn")

    def _transform(self, rows: DataFrame) -> DataFrame:
        """All rows and columns with ``prediction`` and ``probability``, that of class 1."""
        scored = self.predict_proba(rows)
        return scored.withColumn("probability", F.get("probabilities", F.lit(1))).drop("probabilities")

    def predict(self, rows: DataFrame) -> DataFrame:
        return self.transform(rows)

    def save(self, path: str) -> None:
        """Write all parts into a folder, replacing what is there."""
        self.prepare.write().overwrite().save(f"{path}/prepare")
        self.boosted.write().overwrite().save(f"{path}/boosted")
        self.neighbours.write.mode("overwrite").parquet(f"{path}/neighbours")
        self.neighbours.sparkSession.createDataFrame([(self.k,)], "k int").write.mode("overwrite").json(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EnsembleModel:
        k = spark.read.schema("k int").json(f"{path}/settings").first()["k"]
        parts = PipelineModel.load(f"{path}/prepare"), GBTClassificationModel.load(f"{path}/boosted")
        return cls(*parts, spark.read.parquet(f"{path}/neighbours"), k)


class EnsembleClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot, balance, standardise and project, then boosted trees and neighbours averaged.

    ``ids`` together tell the rows apart. ``categories`` are those of ``category`` that get a slot, all by default.
    """

    DEFAULTS = {
        "vector": "vector", "label": "label", "ids": ["id"], "category": "", "categories": [],
        "share": 0.8, "k": 21, "rounds": 200, "rate": 0.01, "depth": 6, "seed": 82,
    }

    def __init__(self, **settings):
        super().__init__()
        for name in self.DEFAULTS:
            setattr(self, name, Param(self, name, name))
        self._set(**{**self.DEFAULTS, **settings})

    def _fit(self, train: DataFrame) -> EnsembleModel:
        get = {name: self.getOrDefault(getattr(self, name)) for name in self.DEFAULTS}
        categories = get["categories"]
        if get["category"] and not categories:
            categories = category_values(train.select(get["category"]), get["category"])
        assemble = VectorWithSlots(get["vector"], get["category"], categories)
        # The balanced rows are read for the scaling, for the projection and to be projected.
        drawn = oversample(train, get["label"], get["ids"], get["seed"])
        balanced = dealt(assemble.transform(drawn), "balanced", *get["ids"], "draw")
        scale = scaling_stages(balanced)
        scaled = PipelineModel(scale).transform(balanced)
        project, _ = projection_stage(scaled, get["share"])
        ready = stored(project.transform(scaled).drop("features", "_sample_scaled", "scaled"), "training")
        boosted = GBTClassifier(
            labelCol=get["label"], featuresCol="projected", maxIter=get["rounds"], stepSize=get["rate"], maxDepth=get["depth"], seed=get["seed"]
        ).fit(rounds_of(ready))
        # Copies of a row are separate neighbours, so each training row gets its own id.
        neighbours = ready.select(
            F.xxhash64(*get["ids"], "draw").alias("_nn"), vector_to_array("projected").alias("_v"), F.col(get["label"]).alias("_y")
        )
        return EnsembleModel(PipelineModel([assemble, *scale, project]), boosted, neighbours, get["k"])


def category_values(df: DataFrame, column: str) -> list[str]:
    """The categories of a dimension, a few hundred, as text and in order."""
    return sorted(r[0] for r in df.select(F.col(column).cast("string")).distinct().collect() if r[0] is not None)


def fit_ensemble(
    train: DataFrame,
    vector: str,
    label: str,
    ids: list[str],
    category: str | None = None,
    categories: DataFrame | None = None,
    **settings,
) -> EnsembleModel:
    """`EnsembleClassifier` fitted; ``categories`` is a table of those that get a slot."""
    known = category_values(categories, category) if category and categories is not None else []
    return EnsembleClassifier(vector=vector, label=label, ids=ids, category=category or "", categories=known, **settings).fit(train)


def train_and_predict(
    train: DataFrame,
    test: DataFrame,
    vector: str,
    label: str,
    ids: str | list[str],
    category: str | None = None,
    **options,
) -> DataFrame:
    """Fit the ensemble on ``train``, with slots for the categories of both sides, and score ``test``.

    Returns the test rows' ids, label, prediction and probability of class 1.
    """
    ids = [ids] if isinstance(ids, str) else ids
    categories = common_categories(train, test, category) if category else None
    model = fit_ensemble(train, vector, label, ids, category, categories, **options)
    return model.predict(test).select(*ids, label, "prediction", "probability")


def forecast_table(
    panel: DataFrame, key: str, month: str, target: str, covariates: list[str], lags: int, step: int
) -> DataFrame:
    """One row per forecast origin: lags up to the origin and the next ``step`` values.

    ``<column>_lag0`` is the origin's own value.
    """
    columns = [target, *covariates]
    w = Window.partitionBy(key).orderBy(month)
    lagged = lag_features(panel, key, month, columns, lags - 1) if lags > 1 else panel
    own = [F.col(c).alias(f"{c}_lag0") for c in columns]
    ahead = [F.lead(target, i).over(w).alias(f"_ahead{i}") for i in range(1, step + 1)]
    return lagged.select("*", *own, *ahead)


def lag_forecast(
    panel: DataFrame,
    key: str,
    month: str,
    target: str,
    covariates: list[str],
    lags: int = 3,
    step: int = 3,
    horizon: int = 6,
    model: str = "forest",
    seed: int = 42,
) -> DataFrame:
    """Forecast the last ``horizon`` months of every series from the months before them.

    One regressor per step ahead, trained over all series on the ``lags`` last
    values of the target and the covariates. Later steps feed the forecasts back
    as target values; covariates are taken as known, so they must not be made from
    the target. Rows are taken for months: fill gaps first. Returns key, month,
    actual and predicted, which is null in a series of fewer than ``horizon + lags``
    months.
    """
    if horizon % step:
        raise ValueError("horizon must be a multiple of step")
    last = Window.partitionBy(key).orderBy(F.col(month).desc())
    panel = panel.select(key, month, F.col(target).cast("double").alias(target), *covariates)
    held = stored(panel.withColumn("_from_end", F.row_number().over(last)), "series")
    features = [f"{c}_lag{i}" for c in [target, *covariates] for i in range(lags)]
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="skip")
    known = held.where(F.col("_from_end") > horizon).drop("_from_end")
    table = forecast_table(known, key, month, target, covariates, lags, step)
    regressors = []
    for i in range(1, step + 1):
        rows = table.dropna(subset=[*features, f"_ahead{i}"])
        maker = RandomForestRegressor if model == "forest" else GBTRegressor
        fitted = Pipeline(
            stages=[
                assembler,
                maker(labelCol=f"_ahead{i}", featuresCol="_features", predictionCol=f"_step{i}", seed=seed),
            ]
        ).fit(rows)
        regressors.append(fitted)

    # Pass by pass: the target of months still to forecast is what the passes before made.
    state = held.withColumn("_value", F.when(F.col("_from_end") > horizon, F.col(target)))
    for done in range(0, horizon, step):
        origin = horizon - done + 1
        seen = state.select(key, month, "_from_end", F.col("_value").alias(target), *covariates)
        lagged = forecast_table(seen, key, month, target, covariates, lags, step)
        scored = lagged.where(F.col("_from_end") == origin).select(key, *features)
        for i, fitted in enumerate(regressors, 1):
            scored = fitted.transform(scored).drop("_features")
        steps = F.explode(
            F.array(
                *[F.struct(F.lit(origin - i).alias("at"), F.col(f"_step{i}").alias("p")) for i in range(1, step + 1)]
            )
        )
        made = scored.select(F.col(key).alias("_key"), steps.alias("_s")).select("_key", "_s.at", "_s.p")
        state = (
            state.join(made, (F.col(key) == F.col("_key")) & (F.col("_from_end") == F.col("at")), "left")
            .withColumn("_value", F.coalesce("_value", "p"))
            .drop("_key", "at", "p")
        )
    return state.where(F.col("_from_end") <= horizon).select(
        key, month, F.col(target).alias("actual"), F.col("_value").alias("predicted")
    )


def with_context(df: DataFrame, dim: DataFrame, on: str, numeric: list[str], categories: list[str]) -> DataFrame:
    """Country context: numbers as they are, categories as 0/1 columns ``<category>_<value>``.

    The values come from the dimension table, one row per country.
    """
    flags = []
    for c in categories:
        values = sorted(r[0] for r in dim.select(c).distinct().collect() if r[0] is not None)
        flags += [(F.coalesce(F.col(c) == F.lit(v), F.lit(False))).cast("int").alias(f"{c}_{v}") for v in values]
    return df.join(dim.select(on, *numeric, *flags), on, "left")
