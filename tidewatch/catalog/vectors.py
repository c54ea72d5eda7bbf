"""Mean embeddings, matrices, features and neighbours."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch import plans
from tidewatch.catalog import tables
from tidewatch.catalog.registry import query
from tidewatch.functions import arrays
from tidewatch.operators import aggregates, models, neighbour_index, neighbours
from tidewatch.operators.panel import fill_months
from tidewatch.operators.sampling import split_by_time
from tidewatch.plans import country_month_means
from tidewatch.schemas import PREDICTION_SCHEMA
from tidewatch.session import scratch_path, stored
from tidewatch.sources import read_many

WIDTH = 64


@query(
    f"""WITH {tables.EMBEDDED},
parts AS (
  SELECT CAST(date AS DATE) AS day, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS place FROM embedded)
SELECT day, CAST(place AS INT) AS place, round(avg(CAST(v AS DOUBLE)), 6) AS mean, count(*) AS n_articles
FROM parts GROUP BY ALL""",
    dates=("day",),
)
def mean_embedding_by_day(spark: SparkSession, sf: str) -> DataFrame:
    vectors = tables.embedded(spark, sf).withColumn("day", F.to_date("date"))
    means = aggregates.mean_embedding(vectors, ["day"], "embedding")
    return means.select("day", "n_articles", F.posexplode("embedding").alias("place", "mean")).withColumn(
        "mean", F.round("mean", 6)
    )


@query(
    f"""WITH {tables.JOINED},
parts AS (
  SELECT country, strftime(date, '%Y-%m') AS embedding_window, unnest(embedding) AS v,
         generate_subscripts(embedding, 1) - 1 AS place FROM located)
SELECT country, embedding_window, CAST(place AS INT) AS place, round(avg(CAST(v AS DOUBLE)), 6) AS mean,
       count(*) AS n_articles
FROM parts GROUP BY ALL"""
)
def mean_embedding_by_country_month(spark: SparkSession, sf: str) -> DataFrame:
    means = country_month_means(tables.joined_articles(spark, sf))
    return means.select(
        "country", F.col("window").alias("embedding_window"), "n_articles", F.posexplode("docembed").alias("place", "mean")
    ).withColumn("mean", F.round("mean", 6))


_WIDE = ", ".join(f'round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS "embedding-{i}"' for i in range(WIDTH))


@query(f"SELECT vec_id, {_WIDE} FROM embeddings")
def widen_embedding(spark: SparkSession, sf: str) -> DataFrame:
    wide = arrays.widen(tables.table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", WIDTH)
    columns = arrays.columns_like(wide, "embedding")
    return wide.select("vec_id", *[F.round(F.col(f"`{c}`").cast("double"), 6).alias(c) for c in columns])


@query(
    """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS place,
       round(CAST(unnest(embedding) AS DOUBLE), 6) AS v FROM embeddings"""
)
def narrow_embedding(spark: SparkSession, sf: str) -> DataFrame:
    wide = arrays.widen(tables.table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", WIDTH)
    back = arrays.narrow(wide, arrays.columns_like(wide, "embedding"), "embedding")
    exploded = back.select("vec_id", F.posexplode("embedding").alias("place", "v"))
    return exploded.withColumn("v", F.round(F.col("v").cast("double"), 6))


@query(
    f"""WITH {tables.JOINED},
parts AS (SELECT country, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS place FROM located)
SELECT country, label, CAST(place AS INT) AS place, round(sum(v), 5) AS s FROM parts GROUP BY ALL"""
)
def embedding_view(spark: SparkSession, sf: str) -> DataFrame:
    view = tables.located(spark, sf).select("docembed", "country", F.date_format("month", "yyyyMM"), "label")
    parts = view.select("country", "label", F.posexplode("docembed").alias("place", "v"))
    return parts.groupBy("country", "label", "place").agg(F.round(F.sum(F.col("v").cast("double")), 5).alias("s"))


@query(
    """WITH p AS (
  SELECT vec_id, list_concat(CAST(embedding AS DOUBLE[]), list_transform(range(16), lambda i: CAST(0 AS DOUBLE))) AS padded
  FROM embeddings)
SELECT vec_id, CAST(generate_subscripts(padded, 1) - 1 AS INT) AS place, round(unnest(padded), 6) AS v FROM p"""
)
def pad_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector as an 8 by 8 matrix, padded to 10 rows and laid flat again."""
    vectors = tables.table(spark, sf, "embeddings").select("vec_id", "embedding")
    padded = F.flatten(arrays.pad_rows(arrays.reshape("embedding", 8, 8), 10, 8))
    exploded = vectors.select("vec_id", F.posexplode(padded).alias("place", "v"))
    return exploded.withColumn("v", F.round(F.col("v").cast("double"), 6))


@query(
    """WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT vec_id, CAST(r AS INT) AS matrix_row, round(list_sum(e[r * 8 + 1 : r * 8 + 8]), 5) AS row_sum
FROM p, range(8) AS t(r)"""
)
def reshape_matrix(spark: SparkSession, sf: str) -> DataFrame:
    vectors = tables.table(spark, sf, "embeddings").select("vec_id", "embedding")
    rows = vectors.select("vec_id", F.posexplode(arrays.reshape("embedding", 8, 8)).alias("matrix_row", "r"))
    total = F.aggregate("r", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return rows.select("vec_id", "matrix_row", F.round(total, 5).alias("row_sum"))


@query(
    """WITH s AS (
  SELECT vec_id, ((0.5 + embedding[1]) + (0.5 + embedding[2])) / 2 AS p1,
         ((0.5 - embedding[1]) + (0.5 - embedding[2])) / 2 AS p0
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings))
SELECT vec_id, round(p1, 6) AS probability, CAST(CASE WHEN p1 > p0 THEN 1 ELSE 0 END AS INT) AS prediction FROM s"""
)
def ensemble_argmax(spark: SparkSession, sf: str) -> DataFrame:
    """Two scorers that lean on one component each, averaged."""
    vectors = tables.table(spark, sf, "embeddings")

    def scorer(i: int) -> DataFrame:
        x = F.get("embedding", F.lit(i)).cast("double")
        return vectors.select("vec_id", F.array(0.5 - x, 0.5 + x).alias("probabilities"))

    both = models.ensemble([scorer(0), scorer(1)], "vec_id")
    return both.select(
        "vec_id", F.round(F.get("probabilities", F.lit(1)), 6).alias("probability"), "prediction"
    )


@query(
    """WITH parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS place, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT vec_id, CAST(place AS INT) AS place,
       round((v - avg(v) OVER (PARTITION BY place)) / stddev_pop(v) OVER (PARTITION BY place), 6) AS z FROM parts"""
)
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    vectors = models.as_vector(tables.table(spark, sf, "embeddings"), "embedding")
    scaled, _ = models.standardise(vectors, vectors)
    exploded = scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("place", "z"))
    return exploded.withColumn("z", F.round("z", 6))


@query(
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label % 2 AS y FROM embeddings),
ranked AS (
  SELECT q.vec_id, t.y,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, t.v), t.vec_id) AS r
  FROM e q, e t)
SELECT vec_id, round(avg(y), 6) AS probability FROM ranked WHERE r <= 21 GROUP BY vec_id"""
)
def knn_probability(spark: SparkSession, sf: str) -> DataFrame:
    """Share of odd labels among the 21 nearest vectors, the vector itself included."""
    vectors = tables.table(spark, sf, "embeddings").withColumn("y", F.col("label") % 2)
    found = neighbours.knn_proba(vectors, vectors, 21, "vec_id", "embedding", "y")
    return found.select("vec_id", F.round("probability", 6).alias("probability"))


@query(
    """SELECT vec_id, (SELECT least(21, count(*)) FROM embeddings) AS found, true AS itself_first, true AS recall_reached
FROM embeddings""",
    flags=("itself_first", "recall_reached"),
)
def indexed_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours of every vector from a stored index: each finds itself first, and nine of ten exact neighbours are found."""
    vectors = tables.table(spark, sf, "embeddings").withColumn("y", F.col("label") % 2)
    index = neighbour_index.build_index(vectors, scratch_path(spark, "neighbour-index"), 21, "vec_id", "embedding", "y")
    found = stored(index.search(vectors, 21, None, "vec_id", "embedding"), "indexed-neighbours")
    exact = neighbours.nearest(vectors, vectors, 21, "vec_id", "embedding", "y").select("query_id", "train_id")
    met = exact.join(found.select("query_id", "train_id", F.lit(1).alias("hit")), ["query_id", "train_id"], "left")
    recall = met.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    first = F.max((F.col("distance") < 1e-9) & (F.col("rank") == 1)).alias("itself_first")
    return found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("found"), first, F.lit(recall >= 0.9).alias("recall_reached"))


@query(
    """WITH shared AS (
  SELECT source FROM documents WHERE lang = 'en' INTERSECT SELECT source FROM documents WHERE lang = 'de'),
slots AS (SELECT source AS slot, row_number() OVER (ORDER BY source) - 1 AS place FROM shared)
SELECT doc_id, CAST(place AS INT) AS place, CAST(source = slot AS DOUBLE) AS v
FROM documents, slots WHERE lang = 'de'"""
)
def one_hot_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id", "lang", "source")
    _, encoded, _ = models.one_hot(docs.where("lang = 'en'"), docs.where("lang = 'de'"), "source")
    return encoded.select("doc_id", F.posexplode("source_one_hot").alias("place", "v"))


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_FLAGS = ", ".join(f"CAST(r_name = '{r}' AS INT) AS \"r_name_{r}\"" for r in _REGIONS)


@query(
    f"""WITH {tables.PANEL},
dim AS (
  SELECT n_name, n_regionkey, top_balance, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  JOIN (SELECT c_nationkey, max(c_acctbal) AS top_balance FROM customer GROUP BY 1) ON c_nationkey = n_nationkey)
SELECT country, month, fatalities, n_regionkey, top_balance, {_FLAGS} FROM panel LEFT JOIN dim ON country = n_name""",
    dates=("month",),
)
def country_context(spark: SparkSession, sf: str) -> DataFrame:
    balance = tables.table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.max("c_acctbal").alias("top_balance")
    )
    nation = tables.table(spark, sf, "nation").withColumnRenamed("n_name", "country")
    region = tables.table(spark, sf, "region")
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(
        balance, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return models.with_context(
        tables.panel(spark, sf), dim, "country", ["n_regionkey", "top_balance"], ["r_name"]
    )


# What SQL can state of predictions: each row once with its label, probabilities in [0, 1] that agree with the
# prediction, and a share of right ones above that of the larger class.
_FACTS = f"""WITH {tables.EMBEDDED}
SELECT vec_id, CAST(embedding[1] > 0 AS DOUBLE) AS y, true AS sound, true AS learned
FROM embedded WHERE strftime(date, '%Y-%m') >= '2020-10'"""


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vectors dated before October 2020 to train on, later ones to predict.

    The given labels have nothing to do with the vectors, so the class ``y`` is the sign of the first component.
    ``kind`` has nothing to do with the class.
    """
    dated = tables.embedded(spark, sf).select(
        "vec_id",
        "embedding",
        (F.get("embedding", F.lit(0)) > 0).cast("double").alias("y"),
        (F.col("vec_id") % 5).cast("string").alias("kind"),
        F.date_format("date", "yyyy-MM").alias("target_window"),
    )
    marked = split_by_time(dated, "target_window", ["2020-10"], ["train", "test"])
    return marked.where("split = 'train'"), marked.where("split = 'test'")


def _facts(scored: DataFrame) -> DataFrame:
    held = stored(scored, "scored")
    right, ones = held.agg(F.avg((F.col("prediction") == F.col("y")).cast("double")), F.avg("y")).first()
    agrees = F.col("prediction") == (F.col("probability") > 0.5).cast("int")
    sound = F.col("probability").between(0, 1) & agrees
    return held.select("vec_id", "y", sound.alias("sound"), F.lit(right > max(ones, 1 - ones)).alias("learned"))


@query(
    f"""WITH {tables.EMBEDDED},
parts AS (
  SELECT vec_id, strftime(date, '%Y-%m') < '2020-10' AS known, CAST(unnest(embedding) AS DOUBLE) AS v,
         generate_subscripts(embedding, 1) AS place FROM embedded),
scale AS (SELECT place, avg(v) AS mean, stddev_pop(v) AS deviation FROM parts WHERE known GROUP BY 1)
SELECT vec_id, round(sum(((v - mean) / deviation) ^ 2), 4) AS squared_length, true AS reaches, false AS one_fewer_reaches
FROM parts JOIN scale USING (place) WHERE NOT known GROUP BY 1""",
    flags=("reaches", "one_fewer_reaches"),
)
def pca_80(spark: SparkSession, sf: str) -> DataFrame:
    """All components together keep each row's length; those kept for 0.8 reach it, and one fewer do not."""
    train, test = (models.as_vector(d, "embedding") for d in _split(spark, sf))
    scale = models.scaling_step(train)
    scaled = scale(train)
    _, kept = models.projection_step(scaled, 0.8)
    # No share above one is ever reached, so all components stay.
    project, _ = models.projection_step(scaled, 2.0)
    parts = project(scaled).select(F.posexplode(vector_to_array("projected")).alias("place", "v"))
    spread = parts.groupBy("place").agg(F.var_pop("v").alias("v")).agg(
        F.sum("v").alias("all"),
        F.sum(F.when(F.col("place") < kept, F.col("v"))).alias("kept"),
        F.sum(F.when(F.col("place") < kept - 1, F.col("v"))).alias("fewer"),
    ).first()
    square = F.aggregate(vector_to_array("projected"), F.lit(0.0), lambda total, x: total + x * x)
    return project(scale(test)).select(
        "vec_id",
        F.round(square, 4).alias("squared_length"),
        F.lit(spread["kept"] >= 0.8 * spread["all"]).alias("reaches"),
        F.lit((spread["fewer"] or 0) >= 0.8 * spread["all"]).alias("one_fewer_reaches"),
    )


@query(_FACTS, flags=("sound", "learned"))
def boosted_predictions(spark: SparkSession, sf: str) -> DataFrame:
    train, test = (models.as_vector(d, "embedding") for d in _split(spark, sf))
    scored = models.boosted_classifier(train, test, "y", "features")
    return _facts(scored.withColumn("probability", F.get("probabilities", F.lit(1))))


@query(_FACTS, flags=("sound", "learned"))
def dense_network_predictions(spark: SparkSession, sf: str) -> DataFrame:
    train, test = models.standardise(*(models.as_vector(d, "embedding") for d in _split(spark, sf)))
    scored = models.dense_classifier(train, test, "y", "scaled")
    return _facts(scored.withColumn("probability", F.get("probabilities", F.lit(1))))


@query(_FACTS, flags=("sound", "learned"))
def ensemble_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """One-hot, balance, standardise, project, then boosted trees and neighbours averaged, on the vectors as they are."""
    train, test = _split(spark, sf)
    return _facts(models.train_and_predict(train, test, "embedding", "y", "vec_id", "kind"))


_DATASET = f"""WITH {tables.JOINED}, {tables.LABELLED},
months AS (
  SELECT DISTINCT country, strftime(date, '%Y-%m') AS embedding_window,
         strftime(month + INTERVAL 2 MONTH, '%Y-%m') AS target_window FROM located),
spikes AS (SELECT DISTINCT country, strftime(month, '%Y-%m') AS target_window, spike AS lagged_spike FROM labels_by_code)"""


@query(
    _DATASET
    + """
SELECT country AS fips, embedding_window, target_window, lagged_spike, true AS sound
FROM months JOIN spikes USING (country, target_window) WHERE target_window >= '2020-10' AND lagged_spike IS NOT NULL""",
    flags=("lagged_spike", "sound"),
)
def spike_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """From articles and labels to a file of predictions, read back."""
    path = scratch_path(spark, "spike-predictions")
    means = country_month_means(tables.joined_articles(spark, sf))
    dataset = plans.spike_dataset(means, tables.labels_by_code(spark, sf), ["2020-10"])
    plans.predict_spikes(dataset, path)
    made = read_many(spark, f"{path}/*.csv", PREDICTION_SCHEMA)
    p = F.col("probabilities")
    sound = p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("int"))
    return made.select("fips", "embedding_window", "target_window", "lagged_spike", sound.alias("sound"))


@query(
    f"""WITH {tables.JOINED},
parts AS (
  SELECT country, strftime(date, '%Y-%m') AS embedding_window, unnest(embedding) AS v,
         generate_subscripts(embedding, 1) - 1 AS place FROM located)
SELECT country, embedding_window, CAST(place AS INT) AS place, round(avg(CAST(v AS DOUBLE)), 6) AS mean FROM parts GROUP BY ALL"""
)
def country_mean_files(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly means as one CSV folder per country, read back."""
    path = scratch_path(spark, "country-means")
    plans.country_mean_files(tables.joined_articles(spark, sf), path, WIDTH)
    wide = spark.read.csv(path, header=True)
    back = arrays.narrow(wide, arrays.columns_like(wide, "docembed"), "docembed")
    parts = back.select("country", F.col("window").alias("embedding_window"), F.posexplode("docembed").alias("place", "mean"))
    return parts.withColumn("mean", F.round(F.col("mean").cast("double"), 6))


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    """The panel, with the orders of the next priority as a covariate that is not made from the target."""
    other = tables.panel(spark, sf, "2-HIGH", "others")
    return tables.panel(spark, sf).join(other, ["country", "month"])


@query(
    f"""WITH {tables.PANEL},
ends AS (SELECT country, CAST(min(month) AS TIMESTAMP) AS a, CAST(max(month) AS TIMESTAMP) AS b FROM panel GROUP BY 1),
held AS (
  SELECT country, CAST(unnest(generate_series(greatest(a, b - INTERVAL 5 MONTH), b, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM ends)
SELECT country, month, CAST(coalesce(fatalities, 0) AS DOUBLE) AS actual, true AS in_range
FROM held LEFT JOIN panel USING (country, month)""",
    dates=("month",),
    flags=("in_range",),
)
def lag_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """The last six months of every series; a forest stays within the values it has seen."""
    filled = fill_months(_counts(spark, sf), "country", "month", ["fatalities", "others"])
    most = tables.panel(spark, sf).agg(F.max("fatalities")).first()[0]
    made = models.lag_forecast(filled, "country", "month", "fatalities", ["others"])
    return made.select("country", "month", "actual", F.col("predicted").between(-1e-9, most + 1e-9).alias("in_range"))


@query(
    f"""WITH {tables.PANEL},
ends AS (SELECT country, CAST(min(month) AS TIMESTAMP) AS a, CAST(max(month) AS TIMESTAMP) AS b FROM panel GROUP BY 1),
months AS (SELECT country, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM ends),
filled AS (SELECT country, month, coalesce(fatalities, 0) AS y FROM months LEFT JOIN panel USING (country, month)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY month DESC) AS r, count(*) OVER (PARTITION BY country) AS n FROM filled),
naive AS (
  SELECT country, max(n) AS n, avg(abs(y - last)) FILTER (r <= 6) AS mae
  FROM (SELECT *, max(y) FILTER (r = 7) OVER (PARTITION BY country) AS last FROM placed) GROUP BY 1),
most AS (SELECT max(y) AS y FROM filled)
SELECT count(*) AS series, count(*) FILTER (n < 9) AS skipped, round(avg(mae) FILTER (n >= 9), 6) AS naive_mae,
       true AS in_range, true AS better_than_naive
FROM naive""",
    flags=("in_range", "better_than_naive"),
)
def forecast_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every country of the panel, with all of its months, against the last value known."""
    counts = _counts(spark, sf)
    scores = plans.forecast_scores(counts, "fatalities", ["others"])
    filled = fill_months(counts, "country", "month", ["fatalities"])
    known = Window.partitionBy("country")
    placed = filled.withColumn("r", F.row_number().over(known.orderBy(F.col("month").desc()))).withColumn("n", F.count("*").over(known))
    last = F.max(F.when(F.col("r") == 7, F.col("fatalities"))).over(known)
    errors = placed.withColumn("off", F.abs(F.col("fatalities") - last)).where((F.col("r") <= 6) & (F.col("n") >= 9))
    naive = errors.groupBy("country").agg(F.avg("off").alias("mae")).agg(F.avg("mae").alias("naive_mae"))
    most = F.lit(filled.agg(F.max("fatalities")).first()[0])
    mae = F.col("mean_mae")
    return scores.crossJoin(naive).select(
        "series", "skipped", F.round("naive_mae", 6).alias("naive_mae"),
        mae.between(0, most).alias("in_range"), (mae < F.col("naive_mae")).alias("better_than_naive"),
    )
