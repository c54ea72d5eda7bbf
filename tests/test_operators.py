import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import aggregates, joins, metrics, neighbour_index, neighbours, ranking, samples, sampling, tagging


def test_top_countries_edge_cases(spark):
    many = ";".join(f"1#Land{i}#{chr(65 + i)}{chr(65 + i)}#x" for i in range(12))
    rows = [(1, None), (2, "2#Town, Land#US#x"), (3, "1#A#AA#;1#A#AA#"), (4, many)]
    df = tagging.top_countries(spark.createDataFrame(rows, "id int, V2Locations string"), with_list=True)
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["country-1"] is None and got[1]["num_countries"] == 0
    assert got[2]["country-1"] is None and got[2]["num_countries"] == 0
    assert (got[3]["country-1"], got[3]["country-2"], got[3]["num_countries"]) == ("AA", None, 1)
    assert [got[4][f"country-{i}"] for i in (1, 2, 3)] == ["AA", "BB", "CC"] and got[4]["num_countries"] == 12
    assert tagging.explode_countries(df).count() == 4
    assert tagging.drop_unlocated(df).count() == 2
    assert df.where(tagging.mentions("CC")).count() == 1
    assert df.where(~tagging.mentions("CC")).count() == 3


def test_join_articles_needs_the_same_day(spark):
    articles = spark.createDataFrame(
        [("u1", "2020-01-01"), ("u2", "2020-01-01"), (None, "2020-01-01")], "DocumentIdentifier string, day string"
    )
    vectors = spark.createDataFrame(
        [("u1", "2020-01-01"), ("u1", "2020-01-02"), ("u2", "2020-01-03"), (None, "2020-01-01")], "url string, day string"
    ).withColumn("date", F.to_timestamp("day"))
    got = joins.join_articles(articles, vectors).collect()
    assert [(r["DocumentIdentifier"], r["year"], r["month"], r["yearmonth"]) for r in got] == [("u1", 2020, 1, "202001")]


def test_label_months_for_the_golden_case(spark):
    label = spark.createDataFrame([(datetime.date(2020, 1, 1),)], "month date")
    months = [r[0] for r in joins.label_months(label, "month", 2, 1).select("feature_month").collect()]
    assert months == [datetime.date(2019, 11, 1)]
    three = joins.label_months(label, "month", 2, 3).select("feature_month").collect()
    assert sorted(r[0] for r in three) == [datetime.date(2019, 9, 1), datetime.date(2019, 10, 1), datetime.date(2019, 11, 1)]


def test_dedup_keeps_one_null_key_and_ignores_partitioning(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), (None, 2, "z"), (None, 1, "w"), ("b", 1, "v")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    for parts in (1, 5):
        first = aggregates.dedup(df.repartition(parts), ["k"], [F.col("o")])
        last = aggregates.dedup(df.repartition(parts), ["k"], [F.col("o")], keep="last")
        assert {(r["k"], r["v"]) for r in first.collect()} == {("a", "y"), (None, "w"), ("b", "v")}
        assert {(r["k"], r["v"]) for r in last.collect()} == {("a", "x"), (None, "z"), ("b", "v")}


def test_mean_embedding_equals_the_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "hot" if i % 3 else f"k{i}", rng.normal(size=5).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k string, docembed array<double>").repartition(7)
    for r in aggregates.mean_embedding(df, ["k"]).collect():
        want = [v for _, k, v in rows if k == r["k"]]
        assert r["n_articles"] == len(want)
        assert np.allclose(r["docembed"], np.mean(want, axis=0))


def test_min_support_and_null_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 2), ("b", 1)], "k string, v int")
    assert {r["k"] for r in aggregates.min_support(df, "k", 2).collect()} == {"a"}
    profile = {r["column"]: (r["n_rows"], r["nulls"], r["null_share"]) for r in aggregates.null_profile(df).collect()}
    assert profile == {"k": (4, 0, 0.0), "v": (4, 1, 0.25)}
    exact = aggregates.nunique(df, ["k", "v"]).first()
    rough = aggregates.nunique(df, ["k", "v"], approximate=True).first()
    assert tuple(exact) == (2, 2) == tuple(rough)


def test_expectation(spark):
    counted, seen = aggregates.expect_rows(spark.range(5), "five")
    counted.write.format("noop").mode("overwrite").save()
    assert aggregates.assert_rows(seen, "five") == 5
    empty, seen = aggregates.expect_rows(spark.range(0), "none")
    empty.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        aggregates.assert_rows(seen, "none")


def rank_sum_auc(y, p):
    pos = [b for a, b in zip(y, p) if a]
    neg = [b for a, b in zip(y, p) if not a]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_auc_with_ties_and_a_hot_score(spark, ranges):
    rng = np.random.default_rng(3)
    p = np.where(rng.random(400) < 0.4, 0.5, rng.integers(0, 50, 400) / 50)
    y = rng.random(400) < p
    df = spark.createDataFrame([(bool(a), float(b)) for a, b in zip(y, p)], "y boolean, p double").repartition(6)
    got = metrics.roc_auc(df, "y", "p", ranges).first()
    assert got["roc_auc"] == pytest.approx(rank_sum_auc(y, p))


def test_auc_with_infinite_scores(spark):
    inf = float("inf")
    rows = [(True, inf), (True, inf), (False, -inf), (False, 0.0), (True, 1.0), (False, inf)]
    df = spark.createDataFrame(rows, "y boolean, p double")
    got = metrics.roc_auc(df, "y", "p", 8).first()["roc_auc"]
    assert got == pytest.approx(rank_sum_auc(*zip(*rows)))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(True, 0.1), (True, 0.4), (None, 0.2), (False, None)], "y boolean, p double")
    assert metrics.roc_auc(df, "y", "p").first()["roc_auc"] is None


def test_binary_metrics_of_a_never_firing_model(spark):
    df = spark.createDataFrame([(True, False), (False, False)], "y boolean, p boolean")
    got = metrics.binary_metrics(df, "y", "p").first()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"], got["kappa"]) == (0.0, 0.0, 0.0, 0.5, 0.0)


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_bucket_rows_is_ntile(spark, ranges):
    ids = [int(i) ** 2 for i in range(101)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(5)
    got = {r["id"]: r["bucket"] for r in sampling.bucket_rows(df, "id", 12, ranges=ranges).collect()}
    want = {}
    for b, part in enumerate(np.array_split(sorted(ids), 12), 1):
        want.update({int(i): b for i in part})
    assert got == want


def test_bucket_rows_with_fewer_rows_than_buckets(spark):
    got = sampling.bucket_rows(spark.range(5), "id", 12).orderBy("id").collect()
    assert [r["bucket"] for r in got] == [1, 2, 3, 4, 5]


def hot_groups(spark):
    """Half of all rows share one key, some have none."""
    key = "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 10 <> 7 THEN concat('k', id % 10) END AS k"
    return spark.range(500).selectExpr("id", key, "timestamp_seconds(id * 60) AS date")


def test_rank_in_group_does_not_depend_on_how_it_is_spread(spark):
    df = hot_groups(spark)
    whole = ranking.rank_in_group(df, ["k"], ["id"], 4, ranges=1)
    spread = ranking.rank_in_group(df.repartition(9), ["k"], ["id"], 4, ranges=16)
    assert spread.count() == 500
    assert whole.select("id", "rank0").exceptAll(spread.select("id", "rank0")).count() == 0
    per_key = spread.groupBy("k").agg(F.count("*").alias("n"), F.max("rank0").alias("m"), F.count_distinct("rank0").alias("d"))
    assert all(r["n"] == r["m"] + 1 == r["d"] for r in per_key.collect())


def vectors(spark, sizes):
    rows = [(f"{k}-{i}", k, i, [float(i + 1), 2.0]) for k, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "url string, country string, i int, docembed array<float>").withColumn(
        "date", F.timestamp_seconds(F.col("i") * 60)
    )


def test_article_samples_of_49_50_51_and_100(spark):
    sizes = {"a": 49, "b": 50, "c": 51, "d": 100, "e": 1}
    df = vectors(spark, sizes).repartition(4)
    plain = samples.article_samples(df, ["country"], 50, 4, 2)
    spread = samples.article_samples(df, ["country"], 50, 4, 2, ranges=13)
    for made in (plain, spread):
        rows = made.collect()
        per_key = {k: [r for r in rows if r["country"] == k] for k in sizes}
        assert {k: len(v) for k, v in per_key.items()} == {"a": 1, "b": 1, "c": 1, "d": 2, "e": 1}
        for k, groups in per_key.items():
            ids = [i for g in groups for i in g["article_ids"]]
            assert len(ids) == len(set(ids)) == (min(sizes[k], 50) if sizes[k] < 50 else sizes[k] // 50 * 50)
            for g in groups:
                assert len(g["embeddings"]) == 100 and (g["height"], g["width"]) == (50, 2)
                order = [int(i.split("-")[1]) for i in g["article_ids"]]
                assert order == sorted(order)
                assert g["embeddings"][: 2 * len(order) : 2] == [float(i + 1) for i in order]
                assert not any(g["embeddings"][2 * len(order) :])
    assert plain.exceptAll(spread).count() == 0


def test_labelled_samples_and_failures(spark):
    articles = vectors(spark, {"a": 7}).withColumn("date", F.to_timestamp(F.lit("2019-11-15 00:00:00")))
    labels = spark.createDataFrame(
        [("a", datetime.date(2020, 1, 1), True), ("a", datetime.date(2020, 2, 1), True)], "country string, month date, y boolean"
    )
    made = samples.labelled_samples(articles, labels, "y", 5, 2, 4)
    assert [(str(r["target_month"]), r["label"], r["n_articles"]) for r in made.collect()] == [("2020-01-01", 1, 5)]
    wanted = labels.select("country", F.col("month").alias("target_month"))
    failed = samples.failed_keys(wanted, made, ["country", "target_month"]).collect()
    assert [r["message"] for r in failed] == ["no sample for a_2020-02-01"]


def test_both_feeds_keep_the_same_granules(spark):
    stamps = spark.range(400).selectExpr("date_format(timestamp_seconds(id * 900), 'yyyyMMddHHmmss') AS granule")
    one = sampling.sample_granules(stamps.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))), "granule").select("granule").distinct()
    two = sampling.sample_granules(stamps.withColumnRenamed("granule", "g"), "g")
    assert one.exceptAll(two).count() == 0 and one.count() == two.count() > 0


def test_oversample_balances_and_keeps_everything(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id < 9 THEN 1 WHEN id < 30 THEN 2 ELSE 0 END AS y")
    one = sampling.oversample(df, "y", ["id"], 82)
    two = sampling.oversample(df.repartition(6), "y", ["id"], 82, ranges=5)
    assert {r["y"]: r["count"] for r in one.groupBy("y").count().collect()} == {0: 70, 1: 70, 2: 70}
    assert one.where("draw = 0").drop("draw").exceptAll(df).count() == 0
    assert one.exceptAll(two).count() == 0
    assert sampling.oversample(df.where("y = 0"), "y", ["id"], 82).count() == 70


def test_sample_n(spark):
    df = hot_groups(spark)
    assert sampling.sample_n(df, 10, 1, ["id"]).exceptAll(sampling.sample_n(df.repartition(5), 10, 1, ["id"])).count() == 0
    per = sampling.sample_n(df, 3, 1, ["id"], by="k").groupBy("k").count().collect()
    assert {r["count"] for r in per} == {3}
    assert sampling.permute(df, 1, ["id"]).count() == 500


def test_split_by_time(spark):
    df = spark.createDataFrame([("2022-09",), ("2022-10",), ("2023-01",)], "w string")
    got = sampling.split_by_time(df, "w", ["2022-10", "2023-01"]).collect()
    assert [r["split"] for r in got] == ["train", "validation", "test"]
    with pytest.raises(ValueError):
        sampling.split_by_time(df, "w", ["2022-10"], ["one"])


def brute_force(train, queries, k):
    found = {}
    for qid, q in queries:
        ranked = sorted((float(np.sqrt(((np.array(t) - np.array(q)) ** 2).sum())), tid) for tid, t in train)
        found[qid] = [tid for _, tid in ranked[:k]]
    return found


@pytest.mark.parametrize("pivots,spread,block", [(1, 1, 2048), (5, 3, 7), (64, 2, 16)])
def test_nearest_is_exact(spark, monkeypatch, pivots, spread, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    # A third of the rows in one tight cluster, some exact copies, some far out.
    base = np.concatenate([rng.normal(0, 0.01, (100, 6)), rng.normal(0, 3, (150, 6)), rng.normal(40, 1, (50, 6))])
    base[10:20] = base[9]
    train = [(i, v.tolist()) for i, v in enumerate(base)]
    asked = [(1000 + i, v.tolist()) for i, v in enumerate(np.concatenate([base[:30], rng.normal(0, 5, (40, 6))]))]
    t = spark.createDataFrame([(i, v, i % 2) for i, v in train], "id bigint, embedding array<double>, label int")
    q = spark.createDataFrame(asked, "id bigint, embedding array<double>")
    got = {}
    for r in neighbours.nearest(t.repartition(4), q.repartition(3), 7, pivots=pivots, spread=spread).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["train_id"])
    assert got == brute_force(train, asked, 7)


def test_nearest_with_fewer_rows_than_k(spark):
    t = spark.createDataFrame([(1, [0.0], 1), (2, [1.0], 0)], "id bigint, embedding array<double>, label int")
    found = neighbours.knn_proba(t, t, 21)
    assert {r["id"]: r["probability"] for r in found.collect()} == {1: 0.5, 2: 0.5}
    assert neighbours.nearest(t.where("id > 5"), t, 3).count() == 0


def test_compare_models(spark):
    a = spark.createDataFrame(
        [("x", "1_x", True, True), ("x", "2_x", True, False), ("x", "2_x", True, False), ("y", "1_y", True, True)],
        "country string, country_ym string, truth boolean, predicted boolean",
    )
    b = spark.createDataFrame([("1_x", 1, 1), ("2_x", 1, 1)], "country_ym string, truth int, predicted int")
    manifest = spark.createDataFrame([("1_x", 10), ("1_x", 10)], "country_ym string, count bigint")
    got = metrics.compare_models(a, b, manifest).collect()
    assert [tuple(r) for r in got] == [("x", 2, 10, 0.5, 1.0)]


def test_dedup_of_ties_does_not_depend_on_partitions(spark):
    rows = [(f"k{i % 3}", 1, f"v{i}", [float(i)]) for i in range(60)]
    kept = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "k string, o int, v string, e array<double>").repartition(parts, "v")
        kept.add(tuple(sorted(map(str, aggregates.dedup(df, ["k"], [F.col("o")]).collect()))))
    assert len(kept) == 1


def test_binary_metrics_of_billions(spark):
    n = 10**10
    counted = spark.createDataFrame([(n, n, n, n)], "tp bigint, fp bigint, fn bigint, tn bigint")
    made = metrics.scores_of_counts(counted).first()
    assert made["accuracy"] == 0.5 and made["kappa"] == 0 and made["tp"] == n


@pytest.mark.parametrize("bad", [{"k": 0}, {"pivots": 0}, {"pivots": 5000}, {"spread": 0}])
def test_nearest_refuses_bad_parameters(spark, bad):
    t = spark.createDataFrame([(1, [1.0], 0)], "id bigint, embedding array<double>, label int")
    with pytest.raises(ValueError):
        neighbours.nearest(t, t, **bad)


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1.0, 1e4), (1e-25, 0.0), (1e18, 0.0), (1e-3, 1.0)])
@pytest.mark.parametrize("bounded", [True, False])
def test_blocks_are_compared_in_cache_and_none_is_lost(monkeypatch, scale, shift, bounded):
    rng = np.random.default_rng(3)
    t, q = (rng.normal(size=(n, 9)) * scale + shift for n in (700, 90))
    far = np.sqrt(((q[:, None, :] - t[None, :, :]) ** 2).sum(2))
    monkeypatch.setattr(neighbours, "CACHE_BYTES", 8 * 700 * 11, raising=False)
    compared, plain = [], neighbours._Best._add
    monkeypatch.setattr(neighbours._Best, "_add", lambda self, t, *a: (compared.append(len(t) * len(a[2])), plain(self, t, *a)))
    bound = neighbours._kth_distance(q, t[:200], 5) * (1 + 1e-6) if bounded else np.full(90, np.inf)
    best = neighbours._Best(np.arange(90), q, bound, 5)
    for at in (0, 350):
        best.add(t[at : at + 350], np.arange(at, at + 350), np.zeros(350))
    found = best.frame()
    assert 8 * max(compared) <= 2 * neighbours.CACHE_BYTES
    order = np.argsort(far, axis=1, kind="stable")[:, :5]
    assert found["train_id"].to_numpy().reshape(90, 5).tolist() == order.tolist()
    assert np.allclose(found["distance"].to_numpy().reshape(90, 5), np.take_along_axis(far, order, 1), rtol=1e-12, atol=0)


def test_nearest_works_in_slices(monkeypatch):
    rng = np.random.default_rng(6)
    vectors, sample = rng.normal(size=(50, 4)), rng.normal(size=(30, 4))
    whole = neighbours._kth_distance(vectors, sample, 5)
    monkeypatch.setattr(neighbours, "SLICE_BYTES", 8 * 30 * 7)
    assert np.allclose(neighbours._kth_distance(vectors, sample, 5), whole)
    assert np.allclose(np.sort(neighbours._distances(vectors, sample), axis=1)[:, 4], whole)
    assert np.isinf(neighbours._kth_distance(vectors, sample, 31)).all()


def test_mean_embedding_of_ragged_vectors_and_null_keys(spark, monkeypatch, capsys):
    monkeypatch.setattr(aggregates, "HELD", 2)
    rng = random.Random(1)
    rows = []
    for _ in range(2000):
        vector = None if rng.random() < 0.05 else [None if rng.random() < 0.1 else rng.uniform(-5, 5) for _ in range(rng.choice([0, 3, 3, 5]))]
        rows.append((rng.choice([None, "a", "b", "hot", "hot"]), rng.choice([1, 2, None]), vector))
    df = spark.createDataFrame(rows, "k string, `m-x` int, docembed array<float>").repartition(6)
    made = aggregates.mean_embedding(df, ["k", "m-x"])
    got = {(r[0], r[1]): (r[2], r[3]) for r in made.collect()}
    groups = {}
    for k, m, vector in rows:
        if vector:
            groups.setdefault((k, m), []).append(vector)
    assert set(got) == set(groups)
    for key, vectors in groups.items():
        mean, n = got[key]
        assert len(mean) == max(map(len, vectors)) and n == max(sum(len(v) > i for v in vectors) for i in range(len(mean)))
        for i, value in enumerate(mean):
            known = [float(np.float32(v[i])) for v in vectors if len(v) > i and v[i] is not None]
            assert (value is None and not known) or abs(value - sum(known) / len(known)) < 1e-9
    aggregates.mean_embedding(df, ["k", "m-x"]).explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert aggregates.mean_embedding(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_located_winners_equal_those_of_whole_rows(spark, tmp_path, capsys, keep, broadcast):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b", "hot"]), rng.choice([None, 1, 2]), rng.choice([None, 3, 4]), [rng.random()] * 4) for _ in range(500)]
    rows += rows[:50]
    spark.createDataFrame(rows, "k string, `k-2` int, o int, v array<double>").repartition(5).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        made = aggregates.dedup_located(df, ["k", "k-2"], [F.col("o")], keep)
        assert made.columns == df.columns
        whole = aggregates.dedup(df, ["k", "k-2"], [F.col("o")], keep).select(*[F.col(f"`{c}`") for c in df.columns])
        assert sorted(map(str, made.collect())) == sorted(map(str, whole.collect()))
        made.join(made.select("k", F.col("`k-2`").alias("z")).distinct(), "k").explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Nothing wide is aggregated.
    assert all("min(v" not in line and "_row" not in line for line in capsys.readouterr().out.splitlines() if "SortAggregate" in line)
    assert aggregates.dedup_located(df.where("k = 'none'"), ["k"], [F.col("o")]).count() == 0


def test_any_number_of_countries(spark):
    many = ";".join(f"1#Land{i}#{chr(65 + i)}{chr(65 + i)}#x" for i in range(12))
    df = tagging.top_countries(spark.createDataFrame([(1, many), (2, "1#A#AA#"), (3, None)], "id int, V2Locations string"), n=5)
    assert df.columns[-5:] == [f"country-{i}" for i in range(1, 6)]
    assert tagging.explode_countries(df).where("id = 1").select("country", "country_idx").collect()[-1] == ("EE", 5)
    assert [r["id"] for r in df.where(tagging.mentions("EE", 5)).collect()] == [1]
    assert df.where(~tagging.mentions("EE", 5)).count() == 2
    assert {r["country"] for r in tagging.seen_countries(df).collect()} == {"AA", "BB", "CC", "DD", "EE"}


def recall_of(found, exact):
    mine = {(r["query_id"], r["train_id"]) for r in found.collect()}
    theirs = {(r["query_id"], r["train_id"]) for r in exact.collect()}
    return len(mine & theirs) / len(theirs)


def test_neighbour_index_of_structured_vectors(spark, tmp_path):
    """Three thousand vectors around sixty centres: nine of ten neighbours for a tenth of the pairs."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(60, 16)) * 4
    points = centre[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 16))
    rows = [(i, p.tolist(), float(i % 2)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<double>, label double").repartition(5)
    asked = df.where("id % 10 = 0")
    neighbour_index.build_index(df, f"{tmp_path}/index")
    index = neighbour_index.NeighbourIndex.load(spark, f"{tmp_path}/index")
    exact = neighbours.nearest(df, asked, 21)
    found = index.search(asked, 21)
    assert recall_of(found, exact) >= 0.9
    assert index.compared(asked) <= 0.1 * asked.count() * df.count()
    # Visiting all cells is the exact way, and distances are exact.
    whole = index.search(asked, 21, probes=len(index.centres))
    assert recall_of(whole, exact) == 1.0
    key = lambda r: (r["query_id"], r["rank"])
    for a, b in zip(sorted(whole.collect(), key=key), sorted(exact.collect(), key=key)):
        assert a["train_id"] == b["train_id"] and abs(a["distance"] - b["distance"]) < 1e-9 and a["label"] == b["label"]


def test_neighbour_index_of_few_and_equal_rows(spark, tmp_path):
    few = spark.createDataFrame([(1, [0.0, 0.0], 1.0), (2, [0.0, 0.0], 0.0), (3, [5.0, 5.0], 1.0)], "id bigint, embedding array<double>, label double")
    index = neighbour_index.build_index(few, f"{tmp_path}/few")
    assert [(r["train_id"], r["rank"]) for r in index.search(few.where("id = 1"), 2, probes=9).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    empty = neighbour_index.build_index(few.limit(0), f"{tmp_path}/none")
    assert empty.search(few).count() == 0
    assert index.search(few.limit(0)).count() == 0


def test_vectors_travel_a_few_times(spark, tmp_path):
    """A query goes once to each shard, not to each cell; a training row once to each part of the queries."""
    rng = np.random.default_rng(9)
    points = rng.normal(size=(2500, 8))
    rows = [(i, p.tolist(), float(i % 2)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<float>, label double").repartition(3)
    index = neighbour_index.build_index(df, f"{tmp_path}/index", 5, cells=40)
    assert sorted(r["cell"] for r in index.blocks.select("cell").collect()) == sorted(set(range(40)))
    asked = neighbours.plain_vector(df, "embedding").alias("_vec")
    first, last = neighbours.cell_shards(index._held(), 3)
    sent = index._sent(df.select(F.col("id").alias("_id"), asked), 40, first, last)
    assert sent.agg(F.sum(F.size("q_ids"))).first()[0] == 3 * 2500
    # Several shards and parts, a few of them in one task.
    exact = {(r["query_id"], r["rank"]): r["train_id"] for r in neighbours.nearest(df, df, 5).collect()}
    for found in (index.search(df, 5, probes=40, spread=5), neighbours.nearest(df, df, 5, spread=7), index.search(df, 5, probes=40)):
        assert {(r["query_id"], r["rank"]): r["train_id"] for r in found.collect()} == exact


@pytest.mark.parametrize("queries, train, tasks", [(1, 10, 200), (600_000, 600_000, 200), (1000, 10**6, 200), (10**6, 1000, 12)])
def test_grid_of_shards_and_parts(queries, train, tasks):
    shards, parts = neighbours.grid(queries, train, 64, 21, tasks)
    blocks = lambda n: -(-n // neighbours.BLOCK_ROWS)
    assert min(tasks, blocks(queries) * blocks(train)) <= shards * parts < 2 * tasks
    # Far less than the 200 copies of each query that one part for each task would need.
    assert shards * queries + parts * train <= 45 * (queries + train)
    first, last = neighbours.cell_shards(np.array([5, 0, 90, 5]), shards)
    assert first[0] == 0 and last[-1] == shards - 1 and (first <= last).all() and (first[1:] - last[:-1] <= 1).all()
