"""Phrase mining against counting everything in plain Python, and against SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tidewatch.llm import catalog, collocations


def pieces_of(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [[w for w in re.split(r"[ \t]+", piece) if w] for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text)]


def counted(rows, longest=4):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in pieces_of(text):
            n[lang] += len(piece)
            for size in range(1, longest + 1):
                for i in range(len(piece) - size + 1):
                    f[lang, tuple(piece[i : i + size])] += 1
    return f, n


def brute(rows, support=30, longest=4, best=2000):
    f, n = counted(rows, longest)
    found = {g: a for g, a in f.items() if a >= support and len(g[1]) > 1}
    out = {}
    for (lang, w), a in found.items():
        longer = [
            b for (other, v), b in found.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
        ]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    rows = []
    for lang, mine in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:best], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def some_rows(seed, docs=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "São", "paulo", "new", "york", "x-y", "日本", "\x85", "u v".replace(" ", " ")]
    glue = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "; ", "!", " \r "]
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.choice([0, 1, 5, 30, 60])))
        rows.append((text + rng.choice(["", "new york city hall", "New York City", "ends here."]), rng.choice(["en", "fr", None, "und", "e n"])))
    return rows + [("", "en"), (None, "fr"), ("a " * 3000, "de"), (" \t ", None), rows[0], rows[0]]


@pytest.mark.parametrize("seed, support, share", [(1, 30, 1 / 16), (2, 5, 0.5), (3, 12, 1e-9), (4, 2, 1.0)])
def test_all_phrases_whatever_the_sample(documents, seed, support, share):
    """An empty sample makes the border fail again and again; the whole table as a sample makes it hold at once."""
    rows = some_rows(seed)
    docs = documents([(1, t, lang) for t, lang in rows]).withColumns({"phrase": F.lit(1), "n": F.lit("x"), "first": F.lit(0)})
    found, totals = collocations.phrases(docs, support, 4, share)
    f, n = counted(rows)
    made = [((r.lang, tuple(r.phrase.split(" "))), r.a) for r in found.collect()]
    assert len(made) == len(set(made)) and dict(made) == {g: a for g, a in f.items() if a >= support}
    assert {r.lang: r.n for r in totals.collect()} == {lang: n.get(lang, 0) for lang in {x or "und" for _, x in rows}}


@pytest.mark.parametrize("seed, support, best", [(5, 30, 2000), (6, 3, 7)])
def test_best_collocations(documents, seed, support, best):
    rows = some_rows(seed, 200)
    made = collocations.best_collocations(documents([(i, t, lang) for i, (t, lang) in enumerate(rows)]), best, support=support)
    assert sorted(tuple(r) for r in made.collect()) == brute(rows, support, best=best)


def test_many_batches_and_full_bits(documents, monkeypatch):
    monkeypatch.setattr(collocations, "GATHERED", 50)
    monkeypatch.setattr(collocations.Bits, "has", lambda self, first: np.ones(len(first), dtype=bool))
    rows = some_rows(7, 100)
    found, _ = collocations.phrases(documents([(1, t, lang) for t, lang in rows]), 6, 4, 0.1)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.a for r in found.collect()} == {g: a for g, a in counted(rows)[0].items() if a >= 6}


def test_missed_phrases_are_those_without_bits(spark):
    """Filtered in the step that folds them: a task with two such steps keeps two Python workers."""
    shape = "h1 bigint, h2 bigint, h3 bigint, h4 bigint, n bigint"
    rows = [(i, 0, 0, 9, 1) for i in range(1, 200)]
    known = spark.sparkContext.broadcast(collocations.bits_of(spark.createDataFrame(rows[:150], shape), 24))
    assert not collocations.bits_of(spark.createDataFrame(rows[:150], shape), 24, known).data.any()
    missed = collocations.bits_of(spark.createDataFrame(rows, shape), 24, known)
    assert (missed.data == collocations.bits_of(spark.createDataFrame(rows[150:], shape), 24).data).all()


def test_tables_of_a_pass_are_few_files(spark):
    """Files go by the bytes that are left, not by those that were counted."""
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    with collocations.scoped_conf(spark, settings):
        left = spark.range(200_000).groupBy(F.xxhash64("id").alias("k")).agg(F.sum("id").alias("n")).where("n % 1000 = 0")
        many, few = collocations.stored(left, "many"), collocations._few_files(left, "few")
        assert len(few.inputFiles()) == 1 < len(many.inputFiles())
        assert sorted(few.collect()) == sorted(many.collect())


def test_products_beyond_64_bits(spark):
    """Counts of 10**13 give the exact floor."""
    row = spark.range(1).select(F.expr(
        "cast(2000000 as decimal(38,0)) * 9999999999999 div (cast(20000000000001 as decimal(38,0)) + 10000000000007)"
    )).first()[0]
    assert row == 2000000 * 9999999999999 // (20000000000001 + 10000000000007)


def test_odd_tables_and_settings(documents):
    assert collocations.best_collocations(documents([])).count() == 0
    assert collocations.best_collocations(documents([(1, None), (2, "")])).count() == 0
    for bad in ({"longest": 5}, {"longest": 1}, {"support": 0}, {"share": 0}):
        with pytest.raises(ValueError, match="asked for"):
            collocations.phrases(documents([]), **bad)


def test_query_agrees_with_sql_and_counting(spark, duck, sf_dir):
    df = catalog.QUERIES["op11_collocations"](spark, sf_dir)
    made = [tuple(r) for r in df.collect()]
    relation = duck.sql(catalog.ORACLES["op11_collocations"])
    assert rows_of(df.columns, made) == rows_of(relation.columns, relation.fetchall())
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(made) == brute(rows)
