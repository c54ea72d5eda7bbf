"""Language identification by word-first backoff.

A known word scores by its log frequency in each language; an unknown one falls back to its character
n-grams, from `LONGEST` characters down to one, and scores by the first length of which any is known.
The mean score per word, sharpened by the number of words, becomes a probability over the languages.

The model is fitted on a bounded sample: about `SAMPLE` texts of each language, drawn by a hash of the
id, and of what they hold the `WORDS` most frequent words and the `GRAMS` most frequent n-grams of each
length and language. Every text is classified whole.

Odd input: ``und`` and score 0 for a null text or one without a letter, and for every text if nothing was
learnt; of languages that score alike the first by name wins.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import draw, held_out, id_and_text, may_learn

SAMPLE, WORDS, GRAMS, LONGEST = 1500, 20_000, 4_000, 4
#: Scores remembered by a task; beyond that it starts afresh, which changes speed only.
REMEMBERED = 200_000
_SEED = 8
_LETTERS = regex.compile(r"\p{L}+")
_TOKEN = "lang string, size int, token string, n bigint"


@dataclass(frozen=True)
class Model:
    """Log frequencies by token: a row number for each, and a column for each language."""

    languages: tuple[str, ...]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray


def words_in(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def grams_in(word: str, size: int) -> list[str]:
    """Runs of ``size`` characters of a word, with its borders marked if the runs are longer than one."""
    marked = f"<{word}>" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def count_tokens(rows: DataFrame) -> DataFrame:
    """Words (``size`` 0) and n-grams of each language, counted in each task before they are shuffled."""
    out = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("token", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
                words.setdefault(lang.as_py(), Counter()).update(words_in(text.as_py()))
            for lang, seen in words.items():
                found = [(0, w, n) for w, n in seen.items()]
                for size in range(1, LONGEST + 1):
                    grams: Counter = Counter()
                    for w, n in seen.items():
                        for g in grams_in(w, size):
                            grams[g] += n
                    found += [(size, g, n) for g, n in grams.items()]
                size, token, n = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(size), pa.string()),
                        pa.array(size, pa.int32()),
                        pa.array(token, pa.string()),
                        pa.array(n, pa.int64()),
                    ],
                    schema=out,
                )

    return rows.mapInArrow(run, _TOKEN).groupBy("lang", "size", "token").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where(may_learn() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    if not known:
        return None
    languages = tuple(sorted(known))
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / known[lang]))])
    drawn = rows.where(draw(_SEED, "doc_id") < rate[F.col("lang")])
    counted = count_tokens(drawn)
    best = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "token")
    top = counted.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= F.when(F.col("size") == 0, WORDS).otherwise(GRAMS)
    )
    found = top.select("lang", "size", "token", "n").collect()  # WORDS + LONGEST * GRAMS rows a language at most
    words = {t: i for i, t in enumerate(sorted({r["token"] for r in found if r["size"] == 0}))}
    grams = {t: len(words) + i for i, t in enumerate(sorted({r["token"] for r in found if r["size"]}))}
    counts = np.zeros((len(words) + len(grams), len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    total = np.zeros((LONGEST + 1, len(languages)))
    sizes = np.zeros(len(counts), dtype=int)
    for r in found:
        row = words[r["token"]] if r["size"] == 0 else grams[r["token"]]
        counts[row, place[r["lang"]]] = r["n"]
        sizes[row] = r["size"]
        total[r["size"], place[r["lang"]]] += r["n"]
    scores = np.log((counts + 0.5) / (total[sizes] + 0.5 * max(1, len(counts))))
    return Model(languages, words, grams, scores.astype(np.float32))


def word_score(model: Model, word: str) -> np.ndarray | None:
    """Log frequency of a word in each language; None where nothing of it is known."""
    row = model.words.get(word)
    if row is not None:
        return model.scores[row]
    for size in range(min(LONGEST, len(word) + 2), 0, -1):
        rows = [model.grams[g] for g in grams_in(word, size) if g in model.grams]
        if rows:
            return model.scores[rows].mean(axis=0)
    return None


class Memory:
    """Scores of the words a task has met: a row for each, row 0 for words of which nothing is known."""

    def __init__(self, model: Model, size: int = REMEMBERED):
        self.model, self.size = model, size
        self.forget(0)

    def forget(self, at_least: int) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((max(self.size, at_least) + 1, len(self.model.languages)), dtype=np.float32)
        self.used = 1

    def rows_of(self, words: Counter) -> np.ndarray:
        if self.used + len(words) > len(self.scores):
            self.forget(len(words))
        rows, out = self.rows, []
        for word in words:
            row = rows.get(word)
            if row is None:
                score, row = word_score(self.model, word), 0
                if score is not None:
                    row, self.used = self.used, self.used + 1
                    self.scores[row] = score
                rows[word] = row
            out.append(row)
        return np.array(out)


def classify(text: str | None, memory: Memory) -> tuple[str, float]:
    seen = Counter(words_in(text))
    if not seen:
        return "und", 0.0
    rows = memory.rows_of(seen)
    n = np.fromiter(seen.values(), dtype=np.float64, count=len(rows)) * (rows > 0)
    # Words repeat each other's evidence: the square root keeps long texts from certainty by length alone.
    weight = n @ memory.scores[rows] / max(1.0, math.sqrt(n.sum()))
    share = np.exp(weight - weight.max())
    best = int(np.argmax(share))
    return memory.model.languages[best], float(share[best] / share.sum())


def predictions(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of each row."""
    rows = id_and_text(docs)
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    out = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(shared.value)
        for batch in batches:
            made = [classify(t.as_py(), memory) for t in batch.column("text")]
            lang, score = zip(*made, strict=True) if made else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], schema=out
            )

    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    found = predictions(docs, train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
