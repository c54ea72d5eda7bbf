"""Benchmark decontamination by winnowing.

A document is contaminated where ten consecutive words (``span``) also stand in a
benchmark item. Both sides keep the smallest hash of five words (``gram``) of every
window of ``span - gram + 1`` neighbours, so two equal spans always keep the same
gram at the same place. Kept grams carry the words around them and are extended to the
whole spans that hold them; a document's spans meet the different spans of the benchmark, word by
word equal, and items are attached last, so items that share a prompt are compared with it once. An item of
fewer than ten words counts as one span of its own length.

Before the shuffle a bitmap of the item hashes (`BITMAP_BITS` bits, never more) drops
nearly all document grams. If the benchmark is so large that the bitmap fills, more
grams are shuffled and the result is the same.

Odd input: null and blank texts have no words; a null item id takes part in hits but
not in the list of items; rows that repeat an id are judged each on their own, equal
rows come back as often as they came; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import keyed, stored
from tidewatch.llm.words import ALNUM, Words, gram_hashes, window_minima, words_of

SPAN, GRAM = 10, 5
BITMAP_BITS = 1 << 25
_PAGE_BITS = 1 << 15

_GRAM_TYPE = pa.struct(
    [("h", pa.int64()), ("kind", pa.int32()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.list_(pa.string()))]
)
_GRAM_DDL = "array<struct<h: bigint, kind: int, at: int, before: int, words: array<string>>>"


def winnowed(words: Words, hashes: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers where the kept grams of the run's documents begin, and the hashes of all grams."""
    grams = gram_hashes(hashes, gram)
    places = window_minima(grams, span - gram + 1)
    # A window counts only within one document.
    doc = words.doc_of()
    whole = doc[: len(places)] == doc[span - 1 : span - 1 + len(places)]
    return np.unique(places[whole]), grams


def kept_grams(words: Words, span: int, gram: int, short: list[int], known: np.ndarray | None) -> list[list[dict]]:
    """For each document of the run its kept grams, those only whose hash is in the bitmap ``known``.

    ``kind`` is 0 for grams of long spans, and the length for whole short items.
    """
    hashes, doc = words.hashes(), words.doc_of()
    out: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]

    def hit(h: np.ndarray) -> np.ndarray:
        if known is None:
            return np.ones(len(h), dtype=bool)
        slot = h & np.uint64(BITMAP_BITS - 1)
        return (known[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def keep(places: np.ndarray, h: np.ndarray, kind: int, size: int, around: int) -> None:
        for p, value in zip(places.tolist(), h.view(np.int64).tolist(), strict=True):
            d = int(doc[p])
            a = max(int(words.first[d]), p - around)
            b = min(int(words.first[d + 1]), p + size + around)
            at = p - int(words.first[d])
            out[d].append({"h": value, "kind": kind, "at": at, "before": p - a, "words": words.text(a, b)})

    places, grams = winnowed(words, hashes, span, gram)
    h = grams[places]
    found = hit(h)
    keep(places[found], h[found], 0, gram, span - gram)
    for size in short:
        h = gram_hashes(hashes, size)
        found = np.flatnonzero(hit(h) & (doc[: len(h)] == doc[size - 1 : size - 1 + len(h)]))
        keep(found, h[found], size, size, 0)
    return out


def item_grams(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``item_id``, ``h``, ``kind``, ``before``, ``words`` of all grams that the items keep."""
    out = pa.schema([("item_id", pa.int64()), ("grams", pa.list_(_GRAM_TYPE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams: list[list[dict]] = []
            for words in words_of(batch.column("text"), ALNUM, True):
                long = kept_grams(words, span, gram, [], None)
                for d, found in enumerate(long):
                    a, b = int(words.first[d]), int(words.first[d + 1])
                    if 0 < b - a < span:
                        h = gram_hashes(words.hashes()[a:b], b - a).view(np.int64)[0]
                        found = [{"h": int(h), "kind": b - a, "at": 0, "before": 0, "words": words.text(a, b)}]
                    grams.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(grams, pa.list_(_GRAM_TYPE))], schema=out)

    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    made = items.mapInArrow(run, f"item_id bigint, grams {_GRAM_DDL}")
    return made.select("item_id", F.inline("grams"))


def bitmap(grams: DataFrame) -> np.ndarray:
    """Which of `BITMAP_BITS` slots the hashes take: 4 MB at most, whatever the number of grams."""
    slot = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    pages = grams.groupBy((F.shiftright(slot, 15)).alias("page")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit(_PAGE_BITS - 1))).alias("bits")
    )
    known = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in pages.collect():  # BITMAP_BITS / 2**15 rows of 4 KB at most
        at = row["page"] * (_PAGE_BITS // 8)
        known[at : at + len(row["bits"])] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return known


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per document: ``doc_id``, ``row_key``, ``n_words``, ``copies``, ``hits`` (begin and length of
    each span of a benchmark item, in words) and ``items`` (ids, sorted as text)."""
    spark = docs.sparkSession
    items = item_grams(benchmark, span, gram)
    known = bitmap(items)
    short = sorted(r["kind"] for r in items.where("kind > 0").select("kind").distinct().collect())  # below `span`
    shared = spark.sparkContext.broadcast(known)
    out = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_words", pa.int64()), ("grams", pa.list_(_GRAM_TYPE))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text"), ALNUM, True):
                grams = kept_grams(words, span, gram, short, shared.value)
                own = [batch.column(c)[words.rows] for c in ("doc_id", "row_key")]
                counts = pa.array(np.diff(words.first), pa.int64())
                yield pa.RecordBatch.from_arrays([*own, counts, pa.array(grams, pa.list_(_GRAM_TYPE))], schema=out)

    found = keyed(docs).mapInArrow(run, f"doc_id bigint, row_key bigint, n_words bigint, grams {_GRAM_DDL}")
    # Read for the documents, their spans and their items; it holds the few grams that may be in the benchmark.
    found = stored(found, "grams")
    theirs = stored(_windows(items, span, gram).select("item_id", "kind", "window").distinct(), "benchmark-windows")
    own = _windows(found.select("doc_id", "row_key", F.inline(F.coalesce("grams", F.array().cast(_GRAM_DDL)))), span, gram)
    # Equality is decided once for each window, however many items share it.
    hits = own.join(theirs.select("kind", "window").distinct(), ["kind", "window"], "left_semi")
    spans = hits.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("begin", "length")).alias("hits"))
    named = hits.select("doc_id", "row_key", "kind", "window").distinct().join(theirs, ["kind", "window"])
    ids = named.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    rows = found.groupBy("doc_id", "row_key").agg(F.max("n_words").alias("n_words"), F.count("*").alias("copies"))
    for part in (spans, ids):
        part = part.withColumnsRenamed({"doc_id": "_id", "row_key": "_key"})
        rows = rows.join(part, (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id", "_key")
    none = F.array()
    return rows.withColumns({
        "hits": F.coalesce("hits", none.cast("array<struct<begin:int,length:int>>")), "items": F.coalesce("items", none.cast("array<string>")),
    })


def _windows(grams: DataFrame, span: int, gram: int) -> DataFrame:
    """Every whole span that a gram's words hold around it: ``window``, and its ``begin`` and ``length`` in words."""
    width = F.when(F.col("kind") == 0, F.lit(span)).otherwise(F.col("kind"))
    size = F.when(F.col("kind") == 0, F.lit(gram)).otherwise(F.col("kind"))
    first = lambda back: F.col("before") - back
    backs = F.filter(F.sequence(F.lit(0), width - size), lambda back: (first(back) >= 0) & (first(back) + width <= F.size("words")))
    spans = F.transform(
        backs,
        lambda back: F.struct(
            F.array_join(F.slice("words", first(back) + 1, width), " ").alias("window"),
            (F.col("at") - back).alias("begin"),
            width.alias("length"),
        ),
    )
    kept = [c for c in grams.columns if c not in ("h", "at", "before", "words")]
    return grams.select(*kept, F.inline(spans))


def covered(hits: Column) -> Column:
    """Words inside any of the spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.sort_array(hits),
        start,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["begin"] + x["length"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["begin"] + x["length"] - F.greatest(s["end"], x["begin"]))).alias("n"),
        ),
        lambda s: s["n"],
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: the digest of its hits."""
    found = contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        covered(F.col("hits")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "copies",
    ).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"),
    ).drop("copy")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, all their columns kept."""
    bad = contamination(docs, benchmark).where(F.size("hits") > 0).select("doc_id", "row_key")
    own = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("row_key", F.xxhash64("doc_id", "text"))
    return own.join(bad, (own["row_key"] == bad["row_key"]) & own["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti").select("doc.*")

