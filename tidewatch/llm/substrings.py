"""Substring deduplication with an FM-index per shard.

Words covered by a run of ``window`` words that also starts anywhere else in the
corpus are removed. The work is dealt out by content:

1. Every window has an anchor, the smallest hash of eight words in it (`ANCHOR`), which
   depends on its words alone. Anchors are counted; a window whose anchor is unique is unique.
2. Documents with repeated anchors give segments: neighbouring windows with one anchor.
   A window lies in one segment only. An anchor with more than ``busy`` different segments
   is dealt out further, window by window.
3. Equal segments are counted. The different ones go to shards by anchor; each shard
   builds an FM-index (suffix order, wavelet matrix over the transform) and streams its
   segments against it: backward search gives the matching statistics, and intervals of at
   least ``window`` words that occur twice or more are reported.
4. Intervals return to the documents, and the words in them go.

Odd input: null and blank texts have no words; equal rows are occurrences of each other
like any two documents; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import keyed, same_row, stored
from tidewatch.llm.words import NOT_BLANK, gram_hashes, window_minima, words_of

WINDOW, ANCHOR = 35, 8
#: Words one shard's index holds, and different segments of one anchor that may stay together.
SHARD_WORDS, BUSY = 1_000_000, 10_000


def _anchors(words, window: int, anchor: int):
    """Runs of windows with one anchor: its hash, document, first window and number of windows."""
    grams = gram_hashes(words.hashes(), anchor)
    places = window_minima(grams, window - anchor + 1)
    doc = words.doc_of()
    whole = np.flatnonzero(doc[: len(places)] == doc[window - 1 : window - 1 + len(places)])
    if not len(whole):
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none, none
    place, own = places[whole], doc[whole]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:] != own[:-1])]))
    count = np.diff(np.concatenate([first, [len(whole)]]))
    return grams[place[first]], own[first], whole[first] - words.first[own[first]], count


def anchors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``route`` (hash of the anchor), ``doc_id``, ``row_key``, ``begin`` and ``windows`` of every segment."""
    out = pa.schema(
        [("route", pa.int64()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("begin", pa.int32()), ("windows", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text"), NOT_BLANK, False):
                route, doc, begin, count = _anchors(words, window, anchor)
                rows = pa.array(doc + words.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route.view(np.int64)),
                        batch.column("doc_id").take(rows),
                        batch.column("row_key").take(rows),
                        pa.array(begin.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    schema=out,
                )

    kind = "route bigint, doc_id bigint, row_key bigint, begin int, windows int"
    return keyed(docs).mapInArrow(run, kind)


def segments(docs: DataFrame, window: int = WINDOW, busy: int = BUSY) -> DataFrame:
    """Occurrences of segments whose anchor is repeated: ``route``, ``seg`` (the words), ``doc_id``,
    ``row_key``, ``begin``; written to the shared folder."""
    found = anchors(docs, window)
    # Written, so that the join below shuffles both sides itself and can split a route that very many share.
    repeated = stored(found.groupBy("route").count().where("count > 1").select("route"), "routes")
    kept = found.join(repeated, "route", "left_semi")
    wanted = kept.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("route", "begin", "windows")).alias("runs"))
    texts = keyed(docs)
    met = texts.join(wanted, same_row(texts, wanted)).select(texts["doc_id"], texts["row_key"], "text", "runs")
    out = pa.schema(
        [("route", pa.int64()), ("seg", pa.string()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("begin", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in range(batch.num_rows):
                words = batch.column("text")[d].as_py().encode().split()
                runs = batch.column("runs")[d].values
                route, begin, count = (runs.field(i).to_numpy() for i in range(3))
                order = np.argsort(begin)
                seg = [
                    b" ".join(words[a : a + n + window - 1]).decode()
                    for a, n in zip(begin[order].tolist(), count[order].tolist(), strict=True)
                ]
                same = np.zeros(len(seg), dtype=np.int64) + d
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route[order]),
                        pa.array(seg, pa.string()),
                        batch.column("doc_id").take(pa.array(same)),
                        batch.column("row_key").take(pa.array(same)),
                        pa.array(begin[order]),
                    ],
                    schema=out,
                )

    held = stored(met.mapInArrow(run, "route bigint, seg string, doc_id bigint, row_key bigint, begin int"), "segments")
    different = held.groupBy("route", "seg").count().groupBy("route").count()
    crowded = stored(different.where(F.col("count") > busy).select("route", F.lit(True).alias("crowded")), "crowded")
    marked = held.join(crowded, "route", "left")
    parts = F.split("seg", " ")
    single = F.transform(
        F.sequence(F.lit(0), F.size(parts) - window),
        lambda i: F.struct(i.alias("shift"), F.array_join(F.slice(parts, i + 1, window), " ").alias("seg")),
    )
    alone = F.array(F.struct(F.lit(0).alias("shift"), F.col("seg").alias("seg")))
    dealt = marked.select(
        "route", "doc_id", "row_key", "begin", "crowded",
        F.inline(F.when(F.col("crowded"), single).otherwise(alone)),
    )
    return dealt.select(
        F.when(F.col("crowded"), F.xxhash64("seg")).otherwise(F.col("route")).alias("route"),
        "seg", "doc_id", "row_key", (F.col("begin") + F.col("shift")).alias("begin"),
    )


class WaveletMatrix:
    """Counts of a symbol in any prefix of a sequence, in packed bits: one bit plane for each
    binary digit of the symbols, with running totals for every 64 bits."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.size, self.levels = len(symbols), max(1, int(top).bit_length())
        self.bits, self.sums, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level & 1).astype(bool)
            padded = np.zeros((self.size // 64 + 1) * 64, dtype=np.uint8)
            padded[: self.size] = bit
            packed = np.packbits(padded, bitorder="little").view("<u8")
            self.bits.append(packed)
            self.sums.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)[:-1]]).astype(np.int32))
            self.zeros.append(self.size - int(bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def place(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Where the first ``upto`` elements end among the symbol's own after all levels."""
        for k, level in enumerate(reversed(range(self.levels))):
            block = upto >> 6
            below = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.sums[k][block] + np.bitwise_count(self.bits[k][block] & below)
            upto = np.where(symbol >> level & 1, self.zeros[k] + ones, upto - ones)
        return upto


class FMIndex:
    """Counted occurrences of word sequences in a list of segments, by backward search."""

    def __init__(self, words: np.ndarray, owner: np.ndarray, weights: np.ndarray, depth: int):
        """``words``: numbers from 1, with 0 behind each segment; ``owner``: the segment of each place;
        ``weights``: how often each segment occurs; ``depth``: the longest sequence searched for."""
        n, top = len(words), int(words.max(initial=0))
        rank, width = words.astype(np.int64), 1
        while True:
            behind = np.zeros(n, dtype=np.int64)
            behind[: max(0, n - width)] = rank[width:] + 1
            key = rank * (int(rank.max(initial=0)) + 2) + behind
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, dtype=np.int64)
            new[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))[:n]
            rank, width = new, width * 2
            if width > depth or (n and rank.max() == n - 1):
                break
        self.first = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=top + 1))])
        self.tree = WaveletMatrix(words[order - 1], top)
        symbols = np.arange(top + 1)
        self.base = self.tree.place(symbols, np.zeros(top + 1, dtype=np.int64))
        self.seen = np.concatenate([[0], np.cumsum(weights[owner[order]])])

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with ``word`` and go on as those between ``low`` and ``high``."""
        both = self.tree.place(np.concatenate([word, word]), np.concatenate([low, high]))
        shift = self.first[word] - self.base[word]
        return both[: len(word)] + shift, both[len(word) :] + shift

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.seen[high] - self.seen[low]


def repeated_intervals(index: FMIndex, words: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int):
    """Matching statistics of all segments at once: ``segment``, ``from``, ``to`` of the longest
    intervals of at least ``window`` words that occur twice or more.

    Each segment is read from its end to the left as long as the sequence is repeated. Where it
    ends at ``q`` (the sequence from ``q`` on is unique), the next shorter end is tried. After a
    short match a probe of four words from ``q`` on tells whether the words there are unique
    themselves; if so, no repeated window holds them and the search goes on in front of them.
    """
    probe = 4
    n = len(begins)
    segment = np.arange(n)
    end, at = ends.copy(), ends.copy()
    low, high = np.zeros(n, dtype=np.int64), np.full(n, len(words), dtype=np.int64)
    back = np.full(n, -1)  # the end to return to if a probe finds its words repeated
    goal = begins.copy()  # where the search may stop: the segment's begin, or the probe's
    found = []
    while len(segment):
        word = words[at - 1]
        new_low, new_high = index.extend(word, low, high)
        goes_on = index.count(new_low, new_high) >= 2
        at = np.where(goes_on, at - 1, at)
        low, high = np.where(goes_on, new_low, low), np.where(goes_on, new_high, high)
        over = ~goes_on | (at == goal)
        if not over.any():
            continue
        probing = back >= 0
        # A finished search: an interval, and the next end to try.
        whole = over & ~probing
        long = whole & (end - at >= window)
        if long.any():
            found.append((segment[long], at[long], end[long]))
        stuck = whole & ~goes_on
        q = at - 1  # the first word that did not fit
        short = stuck & (end - at < window) & (end - q > probe + 1)
        plain = stuck & ~short
        following = np.minimum(end - 1, q + window)
        ended = over & probing
        # The probe's words from `q` on are unique: all ends that hold them are out.
        fallback = np.where(goes_on, back - 1, np.minimum(back - 1, end - 1))
        new_end = np.where(plain, following, np.where(ended, fallback, np.where(short, q + probe, end)))
        back = np.where(short, end, np.where(ended, -1, back))
        goal = np.where(short, q, np.where(over, begins[segment], goal))
        at = np.where(over, new_end, at)
        end = np.where(over, new_end, end)
        low, high = np.where(over, 0, low), np.where(over, len(words), high)
        done = (whole & goes_on) | ((back < 0) & (end - begins[segment] < window))
        left = ~done
        segment, end, at, low, high, back, goal = (x[left] for x in (segment, end, at, low, high, back, goal))
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *x]) for x in (zip(*found, strict=True) if found else ((), (), ())))


def search_shard(texts: pa.Array, weights: np.ndarray, window: int):
    """Intervals (segment, from, to in words) of one shard's segments that are repeated in it."""
    parts = list(words_of(texts, NOT_BLANK, False))
    _, numbers = np.unique(np.concatenate([p.hashes() for p in parts]), return_inverse=True)
    sizes = np.concatenate([np.diff(p.first) for p in parts])
    ends = np.cumsum(sizes + 1) - 1
    words = np.zeros(int(sizes.sum()) + len(sizes), dtype=np.int64)
    inner = np.ones(len(words), dtype=bool)
    inner[ends] = False
    words[inner] = numbers + 1
    index = FMIndex(words, np.repeat(np.arange(len(sizes)), sizes + 1), weights, int(sizes.max(initial=1)))
    segment, a, b = repeated_intervals(index, words, ends - sizes, ends, window)
    return segment, a - (ends - sizes)[segment], b - (ends - sizes)[segment]


def repeated_spans(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, busy: int = BUSY) -> DataFrame:
    """``doc_id``, ``row_key``, ``spans``: intervals of words of each document, of at least ``window``
    words, whose windows also start elsewhere."""
    occurrences = segments(docs, window, busy)
    different = occurrences.groupBy("route", "seg").agg(F.count("*").alias("n"))
    # Anchors leave about 48 words a segment.
    shards = max(1, -(-occurrences.count() * 48 // shard_words))
    dealt = different.repartition(shards, "route")
    out = pa.schema([("route", pa.int64()), ("seg_key", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        weights = np.minimum(rows.column("n").to_numpy(), 2)
        segment, a, b = search_shard(rows.column("seg").combine_chunks(), weights, window)
        take = pa.array(segment)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("route").combine_chunks().take(take),
                rows.column("seg_key").combine_chunks().take(take),
                pa.array(a.astype(np.int32)),
                pa.array(b.astype(np.int32)),
            ],
            schema=out,
        )

    hits = dealt.select("route", F.xxhash64("seg").alias("seg_key"), "seg", "n").mapInArrow(
        run, "route bigint, seg_key bigint, a int, b int"
    )
    places = occurrences.select("route", F.xxhash64("seg").alias("seg_key"), "doc_id", "row_key", "begin")
    span = F.struct((F.col("begin") + F.col("a")).alias("a"), (F.col("begin") + F.col("b")).alias("b"))
    return (
        places.join(hits, ["route", "seg_key"])
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_set(span)).alias("spans"))
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, busy: int = BUSY) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one space)."""
    spans = repeated_spans(docs, window, shard_words, busy)
    texts = keyed(docs)
    met = texts.join(spans, same_row(texts, spans), "left").select(texts["doc_id"], "text", "spans")
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, kept = [], [], []
            for text, cut in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = (text.as_py() or "").encode().split()
                left, at = [], 0
                for x in cut.as_py() or ():
                    left += words[at : max(at, x["a"])]
                    at = max(at, x["b"])
                left += words[at:]
                n_words.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                schema=out,
            )

    return met.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
