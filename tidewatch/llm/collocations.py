"""Phrases that stand together, mined by a sample, its negative border, and passes until nothing is missing.

Phrases are runs of words inside a piece of a text, counted per language. A phrase is at most as frequent as any part of it,
so only phrases whose parts are frequent can be frequent.

1. A sample of the documents proposes phrases: those frequent in it at a lowered threshold.
2. A full pass counts, exactly, every phrase whose two parts of one word less are proposed (single words: always).
   These are the proposed phrases and their negative border.
3. A frequent phrase of the border was not proposed: the border failed. Such phrases are added to the proposed ones, and
   another full pass counts what this adds to the border, until no pass finds a new one.

A phrase goes by the 64-bit hashes of its words, each with its language in it, so phrases are taken apart and scored without
their texts. Two texts that share hashes are an error, not a wrong count, when they meet in the result. What is proposed goes
to the tasks as a table of bits, two bits a phrase, of 16 bits a phrase and at most ``MOST_BITS`` (32 MB) however many there are. A phrase that is in the
table by chance counts as proposed; this adds work but changes no count, as all occurrences of a phrase see the same table.
Beyond 16 million proposed phrases the table fills up and more phrases are counted than needed.

A task adds up runs of ``GATHERED`` phrases before it hands them on, so a word of every document is one row a run. Counts are
added by key; no group is collected and nothing is joined to the texts. The texts of the phrases that are asked for
are fetched by a last pass, once per task and phrase (a task holds the hashes of those it has met).

Odd input: a null text has no words, a null language reads as ``und``. Repeated rows and ids count as often as they
stand there. An empty table gives an empty table. Texts are never cut; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import draw, stored
from tidewatch.llm.words import Words, byte_class, mixed, words_of
from tidewatch.session import scoped_conf

SUPPORT, LONGEST, COVERED, BEST = 30, 4, 80, 2000
#: Share of documents in the sample, what of the support is asked of it, and its seed. They change the work only.
SHARE, LOWERED, SEED = 1 / 16, 0.75, 11
MOST_BITS, GATHERED = 1 << 28, 300_000
#: Bytes of text whose words are found at a time; one text is never cut.
RUN_BYTES = 1 << 19
BATCH_ROWS = 2_000

_CUTS = frozenset(b".,;:!?\n\x0b\x0c\r")
_INSIDE = byte_class(lambda b: b not in _CUTS and b not in b" \t")
_CUT = byte_class(lambda b: b in _CUTS)
_ODD = np.uint64(0x9FB21C651E98DF25)


class Bits:
    """A set of hashes of fixed size, never without a member, sometimes with one too many."""

    def __init__(self, width: int, data: np.ndarray):
        self.width, self.data = width, data

    def has(self, first: np.ndarray) -> np.ndarray:
        here = np.ones(len(first), dtype=bool)
        for place in (first >> np.uint64(64 - self.width), first & np.uint64((1 << self.width) - 1)):
            here &= (self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return here

    def joined(self, other: Bits) -> Bits:
        return Bits(self.width, self.data | other.data)


def bits_width(members: int, least: int = 20) -> int:
    return min(MOST_BITS.bit_length() - 1, max(least, (16 * members).bit_length()))


def _folded(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of the words' hashes; the last ones of a short phrase are 0."""
    h = np.zeros(len(hashes[0]), dtype=np.uint64)
    for one in hashes:
        h = h * _ODD + one
    return mixed(h)


def _unsigned(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The hashes of a table of phrases; what stands behind a single word is its language."""
    hashes = [batch.column(c).to_numpy().view(np.uint64) for c in _HASHES]
    return [*hashes[:3], np.where(hashes[1] == 0, np.uint64(0), hashes[3])]


def bits_of(keys: DataFrame, width: int, known=None) -> Bits:
    """The bits of some phrases, put together by Spark in pieces of 4 KB; at most ``2**width`` bits reach the driver.
    Phrases that are in the broadcast bits ``known`` are left out by the same step, so a task needs one Python worker."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = _folded(_unsigned(batch))
            if known is not None:
                first = first[~known.value.has(first)]
            yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64))], names=["first"])

    first = keys.select(*_HASHES).mapInArrow(fold, "first bigint")
    places = F.array(F.shiftrightunsigned("first", 64 - width), F.col("first").bitwiseAND(F.lit((1 << width) - 1)))
    place = first.select(F.explode(places).alias("place"))
    # A page of bits: 32,768 of them.
    pages = place.groupBy(F.shiftright("place", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32767))).alias("bits")
    )
    data = np.zeros((1 << width) // 8, dtype=np.uint8)
    for row in pages.toLocalIterator():
        data[row.page * 4096 : (row.page + 1) * 4096] = np.frombuffer(row.bits, dtype=np.uint8)
    return Bits(width, data)


class Phrases:
    """All phrases of a run of texts, by their first word; those at a border of texts or pieces are not whole."""

    def __init__(self, words: Words, langs: np.ndarray):
        doc = words.doc_of()
        self.doc, self.salt = doc, langs[doc]
        # 0 stands for no word.
        self.one = np.maximum(mixed(words.hashes() ^ self.salt), np.uint64(1))
        cuts = np.cumsum(_CUT[words.data])
        # Pieces are numbered on through all texts, so one number tells both.
        self.piece = (cuts[words.starts] if len(words) else cuts[:0]) + doc * (len(words.data) + 1)

    def hashes(self, size: int, at: np.ndarray) -> list[np.ndarray]:
        none = np.zeros(len(at), dtype=np.uint64)
        return [self.one[at + j] if j < size else none for j in range(4)]

    def whole(self, size: int) -> np.ndarray:
        n = len(self.piece) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=bool)
        return self.piece[:n] == self.piece[size - 1 :]

    def levels(self, longest: int, proposed: Bits | None) -> Iterator[tuple[int, np.ndarray]]:
        """For each size the places of phrases whose parts of one word less are proposed."""
        member = None
        for size in range(1, longest + 1):
            fits = self.whole(size)
            if member is not None:
                fits &= member[: len(fits)] & member[1 : len(fits) + 1]
            at = np.flatnonzero(fits)
            yield size, at
            member = np.zeros(len(self.piece) + 1, dtype=bool)
            if size < longest:
                here = slice(None) if proposed is None else proposed.has(_folded(self.hashes(size, at)))
                member[at[here]] = True


_HASHES = ["h1", "h2", "h3", "h4"]
_COUNTS = pa.schema([*[(h, pa.int64()) for h in _HASHES], ("n", pa.int64())])
_SHAPE = "h1 bigint, h2 bigint, h3 bigint, h4 bigint, n bigint"
#: Words of a phrase by its hashes; a single word has its language in the last place.
_SIZE = "CASE WHEN h2 = 0 THEN 1 WHEN h3 = 0 THEN 2 WHEN h4 = 0 THEN 3 ELSE 4 END"


def _added(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    """One row for each key, with the number of times it is there."""
    hashes = [np.concatenate([p[i] for p in parts]) for i in range(4)]
    parts.clear()
    first = _folded(hashes)
    order = np.argsort(first)
    first = first[order]
    starts = np.concatenate([[True], first[1:] != first[:-1]])
    # Different phrases of one fold: told apart by the hashes themselves.
    for h in hashes:
        starts[1:] |= h[order[1:]] != h[order[:-1]]
    starts = np.flatnonzero(starts)
    counts = np.diff(np.concatenate([starts, [len(first)]]))
    columns = [pa.array(h[order[starts]].view(np.int64)) for h in hashes]
    return pa.RecordBatch.from_arrays([*columns, pa.array(counts)], schema=_COUNTS)


def _lang_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """A hash of each row's language."""
    column = batch.column("lang").dictionary_encode()
    salts = [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in column.dictionary.to_pylist()]
    return np.frombuffer(b"".join(salts), dtype=np.uint64)[column.indices.to_numpy()]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, Phrases]]:
    for batch in batches:
        langs = _lang_hashes(batch)
        for words in words_of(batch.column("text"), _INSIDE, lower=True, chunk_bytes=RUN_BYTES):
            yield batch, words, Phrases(words, langs[words.rows])


def _counted(texts: DataFrame, longest: int, proposed, before) -> DataFrame:
    """``h1`` to ``h4`` and ``n`` of all phrases whose parts are proposed, but not those whose parts were so ``before``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = (None if b is None else b.value for b in (proposed, before))
        parts, held = [], 0
        for _, _, phrases in _runs(batches):
            old = None if then is None else [at for _, at in phrases.levels(longest, then)]
            for size, at in phrases.levels(longest, now):
                if old is not None:
                    at = at[~np.isin(at, old[size - 1], assume_unique=True)]
                if len(at):
                    hashes = phrases.hashes(size, at)
                    if size == 1:
                        hashes[3] = phrases.salt[at]
                    parts.append(hashes)
                    held += len(at)
            if held > GATHERED:
                held = 0
                yield _added(parts)
        if parts:
            yield _added(parts)

    return texts.mapInArrow(run, _SHAPE).groupBy(*_HASHES).agg(F.sum("n").alias("n"))


def _few_files(df: DataFrame, name: str) -> DataFrame:
    """`stored` in files of a useful size: what is left of a pass is small, and its tasks are many."""
    return stored(df.hint("rebalance"), name)


def frequent_keys(texts: DataFrame, support: int, longest: int, share: float) -> DataFrame:
    """Hashes and exact counts of all phrases of up to ``longest`` words that occur ``support`` times or more."""
    spark = texts.sparkSession
    # Small batches of texts: a task's memory is for its counts.
    with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        return _closed(texts, support, longest, share)


def _closed(texts: DataFrame, support: int, longest: int, share: float) -> DataFrame:
    context = texts.sparkSession.sparkContext
    sample = texts.where(draw(SEED, "lang", "text") < share)
    lowered = max(2, int(support * share * LOWERED))
    sampled = _few_files(_counted(sample, longest - 1, None, None).where(F.col("n") >= lowered), "sampled-phrases")
    width = bits_width(sampled.count())
    proposed, before, tables = context.broadcast(bits_of(sampled, width)), None, []
    while True:
        found = _counted(texts, longest, proposed, before).where(F.col("n") >= support)
        tables.append(_few_files(found, "frequent-phrases"))
        # Not proposed, and short enough to be part of others: the border failed.
        missed = bits_of(tables[-1].where(F.expr(_SIZE) < longest), width, proposed)
        if before is not None:
            before.unpersist()
        # Every phrase sets a bit.
        if not missed.data.any():
            break
        proposed, before = context.broadcast(proposed.value.joined(missed)), proposed
    proposed.unpersist()
    out = tables[0]
    for table in tables[1:]:
        out = out.unionAll(table)
    return out


def _named(texts: DataFrame, keys: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """``lang`` and ``phrase`` of some phrases, with all columns of ``keys``; and the number ``n`` of words of each language."""
    # Sharp enough that hardly any phrase is there by chance.
    sent = texts.sparkSession.sparkContext.broadcast(bits_of(keys, bits_width(keys.count(), 24)))
    schema = pa.schema([*[(h, pa.int64()) for h in _HASHES], ("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int64())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, met = sent.value, np.zeros(0, dtype=np.uint64)
        words_in: dict[str, int] = {}
        for batch, words, phrases in _runs(batches):
            langs = batch.column("lang").slice(words.rows.start, words.rows.stop - words.rows.start).to_pylist()
            for lang, count in zip(langs, np.diff(words.first).tolist(), strict=True):
                words_in[lang] = words_in.get(lang, 0) + count
            rows, fresh, raw = [], [met], words.data.tobytes()
            for size in range(1, longest + 1):
                at = np.flatnonzero(phrases.whole(size))
                first = _folded(phrases.hashes(size, at))
                here = np.flatnonzero(wanted.has(first))
                first, place = np.unique(first[here], return_index=True)
                new = ~np.isin(first, met, assume_unique=True)
                fresh.append(first[new])
                for i in at[here[place[new]]].tolist():
                    hashes = [int(h[0].view(np.int64)) for h in phrases.hashes(size, np.array([i]))]
                    text = raw[words.starts[i] : words.ends[i + size - 1]].decode()
                    if text.count(" ") != size - 1 or "\t" in text:
                        text = " ".join(words.text(i, i + size))
                    rows.append((*hashes, langs[phrases.doc[i]], text, 0))
            met = np.unique(np.concatenate(fresh))
            if rows:
                yield as_batch(rows)
        # Totals have no hashes.
        if words_in:
            yield as_batch([(0, 0, 0, 0, lang, None, n) for lang, n in words_in.items()])

    shape = ", ".join([*[f"{h} bigint" for h in _HASHES], "lang string, phrase string, words bigint"])
    once = texts.mapInArrow(run, shape).groupBy(*_HASHES, "lang").agg(
        F.min("phrase").alias("phrase"), F.max("phrase").alias("other"), F.sum("words").alias("words")
    )
    plain = keys.withColumn("h4", F.when(F.col("h2") == 0, 0).otherwise(F.col("h4")))
    joined = once.join(plain, _HASHES, "left").where(F.col("n").isNotNull() | F.col("phrase").isNull())
    one = F.when(F.col("phrase") != F.col("other"), F.raise_error(F.lit("two phrases share their hashes"))).otherwise(F.col("phrase"))
    with scoped_conf(texts.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        found = _few_files(joined.withColumn("phrase", one).drop("other"), "named-phrases")
    totals = found.where(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("words").alias("n"))
    return found.where(F.col("phrase").isNotNull()).drop("words"), totals


def _texts(docs: DataFrame, support: int, longest: int, share: float) -> DataFrame:
    if not 2 <= longest <= 4 or support < 1 or not 0 < share <= 1:
        raise ValueError("2 to 4 words, a support of 1 or more and a share in (0, 1] are asked for")
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words (4 at most) that occur ``support`` times or more in their language: ``lang``, ``phrase``,
    ``size`` and count ``a``; and the number ``n`` of all words of each language."""
    texts = _texts(docs, support, longest, share)
    found, totals = _named(texts, frequent_keys(texts, support, longest, share), longest)
    return found.select("lang", "phrase", F.expr(_SIZE).alias("size"), F.col("n").alias("a")), totals


def _part(words: str, begin: str, count: str, names: list[str]) -> list[Column]:
    """Hashes of a part of a phrase, with 0 behind its last word."""
    return [F.expr(f"CASE WHEN {i} < {count} THEN {words}[{begin} + {i}] ELSE 0L END").alias(n) for i, n in enumerate(names)]


def scored_keys(keys: DataFrame, covered: int = COVERED) -> DataFrame:
    """Phrases of two words and more with the score of their weakest cut, without those that mostly stand inside longer ones:
    hashes, ``n``, ``l``, ``r``, ``score`` and the hash ``tongue`` of the language."""
    wide = "decimal(38,0)"
    candidates = keys.where("h2 <> 0").withColumns({"size": F.expr(_SIZE), "w": F.array(*_HASHES)})
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(*_HASHES, "n", "k", *_part("w", "0", "k", ["x1", "x2", "x3"]), *_part("w", "k", "(size - k)", ["y1", "y2", "y3"]))
    # Parts have three words at most; the last place of single words is their language.
    single = F.col("h2") == 0
    parts = keys.where((F.col("h4") == 0) | single)
    left = parts.select(*[F.col(h).alias(f"x{i}") for i, h in enumerate(_HASHES[:3], 1)], F.col("n").alias("l"), F.when(single, F.col("h4")).alias("tongue"))
    right = parts.select(*[F.col(h).alias(f"y{i}") for i, h in enumerate(_HASHES[:3], 1)], F.col("n").alias("r"))
    score = F.expr(f"cast(2000000 as {wide}) * n div (cast(l as {wide}) + r)")
    scored = cuts.join(left, ["x1", "x2", "x3"]).join(right, ["y1", "y2", "y3"]).withColumn("score", score)
    # The first cut has a single word in front, which knows the language.
    weakest = scored.groupBy(*_HASHES, "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("tongue").alias("tongue"))
    longer = candidates.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("m"))))
    inside = longer.select(*_part("w", "i", "m", _HASHES), F.col("n").alias("longer"))
    hidden = inside.groupBy(*_HASHES).agg(F.max("longer").alias("longer"))
    kept = weakest.join(hidden, _HASHES, "left").where(
        F.expr(f"longer is null or cast(100 as {wide}) * longer < cast({covered} as {wide}) * n")
    )
    return kept.select(*_HASHES, "n", "cut.l", "cut.r", "cut.score", "tongue")


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, share: float = SHARE, covered: int = COVERED, best: int | None = None
) -> DataFrame:
    """Phrases with the score of their weakest cut; with ``best`` only as many of each language, and those that tie with the
    last of them in score and count. Texts are fetched for these alone."""
    texts = _texts(docs, support, longest, share)
    scored = scored_keys(frequent_keys(texts, support, longest, share), covered)
    if best is not None:
        order = Window.partitionBy("tongue").orderBy(F.col("score").desc(), F.col("n").desc())
        scored = scored.withColumn("place", F.rank().over(order)).where(F.col("place") <= best).drop("place")
    found, totals = _named(texts, _few_files(scored, "scored-phrases"), longest)
    named = found.select("lang", "phrase", F.col("n").alias("a"), "l", "r", "score")
    return named.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def best_collocations(docs: DataFrame, best: int = BEST, **settings) -> DataFrame:
    """The ``best`` `collocations` of each language, by score, count and phrase."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = collocations(docs, best=best, **settings).withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
