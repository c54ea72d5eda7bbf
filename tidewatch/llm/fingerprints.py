"""Document fingerprints: one-permutation MinHash with optimal densification, in SQL functions only.

Every shingle of five words is hashed once. The top bits of a hash choose one of `BINS` bins,
each bin keeps its smallest hash, and of that the low `BITS` bits. An empty bin takes the value
of a filled one, chosen by hashes of (bin, attempt) alone, so texts with the same shingles choose
alike; after `TRIES` attempts the filled bin with the smallest hash of (bin, filled bin) is taken,
which ends the search for texts of a few words too. Eight values are packed into a long.

Two unequal bins agree in their low bits with probability ``2 ** -BITS``; `likeness` takes that out.

Odd input: a null text is an empty one; a text without words has the fingerprint of all zeros,
is like another such text by 1 and like any other by 0; a text of one to four words is one
shingle. Rows with equal ids are ordered by a hash of the row; null ids come last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text
from tidewatch.operators.ranking import range_bounds, with_range
from tidewatch.session import shuffle_width

BINS, BITS, SHINGLE = 256, 8, 5
TRIES = 8
_PER_LONG = 64 // BITS
#: Runs of neighbours per shuffle partition, so that no task gets many more than others.
RUNS_PER_PARTITION = 4


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """``[^\\x20\\x09-\\x0D]+`` of a text."""
    blank = " \t\n\x0b\x0c\r"
    return let(
        F.btrim(text, F.lit(blank)),
        lambda t: F.when(F.length(t) > 0, F.split(t, "[ \\x09-\\x0D]+")).otherwise(F.array().cast("array<string>")),
    )


def _scatter(a: Column, b: Column) -> Column:
    """A number below 2**31 that looks random, of two small ones."""
    prime = F.lit(2147483647).cast("bigint")
    x = ((a * 512 + b + 1).cast("bigint") * 1103515245 + 12345) % prime
    return let(x, lambda v: (v.bitwiseXOR(F.shiftright(v, 15)) * 1812433253) % prime)


def _bin(h: Column) -> Column:
    """0 to BINS - 1, rising with the signed hash."""
    return (F.shiftright(h, 64 - (BINS - 1).bit_length()) + BINS // 2).cast("int")


def _low(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Sorted hashes of all runs of ``size`` words; of the whole text if it has fewer."""

    def runs(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(
            F.size(w) <= size, F.array(F.xxhash64(w))
        ).otherwise(F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size))))

    return F.sort_array(let(F.transform(words(text), lambda w: F.xxhash64(w)), runs))


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The packed fingerprint, an array of longs; null for a text without words."""
    empty = F.lit(None).cast("int")

    def least_of_bins(h: Column) -> Column:
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))

    def spread(least: Column) -> Column:
        """Values of all bins, null where a bin is empty."""
        before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(least, i - 1)))
        run = F.transform(
            least, lambda x, i: F.concat(F.array_repeat(empty, _bin(x) - before(i) - 1), F.array(_low(x)))
        )
        last = _bin(F.element_at(least, -1))
        return F.concat(F.flatten(run), F.array_repeat(empty, F.lit(BINS - 1) - last))

    def densified(least: Column) -> Column:
        def fill(values: Column) -> Column:
            def one(value: Column, b: Column) -> Column:
                tries = [F.get(values, (_scatter(b, F.lit(t)) % BINS).cast("int")) for t in range(TRIES)]
                ranked = F.transform(least, lambda x: _scatter(b, _bin(x) + TRIES) * (1 << BITS) + _low(x))
                return F.coalesce(value, *tries, (F.array_min(ranked) % (1 << BITS)).cast("int"))

            return F.transform(values, one)

        return let(spread(least), fill)

    def packed(values: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)),
            lambda w: F.aggregate(
                F.slice(values, w * _PER_LONG + 1, _PER_LONG),
                F.lit(0).cast("bigint"),
                lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v.cast("bigint")),
            ),
        )

    made = let(let(shingle_hashes(text, size), least_of_bins), lambda least: F.when(
        F.size(least) > 0, let(densified(least), packed)
    ))
    return made


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles of two fingerprints, 0 to 1."""
    ones = sum(1 << (BITS * i) for i in range(_PER_LONG))

    def folded(width: int) -> Callable[[Column], Column]:
        return lambda u: u.bitwiseOR(F.shiftrightunsigned(u, width))

    def unequal(x: Column, y: Column) -> Column:
        v, width = x.bitwiseXOR(y), BITS
        while width > 1:
            width //= 2
            v = let(v, folded(width))
        return F.bit_count(v.bitwiseAND(F.lit(ones)))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, n: s + n)
    chance = 2.0**-BITS
    share = (F.lit(1.0) - differing / F.lit(float(BINS)) - chance) / (1.0 - chance)
    return (
        F.when(a.isNull() & b.isNull(), F.lit(1.0))
        .when(a.isNull() | b.isNull(), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    )


def as_text(packed: Column) -> Column:
    digits = F.array_join(F.transform(packed, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")
    return F.coalesce(digits, F.lit("0" * (BINS * BITS // 4)))


def with_next(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Texts with fingerprints, and those of the next document in descending ``doc_id``; the first follows the last.

    The order is cut into runs of ids. A run also holds a copy of the next run's first
    row, so every row finds its next one inside its run and texts are shuffled once.
    """
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("row_key", F.xxhash64("text"))
    bounds = range_bounds(rows, "doc_id", RUNS_PER_PARTITION * shuffle_width(docs.sparkSession))
    # Null ids, the last, are run -1.
    ranged = with_range(rows.where("doc_id is not null"), "doc_id", bounds).withColumnRenamed("_range", "run")
    cut = ranged.withColumn("run", F.col("run").cast("int")).unionByName(
        rows.where("doc_id is null").withColumn("run", F.lit(-1))
    )
    tops = cut.groupBy("run").agg(F.max("doc_id").alias("top"), F.min("row_key").alias("least")).collect()
    runs = sorted(tops, key=lambda r: -r["run"])  # one row for each run
    made = cut.select("run", "doc_id", "row_key", "text", fingerprint(F.col("text"), size).alias("fp"), F.lit(0).alias("last"))
    if runs:
        # The first row of each run, handed to the run before it.
        to = {b["run"]: a["run"] for a, b in zip([runs[-1], *runs], runs, strict=False)}
        ids = [r["top"] for r in runs if r["top"] is not None]
        nulls = [r["least"] for r in runs if r["top"] is None]
        first = cut.where(F.col("doc_id").isin(ids) | (F.col("doc_id").isNull() & F.col("row_key").isin(nulls)))
        least = Window.partitionBy("run").orderBy("row_key")
        goes = F.create_map(*[F.lit(x) for pair in to.items() for x in pair])
        heads = (
            first.withColumn("n", F.row_number().over(least)).where("n = 1")
            .select(goes[F.col("run")].alias("run"), "doc_id", "row_key", "text", fingerprint(F.col("text"), size).alias("fp"), F.lit(1).alias("last"))
        )
        made = made.unionByName(heads)
    order = Window.partitionBy("run").orderBy("last", F.col("doc_id").desc_nulls_last(), "row_key")
    return made.select(
        "doc_id", "text", "fp", "last",
        F.lead("text").over(order).alias("next_text"), F.lead("fp").over(order).alias("next_fp"),
    ).where("last = 0").drop("last")


def edited_fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how like they are to the edited and the next text."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    rows = with_next(docs, size).withColumn("edited", edited)
    both = rows.withColumn("edited_fp", fingerprint(F.col("edited"), size))
    return both.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
