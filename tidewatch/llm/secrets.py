"""Secret scans: fixed patterns and a randomness test battery, in DataFrame functions only.

Base spans are the matches of three patterns. The battery adds ``random`` spans: runs of 20 or more
characters of an encoding's alphabet that do not meet a base span. The encoding is inferred (hex, base32,
base36 or base64), the characters become numbers of its alphabet, and three tests ask whether
they look uniform and independent: chi-squared of the counts, runs above and below the middle, and
the serial correlation of neighbours. A run passes when none of the three rejects at `LEVEL`
(Bonferroni).

Passing alone is weak for short runs, so each also gets a p-value under ordinary text: the summed surprise
of its characters under a letter model, whose spread shrinks with the length. Those p-values go through
a false-discovery control (Benjamini-Hochberg at `RATE`) over all candidates of the corpus, by class of
length, on a histogram of at most `BINS` bins a class; so what is taken depends on the whole corpus.

Time is in proportion to the length of a text, in one run as in many matches (sorted together with the base spans).
Odd input: a null text is an empty one; equal rows give equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text
from tidewatch.llm.fingerprints import let

#: The base patterns, kind by kind in the order of the output, and how long a match must be.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
CANDIDATE_LEAST = 20
#: P-values below 1e-30 share the last bin.
LEVEL, RATE, BINS = 0.01, 0.01, 300
#: Matches whose places run together.
BLOCK = 256
#: Lower ends of the classes of length.
CLASSES = (20, 32, 64)

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets by encoding; hex is lower-cased first, and the two signs of the URL form become the usual ones.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
}
#: Letters from frequent to rare; their shares fall as one over the rank.
_FREQUENT = "etaoinshrdlcumwfgypbvkjxqz"


def spans(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches: structs of ``kind``, ``a``, ``b`` (code points) and ``match``.

    Each piece reaches from the end of one match to the end of the next, so places are running lengths. They run inside
    blocks of `BLOCK` pieces, and the blocks' own lengths run once more: an array that grows by one is copied each time.
    """
    shape = "array<struct<kind:string,a:int,b:int,match:string>>"
    none = F.array().cast(shape)
    pieces = F.regexp_extract_all(text, F.lit(rf"\G(?s:.*?)(?:{pattern})"), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def add(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece)
        match = F.regexp_substr(piece, F.lit(pattern))
        one = F.struct(F.lit(kind).alias("kind"), (end - F.length(match)).alias("a"), end.alias("b"), match.alias("match"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    def blocks(x: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1)), F.lit(BLOCK))
        return F.transform(firsts, lambda i: F.aggregate(F.slice(x, i, BLOCK), start, add))

    def moved(found: Column) -> Column:
        before = F.aggregate(
            found, F.array(F.lit(0)), lambda ends, one: F.concat(ends, F.array(F.element_at(ends, -1) + one["at"]))
        )

        def shifted(one: Column, at: Column) -> Column:
            return F.transform(
                one["found"],
                lambda x: F.struct(x["kind"].alias("kind"), (x["a"] + at).alias("a"), (x["b"] + at).alias("b"), x["match"].alias("match")),
            )

        return let(before, lambda at: F.flatten(F.transform(found, lambda one, i: shifted(one, F.get(at, i)))))

    return F.when(text.rlike(pattern), let(let(pieces, blocks), moved)).otherwise(none)


def clear_of(candidates_: Column, others: Column) -> Column:
    """The candidates that meet none of ``others``. Both are sorted and do not overlap among themselves.

    In both sorted together, a candidate's place less its own number is how many of the others begin before it; only the last of
    these and the next one can meet it.
    """
    start = lambda x, last: F.struct(x["a"].alias("a"), F.lit(last).alias("last"))
    both = F.array_sort(F.concat(F.transform(others, lambda x: start(x, 0)), F.transform(candidates_, lambda x: start(x, 1))))
    numbered = F.transform(both, lambda x, i: F.struct(x["last"].alias("last"), i.alias("i")))
    earlier = F.transform(F.filter(numbered, lambda x: x["last"] == 1), lambda x, j: x["i"] - j)

    def met(x: Column, n: Column) -> Column:
        behind = F.coalesce(F.get(others, n - 1)["b"] > x["a"], F.lit(False))
        ahead = F.coalesce(F.get(others, n)["a"] < x["b"], F.lit(False))
        return behind | ahead

    return let(earlier, lambda n: F.filter(candidates_, lambda x, j: ~met(x, F.get(n, j))))


def base_spans(text: Column) -> Column:
    value = lambda x: F.regexp_extract(x["match"], ASSIGN, 2)
    return F.concat(
        F.filter(spans(text, ASSIGN, "assign"), lambda x: F.length(value(x)) >= ASSIGN_LEAST),
        F.filter(spans(text, ACCESS, "access"), lambda x: F.length(x["match"]) >= ACCESS_LEAST),
        spans(text, HEX, "hex"),
    )


def _upper_tail(z: Column) -> Column:
    """P(normal > z), by a logistic curve."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(600.0), z * 1.5976 + z * z * z * 0.07056)))


def _letter_model(alphabet: str, folded: bool) -> tuple[list[float], float, float]:
    """Surprise (in nats) of each character in ordinary text, its mean and its variance."""

    def share(c: str) -> float:
        if c in _DIGITS:
            return 0.03 / 10
        if c.lower() in _FREQUENT:
            letter = 1 / (_FREQUENT.index(c.lower()) + 2)
            return letter * (1 if folded or c in _LOWER else 0.03)
        return 0.005

    total = sum(share(c) for c in alphabet)
    p = [share(c) / total for c in alphabet]
    mean = sum(-x * math.log(x) for x in p)
    return [-math.log(x) for x in p], mean, sum(x * math.log(x) ** 2 for x in p) - mean**2


def _encoding(s: Column) -> Column:
    return (
        F.when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(s.rlike("^[A-Z2-7]+$"), "base32")
        .when(s.rlike("^[0-9a-z]+$"), "base36")
        .otherwise("base64")
    )


def _tested(match: Column, name: str) -> Column:
    """``uniform`` and ``text``: p-values of the battery and of ordinary text, for one encoding."""
    alphabet = ALPHABETS[name]
    m = len(alphabet)
    surprise, mean, variance = _letter_model(alphabet, name in ("hex", "base32"))
    known = F.translate(F.lower(match) if name == "hex" else match, "-_", "+/")
    number = lambda s: F.transform(F.split(s, ""), lambda c: F.position(c, F.lit(alphabet)) - 1)
    signs = F.array(*[F.lit(c) for c in alphabet])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)

    def battery(x: Column) -> Column:
        n = F.size(x).cast("double")
        counts = F.transform(signs, lambda c: F.pow(n - F.length(F.replace(known, c, F.lit(""))), F.lit(2.0)))
        z_chi = (total(counts) * m / n - n - (m - 1)) / F.sqrt(F.lit(2.0 * (m - 1)) * (1 - 1 / n))
        pairs = F.sequence(F.lit(1), F.size(x) - 1)
        side = lambda v: v >= m // 2
        above = F.size(F.filter(x, side)).cast("double")
        both = above * (n - above) * 2
        runs = F.size(F.filter(pairs, lambda i: side(F.get(x, i)) != side(F.get(x, i - 1)))) + 1
        spread = both * (both - n) / (n * n * (n - 1))
        z_runs = F.when(spread > 0, (runs - (1 + both / n)) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(F.lit(99.0))
        middle, square = (m - 1) / 2, (m * m - 1) / 12
        serial = total(F.transform(pairs, lambda i: (F.get(x, i) - middle) * (F.get(x, i - 1) - middle)))
        z_serial = serial / (square * F.sqrt(n - 1))
        least = F.least(_upper_tail(z_chi), 2 * _upper_tail(F.abs(z_runs)), 2 * _upper_tail(F.abs(z_serial)))
        bits = total(F.transform(x, lambda v: F.get(F.array(*[F.lit(s) for s in surprise]), v)))
        z_text = (bits - n * mean) / F.sqrt(n * variance)
        return F.struct(F.least(F.lit(1.0), least * 3).alias("uniform"), _upper_tail(z_text).alias("text"))

    return let(let(known, number), battery)


def candidates(text: Column) -> Column:
    """Runs that may be random, with the p-values of both questions."""
    p = lambda x: F.when(
        _encoding(x["match"]) == "hex", _tested(x["match"], "hex")
    ).when(_encoding(x["match"]) == "base32", _tested(x["match"], "base32")).when(
        _encoding(x["match"]) == "base36", _tested(x["match"], "base36")
    ).otherwise(_tested(x["match"], "base64"))
    return F.transform(
        spans(text, CANDIDATE, "random"),
        lambda x: F.struct(x["kind"].alias("kind"), x["a"].alias("a"), x["b"].alias("b"), p(x).alias("p")),
    )


def _class(length: Column) -> Column:
    out = F.lit(CLASSES[0])
    for least in CLASSES[1:]:
        out = F.when(length >= least, least).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300))))).cast("int")


def discovery_bins(docs: DataFrame) -> dict[int, int]:
    """For each class of length the least bin of p-values that is a discovery.

    The histogram has at most ``len(CLASSES) * (BINS + 1)`` rows, whatever the corpus.
    """
    one = id_and_text(docs).where(F.col("text").rlike(CANDIDATE)).select(F.explode(candidates(F.col("text"))).alias("x"))
    tested = one.select(
        _class(F.col("x.b") - F.col("x.a")).alias("length"), _bin(F.col("x.p.text")).alias("bin"), (F.col("x.p.uniform") >= LEVEL).alias("passed")
    )
    rows = tested.groupBy("length", "bin").agg(
        F.count("*").alias("n"), F.sum(F.col("passed").cast("int")).alias("passed")
    ).collect()
    least = {}
    for length in CLASSES:
        mine = {r["bin"]: r for r in rows if r["length"] == length}
        tests, taken = sum(r["n"] for r in mine.values()), 0
        for b in sorted(mine, reverse=True):
            taken += mine[b]["passed"]
            if 10 ** (-b / 10) <= RATE * taken / max(1, tests):
                least[length] = b
    return least


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``, sorted by start and then by kind, of each document."""
    least = discovery_bins(docs)
    kinds = F.array(*[F.lit(k) for k in ("assign", "access", "hex", "random")])
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))

    def discovered(x: Column) -> Column:
        out = F.lit(False)
        for length, b in least.items():
            out = out | ((_class(x["b"] - x["a"]) == length) & (_bin(x["p"]["text"]) >= b))
        return out & (x["p"]["uniform"] >= LEVEL)

    shape = "array<struct<kind:string,a:int,b:int>>"
    bare = lambda x: F.struct(x["kind"].alias("kind"), x["a"].alias("a"), x["b"].alias("b"))

    def of_kind(base: Column, kind: str) -> Column:
        return F.filter(base, lambda x: x["kind"] == kind)

    def all_spans(base: Column) -> Column:
        free = candidates(F.col("text"))
        for kind in ("assign", "access", "hex"):
            free = let(F.struct(free.alias("free"), of_kind(base, kind).alias("own")), lambda s: clear_of(s["free"], s["own"]))
        more = F.transform(F.filter(free, discovered), bare)
        found = F.concat(F.transform(base, bare), F.when(F.col("text").rlike(CANDIDATE), more).otherwise(F.array().cast(shape)))
        keyed = F.transform(
            found,
            lambda x: F.struct(x["a"].alias("a"), F.array_position(kinds, x["kind"]).alias("k"), x["b"].alias("b"), x["kind"].alias("kind")),
        )
        return F.sort_array(keyed)

    return rows.select("doc_id", let(base_spans(F.col("text")), all_spans).alias("spans"))


def as_text(spans_: Column) -> Column:
    return F.array_join(
        F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["a"].cast("string"), x["b"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    found = secret_spans(docs)
    number = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("bigint")
    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
        number("random").alias("n_random"),
    )
