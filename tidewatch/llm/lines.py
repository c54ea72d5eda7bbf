"""Line dedup by distinct-site spread, in DataFrame functions only.

A line is boilerplate when it stands on at least ``min_sites`` sites. A HyperLogLog sketch of the
sites is kept for the hash of each line and merged by the aggregation. Lines whose estimate is within
`NEAR` of the threshold get an exact count; for the rest the estimate is many standard errors away.
Boilerplate goes from every row but the first that has it, so the text itself is not lost, and of documents
that are copies of each other one stays whole. The first row is that with the smallest id, null last, and of one id
that with the smallest hash of site and text.

Boilerplate is written before it is joined, so Spark knows its size: a table within its broadcast threshold is sent to
the lines, a larger one is merged with them.

Lines are compared without blanks at their ends; empty lines are never boilerplate and stay.
Odd input: a null text has no lines and stays null; a null source is a site of its own; rows without an id,
or with one id, are judged each on their own; rows equal in id, source and text are one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

MIN_SITES = 10
#: Size of a sketch (2**10 registers, a standard error of 3.3 %) and the band around the threshold, six errors wide.
SKETCH, NEAR = 10, 0.2
_BLANK = " \t\x0b\x0c\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


def _site() -> Column:
    # A null site is told from every name by its prefix.
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))


def _row() -> Column:
    """What tells rows apart, smallest first: the id (null last), and a hash of site and text."""
    doc_id = F.col("doc_id").cast("bigint")
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), F.xxhash64(_site(), F.col("text").cast("string")).alias("key"))


def _lines(docs: DataFrame) -> DataFrame:
    """``row``, ``site``, ``line`` (a hash) and its ``place`` of all lines that are not blank."""
    rows = docs.select(_row().alias("row"), _site().alias("site"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("place", "line"))
    bare = rows.withColumn("line", _bare(F.col("line"))).where("line <> ''")
    return bare.withColumn("line", F.xxhash64("line"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line`` (a hash) and ``first_row`` of the lines on at least ``min_sites`` sites."""
    lines = _lines(docs)
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH)).alias("sites"), F.min("row").alias("first_row")
    )
    some = stored(spread.where(F.col("sites") >= min_sites * (1 - NEAR)), "spread-lines")
    near = some.where(F.col("sites") <= min_sites * (1 + NEAR))
    counted = (
        lines.join(near.select("line"), "line", "left_semi")
        .groupBy("line", "site").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count("one").alias("n"))
        .where(F.col("n") >= min_sites)
    )
    sure = some.where(F.col("sites") > min_sites * (1 + NEAR))
    exact = near.join(counted, "line", "left_semi")
    return stored(sure.select("line", "first_row").unionByName(exact.select("line", "first_row")), "boilerplate")


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, counts: bool = False) -> DataFrame:
    """All columns of the documents, ``text`` without boilerplate and ``n_chars``, if there, its new length;
    with ``counts`` also ``n_lines`` and ``n_removed``, of lines that are not blank."""
    found = _lines(docs).join(boilerplate(docs, min_sites), "line").where(F.col("row") != F.col("first_row"))
    gone = found.groupBy("row").agg(F.collect_set("place").alias("gone"))
    own = docs.select(F.struct("*").alias("doc"), _row().alias("own_row"))
    # Ids may be null: the struct is compared as a whole, and its null id is told by no_id.
    same = own["own_row"].eqNullSafe(gone["row"])
    met = own.join(gone, same, "left").withColumn("lines", F.split(F.col("doc.text").cast("string"), "\n"))
    # Places left, in order: in proportion to the lines, however many go.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.transform(left, lambda i: F.get(F.col("lines"), i))
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(F.array_join(kept, "\n"))
    full = F.size(F.filter("lines", lambda x: _bare(x) != ""))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("gone").isNotNull(), F.length(text).cast("bigint")).otherwise(F.col("doc.n_chars"))
    n_lines = F.when(F.col("doc.text").isNotNull(), full).otherwise(0)
    n_removed = F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0)
    shown = [n_lines.cast("bigint").alias("n_lines"), n_removed.cast("bigint").alias("n_removed")]
    return met.select(*[columns.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns], *(shown if counts else []))
