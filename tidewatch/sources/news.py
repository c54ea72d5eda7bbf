"""Article metadata and article embeddings, one file per 15 minutes and feed."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.dates import parse_iso
from tidewatch.functions.keys import chosen, hash_key
from tidewatch.functions.text import feed_stamp, without_undecodable
from tidewatch.schemas import ARTICLE_COLUMNS, ARTICLE_INTEGER_COLUMNS, ARTICLE_KEPT, EMBEDDING_SCHEMA
from tidewatch.sources.granules import granule_batches

# A granule that is missing or cut off gives the rows that can be read. `missing_granules`
# lists those that gave none, `granule_report` those that were cut off or hold spoiled lines or objects.
TOLERANT = {"ignoreMissingFiles": "true", "ignoreCorruptFiles": "true"}


#: Files that only Spark inflates. Gzip and plain files are read as bytes.
_OTHER_CODECS = r"\.(bz2|deflate|lz4|snappy|zst|zstd)$"


def _options(tolerant: bool) -> dict[str, str]:
    return TOLERANT if tolerant else {}


def _sampled(df: DataFrame, p: float, seed: int) -> DataFrame:
    """Keep a share of the granules. Spark prunes files by a filter on file metadata."""
    if p >= 1:
        return df
    return df.where(chosen(hash_key(seed, feed_stamp(F.col("_metadata.file_path"))), p))


def read_articles(
    spark: SparkSession,
    path: str | list[str],
    keep_all: bool = False,
    tolerant: bool = True,
    p: float = 1.0,
    seed: int = 4,
) -> DataFrame:
    """Tab-separated article metadata without a header.

    Fields are taken by position and quotes mean nothing. Lines with too many
    fields are dropped, short ones padded with nulls, undecodable bytes removed,
    malformed integers read as null. ``granule`` is the stamp of the file.
    """
    lines = spark.read.options(lineSep="\n", **_options(tolerant)).text(path)
    lines = _sampled(lines, p, seed).select("value", feed_stamp(F.col("_metadata.file_path")).alias("granule"))
    text = without_undecodable(F.rtrim(F.col("value"), F.lit("\r")))
    # The part before the 28th field is the whole line, unless there are too many fields.
    few_enough = F.col("value") == F.substring_index("value", "\t", len(ARTICLE_COLUMNS))
    fields = lines.where(few_enough).select(F.split(text, "\t").alias("f"), "granule")
    wanted = ARTICLE_COLUMNS if keep_all else ARTICLE_KEPT
    columns = []
    for i, name in enumerate(ARTICLE_COLUMNS):
        if name in wanted:
            value = F.nullif(F.get("f", F.lit(i)), F.lit(""))
            kind = ARTICLE_INTEGER_COLUMNS.get(name)
            columns.append((value.try_cast(kind) if kind else value).alias(name))
    return fields.select(*columns, "granule")


def typed_articles(rows: DataFrame, keep_all: bool = False) -> DataFrame:
    """Article rows of the granule source with their types, and only the columns later stages read."""
    kinds = {c: F.col(c).try_cast(kind) for c, kind in ARTICLE_INTEGER_COLUMNS.items()}
    return drop_unused(rows.withColumns(kinds), keep_all)


def typed_embeddings(rows: DataFrame, keep_all: bool = False) -> DataFrame:
    """Embedding rows of the granule source with their types."""
    parsed = rows.withColumn("date", parse_iso("date"))
    return parsed if keep_all else parsed.drop("model")


def drop_unused(df: DataFrame, keep_all: bool = False) -> DataFrame:
    """Drop the metadata columns no later stage reads."""
    if keep_all:
        return df
    return df.drop(*[c for c in ARTICLE_COLUMNS if c not in ARTICLE_KEPT])


def _batches(batches: Iterator[pa.RecordBatch], tolerant: bool, counts: bool, feed: str = "embeddings") -> Iterator[pa.RecordBatch]:
    """Rows or counts of the files of a binary or whole-text read, a file at a time."""
    for batch in batches:
        for content, granule in zip(batch.column(0), batch.column(1), strict=True):
            for part in granule_batches(feed, granule.as_py(), [content.as_buffer().to_pybytes()]):
                if part.column("kind")[0].as_py() == "count":
                    if counts:
                        yield part.select(["granule", "read", "rejected", "complete"])
                    elif not (tolerant or part.column("complete")[0].as_py()):
                        raise ValueError(f"granule {granule} ends early or is broken")
                elif not counts:
                    yield part.select([*EMBEDDING_SCHEMA.fieldNames(), "granule"])


def read_article_embeddings(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "auto",
    keep_all: bool = False,
    tolerant: bool = True,
    p: float = 1.0,
    seed: int = 4,
) -> DataFrame:
    """Gzip JSON article embeddings.

    ``layout="auto"`` opens each file once and decodes it as a whole, one file at a time: objects back to back, one to a
    line or over several, and of a file that ends early or has spoiled objects all that can be read, as
    `granule_report` counts it. ``"lines"`` reads one object per line inside the JVM, for feeds known to be whole; of a file that
    ends early it may miss the last lines before the cut. With ``tolerant=False`` such files are an error.
    `granules.read_granules` reads a span of days and gives the counts in the same pass.
    """
    options = _options(tolerant)
    stamp = feed_stamp(F.col("_metadata.file_path")).alias("granule")
    if layout == "lines":
        bad_lines = "DROPMALFORMED" if tolerant else "FAILFAST"
        read = spark.read.options(**options).schema(EMBEDDING_SCHEMA).json(path, mode=bad_lines)
        rows = _sampled(read, p, seed).select(*EMBEDDING_SCHEMA.fieldNames(), stamp)
    elif layout == "auto":
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EMBEDDING_SCHEMA) + ", granule string"
        decode = functools.partial(_batches, tolerant=tolerant, counts=False)
        other = F.col("_metadata.file_path").rlike(_OTHER_CODECS)
        files = _sampled(spark.read.format("binaryFile").options(**options).load(path), p, seed).where(~other)
        # What Arrow does not inflate, Spark does.
        texts = _sampled(spark.read.options(**options).text(path, wholetext=True), p, seed).where(other)
        rows = files.select("content", stamp).mapInArrow(decode, schema).unionByName(
            texts.select(F.col("value").cast("binary"), stamp).mapInArrow(decode, schema)
        )
    else:
        raise ValueError("layout must be 'auto' or 'lines'")
    return typed_embeddings(rows, keep_all)


def missing_granules(expected: DataFrame, read: DataFrame, granule: str = "granule") -> DataFrame:
    """Expected granules that gave no row: the quarantine list of an ingest."""
    return expected.select(granule).distinct().join(read.select(granule).distinct(), granule, "left_anti")


def granule_report(spark: SparkSession, path: str | list[str], feed: str = "embeddings") -> DataFrame:
    """What can be read of each granule: ``granule``, ``read``, ``rejected`` and ``complete``.

    ``rejected`` counts spoiled objects (``feed="embeddings"``) or lines with too many fields
    (``"articles"``); ``complete`` is false where a gzip file ends early. One pass over the files, a
    granule at a time.
    """
    files = spark.read.format("binaryFile").load(path).select("content", feed_stamp(F.col("path")).alias("granule"))
    run = functools.partial(_batches, tolerant=True, counts=True, feed=feed)
    return files.mapInArrow(run, "granule string, read bigint, rejected bigint, complete boolean")
