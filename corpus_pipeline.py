"""From raw documents to a training mix, in five stages. Each is written as Parquet and read again.

Every stage keeps the columns of ``documents``. Line dedup changes ``text`` and ``n_chars``; the others drop rows,
and the last repeats them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontamination, lines, mixing, quality, simhash
from tidewatch.llm.common import table
from tidewatch.session import scratch_path

#: Near-duplicates of the pipeline share 0.8 of their shingles of five words. Such texts differ in at most 48 of 256 bits on
#: average (4 of 5 shingles), with a deviation of 6; the radius keeps those up to 5 deviations off, and their shingles decide.
SHINGLE_WORDS, LANES, RADIUS, SIMILARITY = 5, 4, 80, 0.8


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without cross-site boilerplate lines."""
    return lines.without_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, and of equal ids one row."""
    return simhash.without_near_duplicates(docs, SHINGLE_WORDS, RADIUS, LANES, SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
]

#: Compression and XXH64 have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

