"""Prepared tables: parquet, CSV and training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.joins import apply_overrides
from tidewatch.operators.panel import conflict_months
from tidewatch.operators.samples import as_matrix
from tidewatch.schemas import CONFLICT_SCHEMA, COUNTRY_CODE_SCHEMA, LABEL_SCHEMA


def read_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    where: Column | str | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """A parquet table: some columns, some rows, some ``year``/``month`` folders."""
    df = spark.read.parquet(path)
    if year is not None:
        df = df.where(F.col("year") == year)
    if month is not None:
        df = df.where(F.col("month") == month)
    if where is not None:
        df = df.where(where)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_many(spark: SparkSession, glob: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """All CSV files of a pattern as one table, with a stated schema."""
    return spark.read.csv(glob, schema=schema, header=header)


def read_conflict(spark: SparkSession, path: str) -> DataFrame:
    """Monthly conflict counts with month number, quarter and date; CSV or parquet."""
    if path.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.csv(path, schema=CONFLICT_SCHEMA, header=True)
    return conflict_months(raw)


def country_codes(spark: SparkSession, path: str) -> DataFrame:
    """The country-code list with the manual codes applied."""
    return apply_overrides(spark.read.csv(path, schema=COUNTRY_CODE_SCHEMA, header=True))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=LABEL_SCHEMA, header=True)


def read_country_months(spark: SparkSession, path: str, country: str, months: list[str]) -> DataFrame:
    """Rows of one country and some ``YYYYMM`` months; both are folders, so nothing else is read."""
    stacked = spark.read.parquet(path)
    return stacked.where((F.col("country") == country) & F.col("yearmonth").cast("string").isin(months))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Training samples, with their values as a (height, width) matrix."""
    return as_matrix(spark.read.parquet(path))
