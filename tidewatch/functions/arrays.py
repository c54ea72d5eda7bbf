"""Array, vector and matrix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_distinct(values: Column | str, n: int | None = None) -> Column:
    """Distinct items in order of first appearance; with ``n`` at most so many."""
    found = F.array_distinct(_col(values))
    return found if n is None else F.slice(found, 1, n)


def item(values: Column | str, index: int) -> Column:
    """The 0-based item, null past the end."""
    return F.get(_col(values), F.lit(index))


def widen(df: DataFrame, column: str, width: int, prefix: str | None = None) -> DataFrame:
    """One array column to ``width`` scalar columns ``prefix-0`` .. in a single projection."""
    prefix = prefix or column
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*kept, *[F.get(F.col(column), F.lit(i)).alias(f"{prefix}-{i}") for i in range(width)])


def columns_like(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def narrow(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Scalar columns back to one array column, in the order given."""
    gone = set(columns)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in gone]
    return df.select(*kept, F.array(*[F.col(f"`{c}`") for c in columns]).alias(name))


def pad_rows(matrix: Column | str, rows: int, width: int) -> Column:
    """Append zero rows until the matrix has ``rows`` rows; longer ones are kept as they are."""
    matrix = _col(matrix)
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    missing = F.greatest(F.lit(rows) - F.size(matrix), F.lit(0))
    return F.concat(matrix, F.array_repeat(zero, missing))


def reshape(values: Column | str, height: Column | int, width: Column | int) -> Column:
    """Flat values to ``height`` rows of ``width`` values."""
    values = _col(values)
    height = F.lit(height) if isinstance(height, int) else height
    width = F.lit(width) if isinstance(width, int) else width
    starts = F.when(height > 0, F.sequence(F.lit(0), height.cast("int") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.slice(values, i * width.cast("int") + 1, width.cast("int")))


def mean_vectors(*vectors: Column | str) -> Column:
    """Element-wise mean of arrays of one length."""
    total = _col(vectors[0])
    for vector in vectors[1:]:
        total = F.zip_with(total, _col(vector), lambda a, b: a + b)
    return F.transform(total, lambda x: x / F.lit(float(len(vectors))))


def argmax(vector: Column | str) -> Column:
    """0-based place of the largest item; the first one on a tie."""
    vector = _col(vector)
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")
