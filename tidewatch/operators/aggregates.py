"""Aggregations: mean embeddings, deduplication, counts and profiles."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Groups whose running sums a task holds.
HELD = 4_096


def dedup(df: DataFrame, keys: list[str], order: list[Column] | None = None, keep: str = "first") -> DataFrame:
    """One row per key. Null keys count as one key.

    With ``order`` the first (or last) row in that order is kept, whatever the
    partitioning. It is an aggregate and not a ranked window, so every task
    reduces its own rows to one per key before the shuffle, a hot key included.
    """
    if order is None:
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in others or keys])
    # The hash of the whole row settles ties, so copies that differ elsewhere do not depend on the partitioning.
    place = F.struct(*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    pick = F.min_by(row, place) if keep == "first" else F.max_by(row, place)
    kept = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick.alias("_row"))
    # The keys come from the grouping, so a join on them needs no further shuffle.
    return kept.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def dedup_located(df: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """`dedup` of a table read from files, whose other columns may be wide: they are not aggregated.

    Candidates carry the keys, the order, a hash of the row and the row's place in its file. The winners' places bring back
    their rows by a join on the keys alone, so what follows on the keys needs no further shuffle; if the winners are
    few, Spark sends them to the rows and nothing wide is moved.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    narrow = F.struct(*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), *place)
    names = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    pick = F.min("_place") if keep == "first" else F.max("_place")
    best = df.select(*names, narrow.alias("_place")).groupBy(*[f"_key{i}" for i in range(len(keys))]).agg(pick.alias("_best"))
    winners = best.select(*[f"_key{i}" for i in range(len(keys))], F.col("_best.file").alias("_file"), F.col("_best.row").alias("_row"))
    rows = df.select("*", *[c.alias(f"_own_{c_name}") for c, c_name in zip(place, ("file", "row"), strict=True)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    # Not as equalities, which would become keys of the join and of its shuffle.
    same += [F.col("_own_file").between(F.col("_file"), F.col("_file")), F.col("_own_row").between(F.col("_row"), F.col("_row"))]
    return rows.join(winners, functools.reduce(Column.__and__, same), "left_semi").drop("_own_file", "_own_row")


def _vector_sums(batch: pa.RecordBatch, keys: list[str], vector: str) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, np.ndarray]]:
    """For each group of a batch its key, and by position the sum, the number of values and that of rows."""
    vectors = batch.column(vector)
    held = pc.and_(pc.is_valid(vectors), pc.greater(pc.fill_null(pc.list_value_length(vectors), 0), 0))
    batch = batch.filter(held)
    if not len(batch):
        return
    vectors = batch.column(vector)
    code = np.zeros(len(batch), dtype=np.int64)
    for k in keys:
        column = batch.column(k).dictionary_encode(null_encoding="encode")
        code = np.unique(code * len(column.dictionary) + column.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) != 0]))
    sizes = np.diff(np.concatenate([starts, [len(order)]]))
    lengths = pc.list_value_length(vectors).to_numpy()
    flat = vectors.flatten()
    width = int(lengths.max())
    if flat.null_count == 0 and (lengths == width).all():
        matrix = flat.to_numpy().reshape(-1, width)
        sums = np.add.reduceat(matrix[order], starts, axis=0, dtype=np.float64)
        rows = values = np.repeat(sizes[:, None], width, axis=1)
    else:
        # Vectors of several lengths or with nulls: by group and position.
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.repeat(np.arange(len(starts)), sizes)
        begins = np.cumsum(lengths) - lengths
        cell = np.repeat(group * width - begins, lengths) + np.arange(len(flat))
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        numbers = flat.fill_null(0).to_numpy().astype(np.float64)
        n = len(starts) * width
        sums, values, rows = (np.bincount(cell, w, n).reshape(-1, width) for w in (numbers, known.astype(np.float64), None))
    chosen = batch.select(keys).take(pa.array(order[starts]))
    names = zip(*[c.to_pylist() for c in chosen.columns], strict=True)
    yield from zip(names, sums, values, rows, strict=True)


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return a if len(a) == width else np.concatenate([a, np.zeros(width - len(a), dtype=a.dtype)])


def _merged(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    width = max(len(a[0]), len(b[0]))
    return [_padded(x, width) + _padded(y, width) for x, y in zip(a, b, strict=True)]


def mean_embedding(df: DataFrame, keys: list[str], vector: str = "docembed") -> DataFrame:
    """Element-wise mean vector per group, with the number of rows behind it.

    Each task keeps a running sum vector and count per group (`HELD` groups at most, then it hands them on), so a hot group
    costs one vector a task in the shuffle. Partial sums are sorted by key and merged as they stream by. Null
    elements count as rows but not in the mean; null and empty vectors are no rows.
    """
    plain = [f"_k{i}" for i in range(len(keys))]
    kinds = [df.schema[k].dataType.simpleString() for k in keys]
    shape = ", ".join([*[f"{n} {kind}" for n, kind in zip(plain, kinds, strict=True)], "s array<double>, v array<double>, n array<double>"])

    def as_batch(schema: pa.Schema, groups: dict[tuple, list[np.ndarray]]) -> pa.RecordBatch:
        columns = [pa.array(list(c), schema.field(n).type) for n, c in zip(plain, zip(*groups, strict=True), strict=True)]
        parts = [pa.array([g[i].astype(np.float64) for g in groups.values()], pa.list_(pa.float64())) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, *parts], names=[*plain, "s", "v", "n"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, list[np.ndarray]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for key, *parts in _vector_sums(batch, plain, "_vector"):
                groups[key] = _merged(groups[key], parts) if key in groups else parts
            if len(groups) > HELD:
                yield as_batch(schema, groups)
                groups = {}
        if groups:
            yield as_batch(schema, groups)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            done: dict[tuple, list[np.ndarray]] = {}
            names = list(zip(*[batch.column(n).to_pylist() for n in plain], strict=True))
            columns = [batch.column(c) for c in ("s", "v", "n")]
            for i, name in enumerate(names):
                parts = [c[i].values.to_numpy() for c in columns]
                if total is not None and name == key:
                    total = _merged(total, parts)
                else:
                    if total is not None:
                        done[key] = total
                    key, total = name, parts
            if done:
                yield as_batch(batch.schema, done)
            schema = batch.schema
        if total is not None:
            yield as_batch(schema, {key: total})

    narrow = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, plain, strict=True)], F.col(f"`{vector}`").alias("_vector"))
    partial = narrow.mapInArrow(add_up, shape)
    whole = partial.repartition(*plain).sortWithinPartitions(*plain).mapInArrow(merge, shape)
    mean = F.zip_with("s", "v", lambda s, v: F.when(v > 0, s / v))
    return whole.select(
        *[F.col(n).alias(k) for k, n in zip(keys, plain, strict=True)], mean.alias(vector), F.array_max("n").cast("bigint").alias("n_articles")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count()


def nunique(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, all columns in one pass."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(f"`{c}`")).alias(c) for c in columns])


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls and their share. One pass over the table."""
    columns = columns or df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    return counted.select("n_rows", F.inline(per_column)).select(
        "column", "n_rows", "nulls", F.try_divide(F.col("nulls"), F.col("n_rows")).alias("null_share")
    )


def min_support(df: DataFrame, key: str, n: int = 30) -> DataFrame:
    """Rows of the keys that have more than ``n`` rows.

    Counting and a semi join, so that no task has to hold a whole group.
    """
    enough = df.groupBy(key).count().where(F.col("count") > n).select(key)
    return df.join(enough, key, "left_semi")


def accuracy_by(df: DataFrame, key: str, truth: str, predicted: str) -> DataFrame:
    """Share of right predictions per key."""
    right = (F.col(truth).cast("int") == F.col(predicted).cast("int")).cast("int")
    return df.groupBy(key).agg(F.avg(right).alias("accuracy"))


def any_conflict(df: DataFrame, key: str = "country", flag: str = "spike") -> DataFrame:
    """1 for a key with at least one flagged row, else 0."""
    return df.groupBy(key).agg(F.coalesce(F.max(F.col(flag).cast("int")), F.lit(0)).alias("any_conflict"))


def expect_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while another action runs; see `assert_rows`."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


def assert_rows(seen: Observation, name: str) -> int:
    """The observed row count; raises when the output was empty."""
    rows = seen.get["row_count"]
    if not rows:
        raise ValueError(f"{name}: expected rows, got none")
    return rows
