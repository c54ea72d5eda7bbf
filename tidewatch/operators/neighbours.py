"""Exact k-nearest-neighbour join by pivots and blocks.

Comparing every query with every training row as table rows would be a cross
join. Here both sides are packed into blocks of vectors around a few pivots, and
only blocks that can hold a neighbour meet:

* every training row belongs to the cell of its nearest pivot;
* a query's k-th neighbour is at most as far as its k-th nearest row of a small
  fixed sample, which every task holds;
* a query visits a cell only if the half-way plane between that cell's pivot and
  the query's own is within that distance, and meets a block of the cell only if
  the block's distances to the pivot are.

Cells lie side by side on a line that is cut into a few shards of about equal size, so
a crowded cell spans several. A task compares one part of the queries with one shard:
a query is sent once to each shard it has to visit, whatever the number of its cells, and a
training row once to each part of the queries. `grid` chooses both numbers so that the
least travels. A block pair is one small matrix product inside a task. The blocks a query block
meets in a task share the best ``k`` rows found so far, and only those leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.keys import hash_key
from tidewatch.session import shuffle_width

SAMPLE_ROWS = 4096
BLOCK_ROWS = 2048
# Bytes one array of distances or differences may take in a task.
SLICE_BYTES = 64 << 20
# Bytes of distances a block is compared by at once: they stay in a core's cache, so tasks side by side do not wait for memory.
CACHE_BYTES = 1 << 20
# Rows of which a task makes its blocks at once.
GATHER_ROWS = 1 << 16
BLOCK_COLUMNS = "cell int, near double, far double, t_ids array<bigint>, t_labels array<double>, t_vecs binary"
FOUND_COLUMNS = "query_id bigint, train_id bigint, distance double, label double"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _slices(rows: int, width: int) -> Iterator[slice]:
    """Cuts of so many rows that ``width`` doubles for each take at most SLICE_BYTES, and one row at least."""
    step = max(1, SLICE_BYTES // (8 * max(1, width)))
    return (slice(at, at + step) for at in range(0, rows, step))


def _kth_distance(vectors: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """How far each vector's ``k``-th nearest row of the sample is, without bound if the sample is too small."""
    bound = np.full(len(vectors), np.inf)
    if len(sample) >= k:
        for part in _slices(len(vectors), len(sample)):
            bound[part] = np.partition(_distances(vectors[part], sample), k - 1, axis=1)[:, k - 1]
    return bound


def _room(*matrices: np.ndarray) -> float:
    """More than the rounding error of `_distances`: pruning keeps this much extra, so it never loses a neighbour."""
    return 1e-6 * (1.0 + sum(float(np.abs(m).max(initial=0.0)) * np.sqrt(m.shape[1]) for m in matrices))


def gathered(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Batches joined up to GATHER_ROWS rows, and at most about SLICE_BYTES of vectors, so that blocks of a cell fill up."""
    held: list[pd.DataFrame] = []
    rows, limit = 0, max(1, min(GATHER_ROWS, SLICE_BYTES // (8 * max(1, width))))
    for batch in batches:
        if not batch.empty:
            held.append(batch)
            rows += len(batch)
        if rows >= limit:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def plain_vector(df: DataFrame, vector: str) -> Column:
    """The vectors as arrays of floats if they are stored so, else of doubles: they travel in no more bytes than they need."""
    kind = df.select(F.col(vector)).schema[0].dataType
    as_float = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vector).cast("array<float>" if as_float else "array<double>")


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    """Vectors of a block, as doubles. The number of bytes tells floats from doubles."""
    kind = np.float32 if len(data) == 4 * rows * width else np.float64
    return np.frombuffer(data, dtype=kind).reshape(rows, width).astype(np.float64)


def grid(queries: int, train: int, width: int, k: int, tasks: int) -> tuple[int, int]:
    """Shards of the training rows and parts of the queries, about ``tasks`` together, for which the fewest bytes travel.

    A query travels to each shard, and up to ``k`` rows come back from it; a training row travels to each part.
    """
    best = None
    for parts in range(1, max(1, min(tasks, -(-queries // BLOCK_ROWS))) + 1):
        shards = max(1, min(-(-tasks // parts), -(-train // BLOCK_ROWS)))
        cost = shards * queries * (8 * width + 40 * k) + parts * train * 8 * width
        if best is None or (-min(tasks, shards * parts), cost) < best[0]:
            best = (-min(tasks, shards * parts), cost), (shards, parts)
    return best[1]


def cell_shards(shares: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's first and last shard: the cells side by side, as long as their shares, cut into equal pieces."""
    ends = np.cumsum(shares) / max(float(np.sum(shares)), 1e-300)
    starts = np.concatenate([[0.0], ends[:-1]])
    first = np.minimum((starts * shards + 1e-9).astype(np.int64), shards - 1)
    last = np.clip(np.ceil(ends * shards - 1e-9).astype(np.int64) - 1, first, shards - 1)
    return first, last


def _pack_train(pivots: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None):
    """Training rows to blocks of one cell each, cut along the distance to the pivot and dealt out to the cell's shards."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = 0
        for batch in gathered(batches, pivots.shape[1]):
            plain = np.stack(batch["_vec"].to_numpy())
            vectors = plain.astype(np.float64)
            ids, labels = batch["_id"].to_numpy(), batch["_label"].to_numpy(np.float64)
            distance = _distances(vectors, pivots)
            cell, room = distance.argmin(1), _room(vectors, pivots)
            rim = distance[np.arange(len(cell)), cell]
            out = []
            for c in np.unique(cell):
                rows = np.flatnonzero(cell == c)
                rows = rows[np.argsort(rim[rows], kind="stable")]
                size = BLOCK_ROWS
                if first is not None:
                    # No block is so large that the shards of its cell cannot share the cell's rows.
                    size = min(size, max(64, -(-len(rows) // int(last[c] - first[c] + 1))))
                for at in range(0, len(rows), size):
                    part = rows[at : at + size]
                    own = (int(c), rim[part[0]] - room, rim[part[-1]] + room, ids[part], labels[part], plain[part].tobytes())
                    if first is None:
                        out.append(own)
                    else:
                        out.append((int(first[c]) + made % int(last[c] - first[c] + 1), *own))
                    made += 1
            columns = ["cell", "near", "far", "t_ids", "t_labels", "t_vecs"]
            yield pd.DataFrame(out, columns=columns if first is None else ["shard", *columns])

    return pack


def _pack_queries(sample: np.ndarray, pivots: np.ndarray, k: int, first: np.ndarray, last: np.ndarray):
    """Queries to one block per shard in which there is a cell they have to visit."""
    shards = int(last.max()) + 1
    held = np.array([(first <= s) & (s <= last) for s in range(shards)])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in gathered(batches, pivots.shape[1]):
            plain = np.stack(batch["_vec"].to_numpy())
            vectors, ids = plain.astype(np.float64), batch["_id"].to_numpy()
            bound = _kth_distance(vectors, sample, k) + _room(vectors, sample)
            distance = _distances(vectors, pivots)
            visits = (distance - distance.min(1)[:, None]) / 2.0 <= bound[:, None]
            # Queries of one cell stand together, so a block of theirs can leave out the same blocks.
            order = np.lexsort((distance.min(1), distance.argmin(1)))
            out = []
            for s in range(shards):
                visiting = order[visits[order][:, held[s]].any(1)]
                for at in range(0, len(visiting), BLOCK_ROWS):
                    part = visiting[at : at + BLOCK_ROWS]
                    out.append((s, ids[part], bound[part], plain[part].tobytes()))
            yield pd.DataFrame(out, columns=["q_shard", "q_ids", "q_bounds", "q_vecs"])

    return pack


class _Best:
    """The ``k`` best training rows so far of each query in one block."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int):
        self.q_ids, self.q, self.bound, self.k = q_ids, q, np.array(bound), k
        self.squares = (q * q).sum(1)
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))]
        self.waiting = 0

    def add(self, t: np.ndarray, t_ids: np.ndarray, labels: np.ndarray, who: np.ndarray | None = None) -> None:
        """Shortlist by the fast formula, and measure the shortlist exactly. ``who`` are the queries that meet these rows."""
        who = np.arange(len(self.q)) if who is None else who
        if not len(who) or not len(t):
            return
        squares = (t * t).sum(1)
        # |q - t|^2 without |q|^2 is one product: the last column of the queries is 1, that of the rows |t|^2.
        plain = np.column_stack([-2.0 * t, squares])
        # Single precision if the numbers allow it. Its rounding error is at most ``loose``, which widens the shortlist.
        scale = float(np.sqrt(self.squares[who].max()) + np.sqrt(squares.max())) ** 2
        kind = np.float32 if scale < 1e30 else np.float64
        loose = float(np.finfo(kind).eps) * (t.shape[1] + 16) * scale + 1e-30
        across, step = np.ascontiguousarray(plain.T, dtype=kind), max(1, CACHE_BYTES // (kind().itemsize * len(t)))
        room = _room(self.q, t)
        for at in range(0, len(who), step):
            self._add(t, t_ids, labels, who[at : at + step], across, loose, room)

    def _add(
        self, t: np.ndarray, t_ids: np.ndarray, labels: np.ndarray, who: np.ndarray, across: np.ndarray, loose: float, room: float
    ) -> None:
        q, own, bound = self.q[who], self.squares[who], self.bound[who]
        left = np.ones((len(who), q.shape[1] + 1), dtype=across.dtype)
        left[:, :-1] = q
        rest = left @ across
        open_ = np.flatnonzero(np.isinf(bound))
        if len(open_) and len(t) > self.k:
            # Without a bound so far, the k-th of these rows is one.
            kth = np.partition(rest[open_], self.k - 1, axis=1)[:, self.k - 1].astype(np.float64)
            bound[open_] = np.sqrt(np.maximum(kth + own[open_] + loose, 0.0)) + 2 * room
            self.bound[who[open_]] = bound[open_]
        # Rounded up, so that the comparison itself loses none.
        limit = np.nextafter(((bound + 2 * room) ** 2 - own + loose).astype(across.dtype), np.inf, dtype=across.dtype)
        rows, columns = np.divmod(np.flatnonzero(rest <= limit[:, None]), len(t))
        if not len(rows):
            return
        exact = np.empty(len(rows))
        for part in _slices(len(rows), t.shape[1]):
            exact[part] = np.sqrt(((t[columns[part]] - q[rows[part]]) ** 2).sum(1))
        self.found.append((who[rows], t_ids[columns], exact, labels[columns]))
        self.waiting += len(rows)
        if self.waiting >= self.k * len(self.q):
            self._settle()

    def _settle(self) -> None:
        """Keep the best, and let them bound what comes."""
        rows, ids, far, labels = (np.concatenate(parts) for parts in zip(*self.found, strict=True))
        order = np.lexsort((ids, far, rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        order, rows, last = order[place < self.k], rows[place < self.k], place[place < self.k] == self.k - 1
        self.found, self.waiting = [(rows, ids[order], far[order], labels[order])], 0
        self.bound[rows[last]] = np.minimum(self.bound[rows[last]], far[order][last])

    def frame(self) -> pd.DataFrame:
        self._settle()
        rows, ids, far, labels = self.found[0]
        return pd.DataFrame({"query_id": self.q_ids[rows], "train_id": ids, "distance": far, "label": labels})


def matched(k: int, width: int, chooser: Callable) -> Callable:
    """The ``k`` best training rows for each query of a block, over the training blocks it comes with.

    ``chooser`` takes the first row of a query block and its vectors; what it returns takes a training block's row and the bounds
    so far, and says which of the queries meet the block. A merge join gives the pairs of one query block in
    a row, so they share one shrinking bound; pairs in any other order only give some more candidates.
    """

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, meets, shard = None, None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids, t_ids = np.asarray(row.q_ids), np.asarray(row.t_ids)
                # One task may hold several shards, to which the same queries were sent.
                if best is None or row.q_shard != shard or not np.array_equal(best.q_ids, q_ids):
                    if best is not None:
                        yield best.frame()
                    shard = row.q_shard
                    q = unpacked(row.q_vecs, len(q_ids), width)
                    best = _Best(q_ids, q, np.asarray(row.q_bounds) if "q_bounds" in batch.columns else np.full(len(q), np.inf), k)
                    meets = chooser(row, q)
                who = np.flatnonzero(meets(row, best.bound))
                if len(who):
                    best.add(unpacked(row.t_vecs, len(t_ids), width), t_ids, np.asarray(row.t_labels), who)
        if best is not None:
            yield best.frame()

    return match


def _near_cells(pivots: np.ndarray) -> Callable:
    """Queries whose bound reaches over the half-way plane to a block's cell, and to the block's distances from its pivot."""

    def of_block(_row, q: np.ndarray) -> Callable:
        distance, room = _distances(q, pivots), _room(q, pivots)
        half_way = (distance - distance.min(1)[:, None]) / 2.0

        def meets(row, bound: np.ndarray) -> np.ndarray:
            reach, at = bound + 2 * room, distance[:, row.cell]
            return (half_way[:, row.cell] <= reach) & (at - reach <= row.far) & (at + reach >= row.near)

        return meets

    return of_block


def paired(sent: DataFrame, dealt: DataFrame, parts: int, tasks: int) -> DataFrame:
    """Every query block of a shard beside every training block of it, one task for each shard and part of the queries."""
    part = F.pmod(F.xxhash64("q_shard", F.element_at("q_ids", 1)), F.lit(parts)).cast("int")
    # The blocks are small in bytes but heavy to compare, so they must not be merged into fewer tasks by size.
    left = sent.withColumn("q_part", part).repartition(tasks, "q_shard", "q_part")
    right = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(tasks, "shard", "part")
    # Packed rows are far larger than Catalyst's estimate for them, so a merge join is
    # asked for: a broadcast would be chosen on a size nobody has checked.
    return left.join(right.hint("merge"), (F.col("shard") == F.col("q_shard")) & (F.col("part") == F.col("q_part")))


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("distance", "train_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def nearest(
    train: DataFrame,
    queries: DataFrame,
    k: int = 21,
    id_column: str = "id",
    vector: str = "embedding",
    label: str = "label",
    pivots: int = 16,
    spread: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest training rows of every query, ties by training id.

    Returns query_id, train_id, distance, label, rank (from 1). Ids are bigint
    and unique on each side; vectors have one length. The training rows are dealt out to ``spread`` shards, to
    each of which a query is sent once at most, and each shard to as many parts of the queries as keep all shuffle
    partitions busy. By default `grid` chooses both from the numbers of rows, which are counted.
    """
    if k < 1 or not 1 <= pivots <= SAMPLE_ROWS or (spread is not None and spread < 1):
        raise ValueError(f"k and spread must be at least 1, pivots between 1 and {SAMPLE_ROWS}")
    rows = train.select(
        F.col(id_column).cast("bigint").alias("_id"),
        plain_vector(train, vector).alias("_vec"),
        F.col(label).cast("double").alias("_label"),
    )
    asked = queries.select(F.col(id_column).cast("bigint").alias("_id"), plain_vector(queries, vector).alias("_vec"))
    # A fixed number of vectors comes to the driver and goes to every task.
    drawn = rows.orderBy(hash_key(seed, "_id"), "_id").limit(SAMPLE_ROWS).select("_vec").collect()
    schema = "query_id bigint, train_id bigint, distance double, label double, rank int"
    if not drawn:
        return train.sparkSession.createDataFrame([], schema)
    sample = np.array([r["_vec"] for r in drawn], dtype=np.float64)
    centres, width = sample[:pivots], sample.shape[1]
    tasks = shuffle_width(train.sparkSession)
    if spread is None:
        shards, parts = grid(asked.count(), rows.count(), width, k, tasks)
    else:
        shards, parts = spread, max(1, -(-tasks // spread))
    shares = np.bincount(np.concatenate([_distances(sample[s], centres).argmin(1) for s in _slices(len(sample), pivots)]), minlength=len(centres))
    first, last = cell_shards(shares, shards)
    packed_train = rows.mapInPandas(_pack_train(centres, first, last), f"shard int, {BLOCK_COLUMNS}")
    packed_queries = asked.mapInPandas(
        _pack_queries(sample, centres, k, first, last), "q_shard int, q_ids array<bigint>, q_bounds array<double>, q_vecs binary"
    )
    pairs = paired(packed_queries, packed_train, parts, shards * parts)
    pairs = pairs.select("q_shard", "q_ids", "q_bounds", "q_vecs", "cell", "near", "far", "t_ids", "t_labels", "t_vecs")
    return ranked(pairs.mapInPandas(matched(k, width, _near_cells(centres)), FOUND_COLUMNS), k)


def knn_proba(
    train: DataFrame,
    queries: DataFrame,
    k: int = 21,
    id_column: str = "id",
    vector: str = "embedding",
    label: str = "label",
    **options,
) -> DataFrame:
    """Share of class 1 among the ``k`` nearest training rows, per query."""
    found = nearest(train, queries, k, id_column, vector, label, **options)
    return found.groupBy(F.col("query_id").alias(id_column)).agg(F.avg("label").alias("probability"))
