"""SimHash near-duplicates with pivot distance tables.

Every text gets a fingerprint of 64 bits or a multiple. Equal fingerprints are
merged first, so copies never meet as pairs. Distinct fingerprints that may be
near meet in small blocks; inside a block each carries its Hamming distances to
many reference fingerprints, a pair whose distances to any reference differ by
more than the radius is discarded (triangle inequality), and the rest are
verified bit by bit. Links go into a distributed connected-components run.

A table of pivot distances alone has no key to shuffle by, so the blocks come from

* `block_keys`, exact: with ``radius`` differing bits, two of ``radius + 2`` parts
  of the fingerprint are equal, whichever pair it is;
* `anchor keys`, for a similarity of shingles instead of a radius of few bits: the
  smallest shingle hash of each of `ANCHORS` classes. Texts with similarity ``s``
  miss all of them with probability ``(1 - s) ** ANCHORS``, 3e-6 at 0.8. They add to the exact blocks of the
  first lane, in which pivots and bits find all pairs within `FIRST_LANE_RADIUS`, and replace nothing.

For a similarity the bits are an estimate only. They choose components of texts that may be
similar, and inside each of these the shingles themselves decide which texts are linked.

Results for odd input: a null or blank text has the fingerprint zero and links like
any other; equal rows each come back; a null id is never the smallest of its
component unless all are null; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, keyed, same_row, stored
from tidewatch.llm.words import mixed

ANCHORS = 8
#: With several lanes the radius is too wide for a pivot to discard much; a few are enough.
PIVOTS, PIVOTS_WIDE = 24, 4
#: Differing bits of the first lane within which texts meet by their fingerprints alone, as in op10.
FIRST_LANE_RADIUS = 4
#: Groups up to this size are compared by shifting, all at once; larger ones by growing components.
SMALL_GROUP = 48
#: Groups beyond this many rows are split, and each two of their parts compared on their own.
GROUP_ROWS = 20_000
#: The same for groups that carry their shingles, counted in shingles: 80 MB of hashes.
GROUP_SHINGLES = 10_000_000


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of all runs of ``size`` lower-cased words; of the whole text if it has fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(size, len(words)) - 1 :]
    return np.array([digest(line[a:b], 42) for a, b in zip(starts, ends, strict=False)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """Majority bits of the hashes, 64 a lane; further lanes mix the hashes anew."""
    out = np.zeros(lanes, dtype=np.uint64)
    for lane in range(lanes if len(hashes) else 0):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at : at + (1 << 14)]
            part = mixed(part + np.uint64((lane * 0x9E3779B97F4A7C15) % (1 << 64))) if lane else part
            rows = np.ascontiguousarray(part.astype("<u8")).view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[lane] = np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(
    docs: DataFrame,
    shingle_words: int = 4,
    lanes: int = 1,
    anchors: bool = False,
    shingles: bool = False,
    row_keys: bool = False,
) -> DataFrame:
    """``doc_id``, ``fp`` (array of 64-bit lanes) and, if asked for, ``row_key``, ``anchors`` and ``shingles`` of each row.

    With one lane repeated shingles count as often as they occur; with more, fingerprints are of
    the set of shingles, whose similarity they are to estimate.
    """
    lists = ["fp", *["anchors"] * anchors, *["shingles"] * shingles]
    own = ["doc_id", *["row_key"] * row_keys]
    out = pa.schema([*[(name, pa.int64()) for name in own], *[(name, pa.list_(pa.int64())) for name in lists]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {name: [] for name in lists}
            for text in batch.column("text"):
                h = shingle_hashes(text.as_py(), shingle_words)
                h = np.unique(h) if lanes > 1 else h
                made["fp"].append(fingerprint(h, lanes).view(np.int64))
                if anchors:
                    group = h % np.uint64(ANCHORS)
                    least = [h[group == g].min() for g in range(ANCHORS) if (group == g).any()]
                    # The class is part of the key already: it is the hash's remainder.
                    made["anchors"].append(np.array(least or [0], dtype=np.uint64).view(np.int64))
                if shingles:
                    made["shingles"].append(np.sort(np.unique(h).view(np.int64)))
            columns = [pa.array(made[name], pa.list_(pa.int64())) for name in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in own], *columns], schema=out)

    kind = ", ".join([*[f"{name} bigint" for name in own], *[f"{name} array<bigint>" for name in lists]])
    return (keyed(docs) if row_keys else id_and_text(docs)).mapInArrow(run, kind)


def block_keys(radius: int) -> list[Column]:
    """Keys of which two 64-bit fingerprints share at least one if they differ in at most ``radius`` bits."""
    parts = radius + 2
    cuts = [64 * i // parts for i in range(parts + 1)]
    fp = F.col("fp")[0]
    cut = [
        F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in itertools.pairwise(cuts)
    ]
    return [
        F.struct(F.lit(n).alias("band"), cut[i].alias("x"), cut[j].alias("y"))
        for n, (i, j) in enumerate(itertools.combinations(range(parts), 2))
    ]


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (rows of lanes) to all pivots."""
    return np.stack(
        [np.bitwise_count(fps ^ p).sum(axis=1, dtype=np.int16) for p in pivots], axis=1
    )


def _pivots(lanes: int) -> np.ndarray:
    shape = (PIVOTS if lanes == 1 else PIVOTS_WIDE, lanes)
    return np.random.default_rng(64).integers(0, (1 << 64) - 1, shape, dtype=np.uint64)


def near(fps, table, left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (left, right) are within the radius: pivots first, then all bits."""
    keep = np.arange(len(left))
    for j in range(table.shape[1]):
        keep = keep[np.abs(table[left[keep], j] - table[right[keep], j]) <= radius]
        if not len(keep):
            break
    apart = np.bitwise_count(fps[left[keep]] ^ fps[right[keep]]).sum(axis=1, dtype=np.int64)
    return keep[apart <= radius]


class Sets:
    """Sorted shingles of each row, in one array, and the similarity that links two rows."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray, similarity: float):
        self.values, self.offsets, self.similarity = values, offsets, similarity

    def alike(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which of the pairs have so large a share of their shingles in common."""
        n = np.diff(self.offsets)
        few, many = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
        may = np.flatnonzero(few >= self.similarity * many * (1 - 1e-9))
        found = []
        for i, a, b in zip(may.tolist(), left[may].tolist(), right[may].tolist(), strict=True):
            x = self.values[self.offsets[a] : self.offsets[a + 1]]
            y = self.values[self.offsets[b] : self.offsets[b + 1]]
            shared = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum()) if len(x) else 0
            if shared / max(1, len(x) + len(y) - shared) >= self.similarity:
                found.append(i)
        return np.array(found, dtype=np.int64)


def links_in_groups(
    fps: np.ndarray, sizes: np.ndarray, radius: int, sets: Sets | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all near fingerprints of each group: every near pair's ends are connected.

    With ``sets``, near pairs are linked only if their shingles are alike.

    Rows of a group follow each other. Small groups give all their near pairs; a large
    group gives a spanning forest, grown from one member to all unvisited near ones, so
    that a dense group of ``m`` yields ``m - 1`` links and not ``m * m``.
    """
    table = pivot_table(fps, _pivots(fps.shape[1]))
    ends = np.cumsum(sizes)
    group = np.repeat(np.arange(len(sizes)), sizes)
    left, right = [], []

    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        hit = near(fps, table, a, b, radius)
        return hit[sets.alike(a[hit], b[hit])] if sets else hit

    small = np.flatnonzero((sizes <= SMALL_GROUP)[group])
    for shift in range(1, min(SMALL_GROUP, int(sizes.max(initial=1)))):
        a = small[small + shift < ends[group[small]]]
        if not len(a):
            break
        found = a[linked(a, a + shift)]
        left.append(found)
        right.append(found + shift)
    for g in np.flatnonzero(sizes > SMALL_GROUP):
        open_ = np.arange(ends[g] - sizes[g], ends[g])
        todo: list[int] = []
        while len(open_):
            if not todo:
                todo.append(int(open_[0]))
                open_ = open_[1:]
            at = todo.pop()
            hit = linked(np.full(len(open_), at), open_)
            if len(hit):
                new = open_[hit]
                left.append(np.full(len(new), at))
                right.append(new)
                todo.extend(new.tolist())
                open_ = np.delete(open_, hit)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def split_groups(rows: DataFrame, weight: Column | None = None, limit: int = GROUP_ROWS) -> DataFrame:
    """``rows`` with the ``key`` of large groups replaced, so that no group exceeds about ``limit``, counted in rows or by ``weight``.

    A large group is dealt into parts of half that size, by the node's hash, and each two
    parts become a group: any two of its rows still meet in one.
    """
    total = F.sum(weight) if weight is not None else F.count(F.lit(1))
    sizes = rows.groupBy("key").agg(total.alias("total"))
    parts = F.ceil(F.col("total") * 2 / limit).cast("int").alias("parts")
    large = stored(sizes.where(F.col("total") > limit).select("key", parts), "large-groups")
    marked = rows.join(large, "key", "left").withColumn(
        "own", F.pmod(F.xxhash64(F.lit(64), "node"), F.col("parts")).cast("int")
    )
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda part: part != F.col("own"))
    met = marked.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0)))))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    key = F.when(F.col("parts").isNull(), F.col("key")).otherwise(pair).alias("key")
    return met.select(*[key if c == "key" else F.col(c) for c in rows.columns])


def near_links(distinct: DataFrame, keys: Column, radius: int) -> DataFrame:
    """Links (``a``, ``b``) between node numbers of distinct fingerprints that share a key and are near.

    ``distinct`` has ``node`` and ``fp``; ``keys`` is an array of blocking keys.
    """
    rows = distinct.select("node", "fp", F.explode(keys).alias("key")).select(
        F.xxhash64("key").alias("key"), "node", "fp"
    )
    return links_by_key(split_groups(rows), radius)


def similar_candidates(nodes: DataFrame, radius: int) -> DataFrame:
    """Links between nodes (``node``, ``fp`` of several lanes, ``anchors``) that may be similar.

    First those whose fingerprints are near: exact blocks, pivot distances and bits of the first lane. Similar texts may
    differ in more bits than blocks of a fingerprint can bridge; these meet by a shared anchor, if all lanes are within ``radius``.
    """
    lane = nodes.select("node", F.slice("fp", 1, 1).alias("fp"))
    by_bits = near_links(lane, F.array(*block_keys(FIRST_LANE_RADIUS)), FIRST_LANE_RADIUS)
    return by_bits.union(near_links(nodes, F.col("anchors"), radius))


def links_by_key(groups: DataFrame, radius: int, similarity: float | None = None) -> DataFrame:
    """Links between rows of ``groups`` (``key``, ``node``, ``fp`` and, for a similarity, ``shingles``) with one key.

    Rows are dealt out by key and sorted, so a task holds one run of groups at a time.
    """
    dealt = groups.repartition("key").sortWithinPartitions("key")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: pa.Table) -> pa.RecordBatch:
        keys, nodes = rows.column("key").to_numpy(), rows.column("node").to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        sizes = np.diff(np.concatenate([[0], cuts, [len(keys)]]))
        several = np.flatnonzero(np.repeat(sizes > 1, sizes))
        fps = rows.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(keys), -1)[several]
        sets = None
        if similarity is not None:
            held = rows.column("shingles").combine_chunks().take(pa.array(several))
            ends = np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            sets = Sets(held.flatten().to_numpy(), np.concatenate([[0], ends]).astype(np.int64), similarity)
        a, b = links_in_groups(fps, sizes[sizes > 1], radius, sets)
        nodes = nodes[several]
        return pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if last or (held and held[-1].column("key")[-1].as_py() != keys[0]):
                yield links(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield links(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a bigint, b bigint").where("a <> b").distinct()


def alike_links(
    docs: DataFrame, nodes: DataFrame, roots: DataFrame, shingle_words: int, lanes: int, radius: int, similarity: float
) -> DataFrame:
    """Links between nodes of one component of ``roots`` whose shingles are alike.

    ``least`` of ``nodes`` tells a row by its id and row key, so that equal or null ids do not bring other texts.

    Only texts of components of several nodes are read again, and each travels once. A
    component of more than `GROUP_SHINGLES` is split like any large group.
    """
    several = nodes.select("fp", "least", "node").join(roots, "node")
    rows, heads = keyed(docs), several.select("least.doc_id", "least.row_key")
    texts = rows.join(heads, same_row(rows, heads), "left_semi")
    made = fingerprints(texts, shingle_words, lanes, shingles=True).groupBy("fp").agg(F.min("shingles").alias("shingles"))
    rows = several.select("fp", "node", F.col("root").alias("key")).join(made, "fp")
    held = stored(rows.select("key", "node", "fp", "shingles"), "shingles")
    weight = F.greatest(F.size("shingles"), F.lit(1))
    return links_by_key(split_groups(held, weight, GROUP_SHINGLES), radius, similarity)


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, of all nodes that have links.

    Each round points every neighbour at the smallest one around, first the larger
    neighbours and then the smaller (large star, small star); the table of links is
    written to the shared folder every round, and the run ends when nothing moves.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        ).distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        moved = stored(small.where("u <> v").distinct(), "links")
        # Done when each node has one link, and no root is itself linked further.
        chained = moved.select(F.col("v").alias("u")).join(moved.select("u"), "u", "left_semi").limit(1)
        repeats = moved.groupBy("u").count().where("count > 1").limit(1)
        done = chained.select("u").union(repeats.select("u")).isEmpty()
        edges = moved
        if done:
            break
    else:
        raise RuntimeError(f"links have not settled after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()


def grouped(
    docs: DataFrame, shingle_words: int, radius: int, lanes: int, similarity: float | None, by_row: bool
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and for each distinct ``fp`` the ``head`` of its component.

    The head is the smallest id; with ``by_row`` (needed for a similarity) it is the row with the smallest id and,
    of equal ids, the smallest row key: a struct of ``doc_id`` and ``row_key`` behind a flag that puts null ids last.
    """
    by_anchor = lanes > 1
    rows = stored(fingerprints(docs, shingle_words, lanes, by_anchor, row_keys=by_row), "fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key") if by_row else F.col("doc_id")
    # Texts with one fingerprint are one node, with the anchors of them all.
    union = F.array_distinct(F.flatten(F.collect_set("anchors")))
    held = rows.groupBy("fp").agg(F.min(own).alias("least"), *([union.alias("anchors")] * by_anchor))
    # A node is numbered by its fingerprint: equal texts, whatever their ids, are one node.
    number = F.xxhash64("fp") if by_anchor else F.col("fp")[0]
    nodes = stored(held.withColumn("node", number), "nodes")
    keys = F.col("anchors") if by_anchor else F.array(*block_keys(radius))
    exact_follows = by_anchor and similarity is not None
    roots = components(similar_candidates(nodes, radius) if exact_follows else near_links(nodes, keys, radius))
    if similarity is not None:
        roots = components(alike_links(docs, nodes, roots, shingle_words, lanes, radius, similarity))
    placed = nodes.select("fp", "least", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("head"))
    return rows, placed.join(least, "root").select("fp", "head")


def near_groups(
    docs: DataFrame,
    shingle_words: int = 4,
    radius: int = 4,
    lanes: int = 1,
    similarity: float | None = None,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links of at most ``radius`` bits.

    With one lane the links are complete; with more, blocks come from shared shingles
    (see above), and ``radius`` counts bits of all lanes. With ``similarity`` a link also needs
    so large a share of shingles (each counted once) in both texts; take a radius that such pairs keep.
    """
    by_row = similarity is not None
    rows, heads = grouped(docs, shingle_words, radius, lanes, similarity, by_row)
    member = heads.select("fp", F.col("head.doc_id" if by_row else "head").alias("component_id"))
    return rows.select("doc_id", "fp").join(member, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(
    docs: DataFrame, shingle_words: int, radius: int, lanes: int, similarity: float | None = None
) -> DataFrame:
    """All columns of one document of each group: that with the smallest id, of equal ids that with the smallest
    row key, of equal rows one. A row without an id stays only if no other of its group has one."""
    _, heads = grouped(docs, shingle_words, radius, lanes, similarity, by_row=True)
    first = heads.select("head.doc_id", "head.row_key").distinct()
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"))
    # An id may stand in several groups: only its row key tells which row is the head of which.
    named = whole.withColumn("row_key", F.xxhash64(F.col("doc_id"), F.col("doc.text").cast("string")))
    kept = named.join(first, same_row(named, first), "left_semi")
    return kept.dropDuplicates(["doc_id", "row_key"]).select("doc.*")


def hex_fingerprint() -> Column:
    return F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0"))
