"""Operators that compare documents with each other, and the pipeline, against plain Python."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import catalog, decontamination, lines, mixing, simhash, substrings
from tidewatch.llm.common import table

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_contamination(docs, items, span=10):
    wins = {}
    for item, text in items:
        w = ALNUM.findall(lowered(text))
        for i in range(max(1, len(w) - span + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + span]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall(lowered(text))
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if (ids := wins.get(tuple(w[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= ids
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_contamination_of_odd_texts(spark, documents):
    draw = random.Random(5)
    word = lambda: draw.choice("ab cd ef gh é1".split())
    items = [(i, " ".join(word() for _ in range(draw.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(30)] + [(None, "ab ab ab"), (5, None), (40, "Zz9")]
    docs = [(i, "-".join(word() for _ in range(draw.randrange(60)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "ab " * 4000), (None, "AB Ab aB"), (0, docs[0][1]), (0, "other"), (103, items[7][1].upper() + " zZ9!")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    made = [tuple(r) for r in decontamination.contaminated_documents(documents(docs), bench).collect()]
    assert sorted(made, key=key) == sorted(brute_contamination(docs, items), key=key)
    assert decontamination.contaminated_documents(documents([]), bench).count() == 0
    clean = decontamination.contaminated_documents(documents(docs), bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r["contaminated"] for r in clean)
    left = decontamination.clean_documents(documents(docs).withColumn("items", F.lit(1)).withColumn("row_key", F.lit(2)), bench)
    assert left.columns[-2:] == ["items", "row_key"]
    assert sorted(r["text"] or "" for r in left.collect()) == sorted(t or "" for (_, t), r in zip(docs, brute_contamination(docs, items)) if not r[-1])


def test_a_full_bitmap_changes_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "bitmap", lambda grams: np.full(decontamination.BITMAP_BITS // 8, 255, np.uint8))
    docs = [(i, " ".join(f"w{(i * k) % 7}" for k in range(40))) for i in range(12)]
    items = [(i, docs[i][1][: 30 + i]) for i in range(4)]
    made = [tuple(r) for r in decontamination.contaminated_documents(documents(docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()]
    assert sorted(made) == sorted(brute_contamination(docs, items))


def test_items_with_one_prompt(spark, documents):
    """Two hundred documents repeat a prompt that four hundred items begin with; seven of its words are not enough."""
    draw = random.Random(6)
    other = lambda n: " ".join(f"x{draw.randrange(10**6)}" for _ in range(n))
    for size in (7, 12):
        prompt = " ".join(f"p{i}" for i in range(size))
        items = [(i, f"{prompt} {other(15)}") for i in range(400)]
        docs = [(i, " ".join(f"{other(12)} {prompt}" for _ in range(20))) for i in range(200)]
        began = time.time()
        bench = spark.createDataFrame(items, "item_id bigint, text string")
        made = [tuple(r) for r in decontamination.contaminated_documents(documents(docs), bench).collect()]
        assert time.time() - began < 60
        assert sorted(made) == sorted(brute_contamination(docs, items))
        assert all(r[-1] == (size == 12) and r[3] == (400 if size == 12 else 0) for r in made)


def brute_lines(docs, least):
    """Rows are documents, equal ones a single document; which of one id is first is left open (by its text and source)."""
    sites, holders = {}, {}
    bare = lambda x: x.strip(" \t\x0b\x0c\r")
    for doc_id, text, source in docs:
        for x in {bare(x) for x in (text or "").split("\n")} - {""}:
            sites.setdefault(x, set()).add(source)
            holders.setdefault(x, set()).add((doc_id is None, doc_id or 0, source, text))
    gone = {x for x, s in sites.items() if len(s) >= least}
    return bare, gone, holders


def check_lines(rows, made, least):
    """Each row has a line of its own, by which it is found again."""
    bare, gone, holders = brute_lines(rows, least)
    by_last = {(s, (t or "").split("\n")[-1], t is None): (i, t, n, m) for i, s, t, n, m in made}
    assert len(made) == len(rows)
    kept_in = Counter()
    for doc_id, text, source in rows:
        found_id, found, n_lines, n_removed = by_last[source, (text or "").split("\n")[-1], text is None]
        assert found_id == doc_id
        if text is None:
            assert (found, n_lines, n_removed) == (None, 0, 0)
            continue
        all_lines = text.split("\n")
        full = [x for x in all_lines if bare(x)]
        left = Counter(bare(x) for x in found.split("\n") if bare(x))
        # A line goes from a row as a whole, and never without being boilerplate.
        for x, n in Counter(map(bare, full)).items():
            assert left[x] in (0, n) and (left[x] == n or x in gone)
            kept_in[x] += left[x] > 0 and x in gone
        removed = {x for x in map(bare, full) if not left[x]}
        assert found == "\n".join(x for x in all_lines if bare(x) not in removed)
        assert (n_lines, n_removed) == (len(full), sum(bare(x) in removed for x in full))
        # Whoever keeps a boilerplate line has the smallest id of all that hold it, null last.
        for x in set(map(bare, full)) & gone - removed:
            assert (doc_id is None, doc_id or 0) == min(holders[x])[:2]
    assert all(kept_in[x] == 1 for x in gone)


def test_boilerplate_of_documents_without_ids(documents):
    """Twelve sites share a line; ids are missing, all the same, or null and one."""
    for ids in ([None] * 12, [7] * 12, [None] * 11 + [3], list(range(12))):
        rows = [(i, f"shared line\nown {n}", f"s{n}") for n, i in enumerate(ids)]
        made = lines.without_boilerplate(documents([(i, t, "en", s) for i, t, s in rows]), counts=True)
        found = made.select("doc_id", "source", "text", "n_lines", "n_removed").collect()
        check_lines(rows, [tuple(r) for r in found], 10)
        assert sum(r["n_removed"] for r in found) == 11


def test_equal_rows_are_one_document(documents):
    rows = [(i % 10, f"shared line\nown {i % 10}", f"s{i % 10}") for i in range(20)]
    made = lines.without_boilerplate(documents([(i, t, "en", s) for i, t, s in rows]), counts=True).collect()
    assert sum(r["n_removed"] for r in made) == 18 and {r["doc_id"] for r in made if not r["n_removed"]} == {0}


def test_very_many_boilerplate_lines(documents):
    """Twenty thousand lines go from each of eleven texts, in proportion to their number."""
    body = "\n".join(f"line {k}" for k in range(20_000))
    began = time.time()
    made = lines.without_boilerplate(documents([(i, body, "en", f"s{i}") for i in range(12)]), counts=True)
    assert {r["n_removed"] for r in made.select("n_removed").collect()} == {0, 20_000}
    assert time.time() - began < 120


@pytest.mark.parametrize("least", [2, 5, 9])
def test_lines_by_sites(documents, least):
    draw = random.Random(least)
    rows = [
        (i, "\n".join(draw.choice(["", " ", "a", "b ", " b", "\tc", "own %d" % i, "d e f"]) for _ in range(draw.randrange(9))), f"s{draw.randrange(10)}")
        for i in range(90)
    ]
    rows += [(200, None, "s1"), (201, "a\n" * 3000, None), (None, "a\nb", "s2"), (3, rows[3][1], rows[3][2]), (4, "a", "s9")]
    rows = [(i, None if t is None else f"{t}\nrow {n}", s) for n, (i, t, s) in enumerate(rows)]
    made = lines.without_boilerplate(documents([(i, t, "en", s, len(t or "")) for i, t, s in rows]), least, counts=True)
    check_lines(rows, [tuple(r) for r in made.select("doc_id", "source", "text", "n_lines", "n_removed").collect()], least)
    assert all(r["n_chars"] == len(r["text"] or "") for r in made.collect())
    assert lines.without_boilerplate(documents([])).count() == 0
    clash = documents([(1, "a", None, "s")]).withColumns({"line": F.lit(1), "gone": F.lit(2), "n_lines": F.lit(3)})
    assert lines.without_boilerplate(clash).columns == clash.columns


def brute_targets(sizes, most=3):
    """Cap and reshare until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = {}, sum(sizes.values()), list(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in over]
    return target


def test_mixing(spark, documents):
    draw = random.Random(2)
    sources = ["b", "a", "é", "z", None, "empty", "Z"]
    rows = [(i, "w " * draw.choice([0, 1, 5, 80]) , None, draw.choices(sources, [9, 1, 4, 2, 1, 0, 1])[0]) for i in range(4000)]
    rows += [(5000, "", None, "empty"), (None, None, None, "a"), (None, "x", None, "a"), (1, "x", None, "b"), (6000, "w " * 20000, None, "b")]
    made = mixing.with_copies(documents(rows)).select("doc.source", "doc_id", "size", "source_size", "target", "copies").collect()
    assert len(made) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(BLANK.findall(text or ""))
    target = brute_targets(sizes)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    taken = Counter()
    for r in made:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + 1) and r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    for s in ("b", "é", "z"):
        assert abs(taken[s] - target[s]) < 0.25 * target[s] + 20000
    docs = documents(rows).withColumns({"size": F.lit(1), "copies": F.lit(2), "copy": F.lit(3)})
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in made)
    assert sorted(out.collect(), key=str) == sorted(mixing.mixed(docs).collect(), key=str)
    assert mixing.mixed(documents([])).count() == 0


@pytest.mark.parametrize("parts", [64, 3])
def test_rows_without_or_with_one_id_are_mixed_each(documents, monkeypatch, parts):
    """Two thousand documents without ids, as many of one id, and as many equal ones, next to a large source."""
    monkeypatch.setattr(mixing, "PARTS", parts)
    rows = [(None, f"w{i} " * 10, None, "a") for i in range(2000)] + [(5, f"v{i} " * 10, None, "b") for i in range(2000)]
    rows += [(None, "same words here", None, "c")] * 2000 + [(i, "x " * 70, None, "d") for i in range(2000)]
    made = mixing.with_copies(documents(rows)).select("doc.source", "size", "copies", "target").collect()
    taken, target = Counter(), {r["source"]: r["target"] for r in made}
    for r in made:
        taken[r["source"]] += r["size"] * r["copies"]
    assert len(made) == len(rows)
    for s in "abcd":
        assert abs(taken[s] - target[s]) < 0.06 * target[s]
    again = mixing.with_copies(documents(rows).repartition(7)).select("doc.source", "size", "copies").collect()
    assert Counter((r["source"], r["copies"]) for r in again) == Counter((r["source"], r["copies"]) for r in made)


def brute_repeats(docs, window):
    count = Counter()
    split = [(d, BLANK.findall(t or "")) for d, t in docs]
    for _, w in split:
        count.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for d, w in split:
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def near_copies(draw, n, length, words):
    base = [draw.choice(words) for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(draw.randrange(4)):
            text[draw.randrange(length)] = draw.choice(words)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("busy,shard", [(10_000, 1_000_000), (3, 2_000)])
def test_repeats(documents, busy, shard):
    draw = random.Random(7)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzäw"] + ["A", "a"]
    texts = near_copies(draw, 25, 120, words) + near_copies(draw, 6, 60, words[:3]) + near_copies(draw, 3, 40, words)
    passage = " ".join(draw.choice(words) for _ in range(36))
    texts += [" ".join(draw.choice(words) for _ in range(draw.randrange(90))) + " " + passage[draw.randrange(5):] for _ in range(9)]
    texts += [None, "", " \n\t ", "x " * 34, "x " * 35, "y " * 36, "z " * 3000, " ".join(words), passage]
    docs = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "q " + texts[1]), (None, None)]
    made = [tuple(r) for r in substrings.without_repeats(documents(docs), busy=busy, shard_words=shard).collect()]
    assert sorted(made, key=key) == sorted(brute_repeats(docs, 35), key=key)
    assert substrings.without_repeats(documents([])).count() == 0


def test_backward_search_counts():
    draw = np.random.default_rng(1)
    words = np.concatenate([np.append(draw.integers(1, 6, 30), 0) for _ in range(20)])
    owner = np.repeat(np.arange(20), 31)
    index = substrings.FMIndex(words, owner, np.ones(20, dtype=np.int64), 30)
    line = words.tolist()
    for _ in range(200):
        a = int(draw.integers(0, len(words) - 8))
        pattern = line[a : a + int(draw.integers(1, 8))]
        if 0 in pattern:  # sequences never cross segments
            continue
        low, high = np.array([0]), np.array([len(words)])
        for w in reversed(pattern):
            low, high = index.extend(np.array([w]), low, high)
        assert high[0] - low[0] == sum(line[i : i + len(pattern)] == pattern for i in range(len(line)))


def brute_fingerprint(text, size=4):
    w = lowered(text).encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + size]), 42) for i in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bits = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[i + 1 :]) <= radius) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash_of_all_documents(spark, duck, sf_dir):
    rows = catalog.QUERIES["op10_simhash"](spark, sf_dir).collect()
    texts = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    fps = [brute_fingerprint(t) for _, t in texts]
    want = [(d, f"{f:016x}", c) for (d, _), f, c in zip(texts, fps, brute_components(fps, [d for d, _ in texts], 4))]
    assert sorted(tuple(r) for r in rows) == sorted(want)


def test_simhash_of_odd_texts(documents):
    draw = random.Random(11)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    docs = [(i, t) for i, t in enumerate(near_copies(draw, 150, 160, words) + near_copies(draw, 20, 12, words))]
    docs += [(500, None), (501, ""), (502, "one"), (503, "ONE"), (504, "\x1cone"), (None, "one"), (None, None), (7, docs[7][1]), (505, "É " * 9000)]
    found = simhash.near_groups(documents(docs)).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id")
    fps = [brute_fingerprint(t) for _, t in docs]
    want = [(d, f"{f:016x}", c) for (d, _), f, c in zip(docs, fps, brute_components(fps, [d for d, _ in docs], 4))]
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(want, key=key)
    assert simhash.near_groups(documents([])).count() == 0


def test_links_of_large_groups():
    draw = np.random.default_rng(4)
    base = draw.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = np.array([base[i % 3] ^ np.uint64(sum(1 << int(b) for b in draw.integers(0, 64, 3))) for i in range(400)], dtype=np.uint64)
    for sizes in ([400], [200, 2, 150, 48]):
        a, b = simhash.links_in_groups(fps[:, None], np.array(sizes), 4)
        assert (np.bitwise_count(fps[a] ^ fps[b]) <= 4).all()
        start = 0
        for size in sizes:
            own = fps[start : start + size].tolist()
            part = [(x - start, y - start) for x, y in zip(a, b) if start <= x < start + size]
            assert len(part) < size or size <= simhash.SMALL_GROUP
            linked = list(range(size))
            for _ in range(size):
                before = list(linked)
                for x, y in part:
                    linked[x] = linked[y] = min(linked[x], linked[y])
                if before == linked:
                    break
            assert linked == brute_components(own, list(range(size)), 4)
            start += size


@pytest.mark.parametrize("lanes, radius", [(1, 4), (4, 48)])
def test_simhash_splits_large_groups(documents, monkeypatch, lanes, radius):
    draw = random.Random(17)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    docs = documents([(i, t) for i, t in enumerate(near_copies(draw, 120, 200, words) + near_copies(draw, 60, 90, words))])
    groups = lambda: sorted((r["doc_id"], r["component_id"]) for r in simhash.near_groups(docs, 5, radius, lanes).collect())
    whole = groups()
    monkeypatch.setattr(simhash, "GROUP_ROWS", 16)
    assert groups() == whole and len({c for _, c in whole}) < 150


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 300)], "a bigint, b bigint")
    made = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert made == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


def jaccard(a, b, size=5):
    cut = lambda t: (lambda w: {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))})(lowered(t).split())
    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b)


def test_pipeline_near_dedup_by_similarity(spark, documents):
    draw = random.Random(13)
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "xyzuvw" for c in "klmn"]
    groups = [near_copies(draw, 5, 300, words) for _ in range(30)]
    docs = [(10 * g + i, t, "en", "s", len(t)) for g, group in enumerate(groups) for i, t in enumerate(group)]
    docs += [(1000 + i, " ".join(draw.choice(words) for _ in range(80)), "en", "s", 0) for i in range(100)]
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents(docs), "").collect()}
    for g, group in enumerate(groups):
        near = [jaccard(group[0], t) >= 0.8 for t in group]
        if all(near):
            assert {10 * g + i for i in range(5)} & kept == {10 * g}
    assert {d for d in range(1000, 1100)} <= kept
    odd = documents([(1, None), (2, None), (2, None), (3, "a b"), (None, "a b"), (4, "c")]).withColumns({"fp": F.lit(1), "component_id": F.lit(1), "doc": F.lit(0)})
    out = corpus_pipeline.near_dedup(spark, odd, "")
    assert out.columns == odd.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]


def test_pipeline_near_dedup_tells_rows_of_one_id_apart(documents):
    draw = random.Random(23)
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "xyzuvw" for c in "klmn"]
    groups = {name: near_copies(draw, 4, 300, words) for name in "abcdefg"}
    a, b, c, d, e, f, g = groups.values()
    assert all(jaccard(x, y) >= 0.8 for group in groups.values() for x in group for y in group)
    rows = [
        (1, a[0]), (5, a[1]), (5, b[0]),  # one id in two groups
        (None, a[2]), (None, a[3]), (6, c[0]), (None, c[1]),  # without id, near to rows with one
        (None, d[0]), (None, d[1]), (None, d[2]), (None, e[0]), (None, e[1]),  # groups without any id
        (7, f[0]), (7, f[1]), (7, f[2]), (None, g[0]), (None, g[0]), (8, b[1]), (8, b[1]),  # near copies and equal rows of one id
    ]
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(None, documents(rows), "").collect()]
    of = {t: name for name, group in groups.items() for t in group}
    assert sorted(of[t] for _, t in kept) == list("abcdefg")
    assert {(1, a[0]), (5, b[0]), (6, c[0]), (None, g[0])} <= set(kept) <= set(rows)
    assert {(i, of[t]) for i, t in kept} >= {(None, "d"), (None, "e"), (7, "f")}


def test_similar_texts_meet_by_their_fingerprints(spark):
    """Near fingerprints are linked without any shingle in common to meet by; anchors add pairs whose bits are further apart."""
    draw = np.random.default_rng(37)
    lanes = draw.integers(-(1 << 63), (1 << 63) - 1, (40, 4), dtype=np.int64)
    rows = [(n, lanes[n].tolist(), [n]) for n in range(40)]
    for n in range(10):  # one to five bits of the first lane, other lanes and anchors of its own
        flips = sum(1 << int(b) for b in draw.choice(62, n % 5 + 1, replace=False))
        rows.append((100 + n, [int(lanes[n][0]) ^ flips, *lanes[n + 20][1:].tolist()], [100 + n]))
    rows += [(200, (lanes[12] ^ 0b111111).tolist(), [12]), (201, (lanes[13] ^ 0b111111).tolist(), [201])]
    nodes = spark.createDataFrame(rows, "node bigint, fp array<bigint>, anchors array<bigint>")
    found = {(min(r), max(r)) for r in simhash.similar_candidates(nodes, 80).collect()}
    assert found == {(n, 100 + n) for n in range(10) if n % 5 < 4} | {(12, 200)}


def far_pair(draw, small, large):
    """Texts of 0.8 of their shingles in common whose fingerprints are more than 64 of 256 bits apart."""
    cut = lambda t: np.unique(simhash.shingle_hashes(t, 5))
    while True:
        text = [f"w{draw.randrange(10**9)}" for _ in range(large + 4)]
        a, b = " ".join(text[: small + 4]), " ".join(text)
        apart = np.bitwise_count(simhash.fingerprint(cut(a), 4) ^ simhash.fingerprint(cut(b), 4)).sum()
        if apart > 64:
            return a, b


@pytest.mark.parametrize("small, large", [(4, 5), (12, 15)])
def test_pipeline_near_dedup_of_short_texts(documents, small, large):
    draw = random.Random(31)
    a, b = far_pair(draw, small, large)
    assert jaccard(a, b) == small / large
    kept = corpus_pipeline.near_dedup(None, documents([(1, a), (2, b), (3, "another text")]), "").collect()
    assert {r["doc_id"] for r in kept} == {1, 3}


def test_similar_groups_are_exact(documents, monkeypatch):
    draw = random.Random(19)
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "xyzuvw" for c in "klmn"]
    texts = []
    for share in (0.01, 0.02, 0.03, 0.04, 0.06):  # similarities from above 0.9 to 0.6
        for _ in range(12):
            first = [draw.choice(words) for _ in range(200)]
            texts += [" ".join(w if draw.random() > share else draw.choice(words) for w in first) for _ in range(4)]
    hot = [draw.choice(words) for _ in range(120)]
    texts += [" ".join(w if draw.random() > 0.02 else draw.choice(words) for w in hot) for _ in range(70)]
    # One shingle repeated rules the majority of all bits, but not the set.
    texts += [" ".join(["same"] * 400 + [draw.choice(words) for _ in range(60)]) for _ in range(6)]
    texts += [None, "", "one", "two", texts[0], " ".join(["same"] * 9), " ".join(["same"] * 90)]
    linked = [
        (i, j) for j in range(len(texts)) for i in range(j)
        if bool((texts[i] or "").split()) == bool((texts[j] or "").split()) and jaccard(texts[i] or "", texts[j] or "") >= 0.8
    ]
    least = list(range(len(texts)))
    while any(least[i] != least[j] for i, j in linked):
        for i, j in linked:
            least[i] = least[j] = min(least[i], least[j])
    docs = documents(list(enumerate(texts)))
    groups = lambda: {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs, 5, 64, 4, 0.8).collect()}
    assert groups() == dict(enumerate(least))
    assert 20 < len(set(least)) < len(texts) - 50
    monkeypatch.setattr(simhash, "GROUP_SHINGLES", 2000)
    assert groups() == dict(enumerate(least))


def similar_groups(texts, least=0.8):
    """Components of texts that share so many shingles, pair by pair."""
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    held = sorted(texts)
    for i, a in enumerate(held):
        for b in held[:i]:
            if root(a) != root(b) and jaccard(texts[a], texts[b]) >= least:
                parent[root(a)] = root(b)
    groups = {}
    for d in held:
        groups.setdefault(root(d), []).append(d)
    return list(groups.values())


def test_pipeline_stage_by_stage(spark, duck, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    now = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, spark.createDataFrame(list(now.values()), docs.schema), sf_dir)
        assert made.columns == columns
        rows = made.collect()
        ids = Counter(r["doc_id"] for r in rows)
        if name == "quality classifier":
            labels = dict(duck.sql("SELECT doc_id, quality FROM labels").fetchall())
            good = [d for d in now if labels.get(d) == 1]
            # Some sixty labels are little to learn from; test_texts.py has a larger table.
            assert sum(d in ids for d in good) >= 0.75 * len(good)
        if name == "line dedup":
            bare, gone, holders = brute_lines([(d, r["text"], r["source"]) for d, r in now.items()], lines.MIN_SITES)
            first = {x: min(h[1] for h in holders[x]) for x in gone}
            for r in rows:
                text = now[r["doc_id"]]["text"]
                assert r["text"] == "\n".join(x for x in text.split("\n") if first.get(bare(x), r["doc_id"]) == r["doc_id"])
        if name == "simhash near-dedup":
            assert set(ids) == {min(group) for group in similar_groups({d: r["text"] for d, r in now.items()})}
            assert all(n == 1 and any(tuple(r) == tuple(now[d]) for r in rows if r["doc_id"] == d) for d, n in ids.items())
        if name == "benchmark decontamination":
            items = duck.sql("SELECT item_id, text FROM benchmark").fetchall()
            want = brute_contamination([(d, r["text"]) for d, r in now.items()], items)
            assert set(ids) == {r[0] for r in want if not r[-1]}
        if name == "mixing sources":
            sizes = Counter()
            for r in now.values():
                sizes[r["source"]] += len(BLANK.findall(r["text"] or ""))
            target = brute_targets(sizes)
            for d, r in now.items():
                rate = target[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
                assert ids[d] in (int(rate + 1e-9), int(rate + 1e-9) + 1, int(rate - 1e-9) + 1) and ids[d] <= 3
            assert all(tuple(r) == tuple(now[r["doc_id"]]) for r in rows)
        now = {r["doc_id"]: r for r in rows}
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect())
