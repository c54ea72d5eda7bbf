"""Repair of conversations against a search through all edits in plain Python, and against SQL."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tidewatch.llm import catalog, conversations

PATTERN = re.compile(r"(s?(ua)+)?")
COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows, damage=True):
    """Every prefix of edits, cheapest and least first, until one gives a legal conversation."""
    by_conv = {}
    for conv, turn, role, text in rows:
        kept = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        kept += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in by_conv.items():
        kept.sort()
        seen, faults = set(), []
        for _, _, role, text in kept:
            bare = text.rstrip("\t\n\x0b\x0c\r ")
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [t for known, t, _, _ in kept if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[:1] for _, _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, initials, lines = heapq.heappop(heap)
            if i == len(kept) and PATTERN.fullmatch(initials):
                break
            state = (i, initials[-1:] or "")
            if state in done:
                continue
            done.add(state)

            def push(extra, edit, at, new, line, cost=cost, audit=audit, initials=initials, lines=lines):
                text = initials + new
                if re.fullmatch(r"s?(ua)*u?", text):
                    heapq.heappush(heap, (cost + extra, audit + edit, at, text, lines + line))

            for name in ("user", "assistant"):
                push(5, "I", i, name[0], (f"{name}:",))
            if i < len(kept):
                _, _, role, text = kept[i]
                push(2, "D", i + 1, "", ())
                if faults[i] in (0, 3):
                    more = 5 if faults[i] == 3 else 0
                    if role[:1] in ("s", "u", "a"):
                        push(more, "K", i + 1, role[0], (f"{role}:{text}",))
                    for name in ("user", "assistant"):
                        push(1 + more, "R", i + 1, name[0], (f"{name}:{text}",))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, digest))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def random_rows(seed, convs=400):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            turn = rng.choice([None, 0, *range(15)])
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "analyst"])
            text = rng.choice(["a.", "b?", "cut", "", " \n", None, "x! \t", " ", "long. " * 5, "a.", "d."])
            rows.append((conv, turn, role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_damaged_conversations(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, COLUMNS).withColumn("dropped", F.lit("x")).withColumn("code", F.lit(1)).withColumn("seen", F.lit(None))
    made = [tuple(r) for r in conversations.damaged_and_repaired(df).collect()]
    assert order(made) == order(brute(rows))


def test_batches_do_not_matter(spark):
    rows = random_rows(3, 60) + [(7000, i, "user" if i % 2 == 0 else "assistant", f"t{i}." if i % 7 else "cut") for i in range(500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = conversations.damaged_and_repaired(spark.createDataFrame(rows, COLUMNS)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert order(tuple(r) for r in found) == order(brute(rows))


def test_undamaged_edits(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 1, "assistant", "a."), (2, 2, "user", "u.")]
    df = spark.createDataFrame(rows, COLUMNS)
    edits = conversations.repaired(df).collect()
    assert [(r.conv_id, r.turn, r.role, r.edit) for r in edits if r.conv_id == 1] == [
        (1, 0, "system", "K"), (1, 1, "user", "K"), (1, 2, "assistant", "K"),
    ]
    assert order(tuple(r) for r in conversations.summaries(conversations.repaired(df)).collect()) == order(brute(rows, damage=False))


def test_one_shuffle(spark, capsys):
    df = spark.createDataFrame(random_rows(4, 20), COLUMNS)
    conversations.damaged_and_repaired(df).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_names_as_ids_and_empty_table(spark):
    rows = [("x", 0, "user", "u."), ("x", 1, "assistant", "a."), (None, 0, "user", "q?")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    made = {r.conv_id: r.audit for r in conversations.summaries(conversations.repaired(df)).collect()}
    assert made == {"x": "KK", None: "D"}
    assert conversations.damaged_and_repaired(df.limit(0)).count() == 0


def test_a_long_conversation(spark):
    """A hundred thousand turns in one conversation."""
    n = 100_000
    rows = spark.range(n).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string"), F.when(F.col("id") % 11 == 0, "").otherwise(".")).alias("text"),
    )
    found = conversations.summaries(conversations.repaired(rows)).collect()
    assert len(found) == 1 and found[0].truncated == len(range(0, n, 11)) and len(found[0].audit) >= n


def test_query_agrees_with_sql_and_with_search(spark, duck, sf_dir):
    df = catalog.QUERIES["op12_conversations"](spark, sf_dir)
    made = [tuple(r) for r in df.collect()]
    relation = duck.sql(catalog.ORACLES["op12_conversations"])
    assert rows_of(df.columns, made) == rows_of(relation.columns, relation.fetchall())
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert order(made) == order(brute(rows))
