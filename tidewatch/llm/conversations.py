"""Repair of conversations whose turns are missing, empty, repeated, cut off or out of order.

Each conversation gets the cheapest edits after which the initials of its roles read ``(s?(ua)+)?``, one system turn
at most and then user and assistant in turn. Of equally cheap edits the ASCII-least initials win. All of it is one
shuffle, by conversation; rows are then sorted inside their partitions, where Spark spills as it must, and streamed:

1. Rows sorted by role and text tell which are seen again (a row number, no shuffle).
2. From the last turn to the first, a task carries what each state of the pattern still costs. The cost of a state
   matters only by its distance to the others, so few different sets of costs exist and a step is one lookup. Each
   row leaves with one byte, its backpointer: the best edit in each of the four states. Spark's next sort spills
   bytes and rows; the task holds nothing of a conversation, however long.
3. From the first turn to the last, a task carries the state, and each row's byte says which edits come next.

A task holds one Arrow batch, four costs, and of results a letter an edit. A conversation is one sequence and its digest
one stream, so one task reads all its rows, in spilled order, if it has a third of the table.

Odd input: a null role or text reads as one blank, so such a text is a blank fault, and such a role is nobody's. Null turns
come first. Rows with one turn are ordered by role and text. Rows equal in all columns are copies: the first counts,
the others are duplicates. All rows without a conversation id are one conversation. An empty table gives an empty
table. Only the four named columns are looked at.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Costs of edits, and what a truncated row adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_EXPECTED = (_USER, _USER, _ASSISTANT, _USER)
_STATE_OF = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_DONE = (_START, _ASSISTANT)
_EDITS = "DIKR"
_LEGAL = {"su", "ua", "au"}
_FAULTS = ("blank", "duplicate", "truncated")


def _read(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def messages(rows: DataFrame) -> DataFrame:
    """``conv_id`` (a string or a whole number), ``turn``, ``role`` and ``text`` only, nulls of the last two read as one blank."""
    kind = "string" if isinstance(rows.schema["conv_id"].dataType, T.StringType) else "bigint"
    return rows.select(F.col("conv_id").cast(kind).alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), _read("role").alias("role"), _read("text").alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Damage rows by the CRC-32 of ``conv_id:turn``: of twenty, one remainder each drops the row, empties its text, takes out
    its sentence ends, repeats it, and makes it the user's. Dropped rows stay with ``dropped`` set, so that
    conversations without any row left are known."""
    kind = F.crc32(F.concat_ws(":", _read("conv_id"), _read("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).when(kind != 0, F.col("text"))
    changed = rows.withColumn("kind", kind).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """Rows dealt out by conversation, with ``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated."""
    bare = F.rtrim(F.col("text"), F.lit(_BLANKS))
    end = F.substring(bare, -1, 1)
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    dealt = rows.repartition("conv_id").withColumn("seen", F.row_number().over(same) > 1)
    fault = F.when(F.col("dropped"), 0).when(bare == "", 1).when(F.col("seen"), 2).when(~end.isin(".", "!", "?"), 3)
    return dealt.withColumn("fault", fault.otherwise(0))


@functools.lru_cache(maxsize=4096)
def _step(ahead: tuple[int, ...], role: str, fault: int) -> tuple[tuple[int, ...], int]:
    """What each state still costs in front of a row, given the costs behind it, and the best edit of each state."""
    here = []
    extra = TRUNCATED if fault == 3 else 0
    for state in range(4):
        costs = {"D": DELETE + ahead[state]}
        if fault in (0, 3):
            costs["R"] = REROLE + extra + ahead[_EXPECTED[state]]
            after = _STATE_OF.get(role)
            if after == _EXPECTED[state] or (after == _SYSTEM and state == _START):
                costs["K"] = extra + ahead[after]
        here.append(costs)
    best = [min(c.values()) for c in here]
    for _ in range(3):
        best = [min(best[s], INSERT + best[_EXPECTED[s]]) for s in range(4)]
    code = 0
    for state, costs in enumerate(here):
        costs["I"] = INSERT + best[_EXPECTED[state]]
        code |= _EDITS.index(min(e for e, c in costs.items() if c == best[state])) << (2 * state)
    least = min(best)
    return tuple(b - least for b in best), code


def _end_costs() -> tuple[int, ...]:
    """What each state costs behind the last row."""
    best = [0 if s in _DONE else 1 << 30 for s in range(4)]
    for _ in range(3):
        best = [min(best[s], INSERT + best[_EXPECTED[s]]) for s in range(4)]
    return tuple(best)


def _map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], fields: list[tuple[str, str]]) -> DataFrame:
    kinds = [("conv_id", df.schema["conv_id"].dataType.simpleString()), *fields]
    return df.mapInArrow(fn, ", ".join(f"{name} {kind}" for name, kind in kinds))


def _backpointers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the last to the first: append the byte of best edits."""
    last, costs = _end_costs(), _end_costs()
    current: object = _backpointers
    for batch in batches:
        codes = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "fault", "dropped")]
        for conv, role, fault, dropped in zip(*columns, strict=True):
            if conv != current:
                current, costs = conv, last
            if dropped:
                codes.append(0)
                continue
            costs, code = _step(costs, (role or "")[:1], fault)
            codes.append(code)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int32())], names=[*batch.schema.names, "code"])


def _edits(conv_type: pa.DataType) -> Callable:
    names = ["conv_id", "turn", "role", "text", "fault", "edit", "cost", "was"]
    kinds = [conv_type, pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run
        state = _START
        rows: list[tuple] = []

        def insert() -> None:
            nonlocal state
            state = _EXPECTED[state]
            rows.append((current, None, _NAMES[state], "", 0, "I", INSERT, None))

        def close() -> None:
            while current is not run and state not in _DONE:
                insert()

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "dropped", "code")]
            for conv, turn, role, text, fault, dropped, code in zip(*columns, strict=True):
                if conv != current:
                    close()
                    current, state = conv, _START
                if dropped:
                    rows.append((conv, turn, None, None, 0, "", 0, None))
                    continue
                extra = TRUNCATED if fault == 3 else 0
                while (edit := _EDITS[code >> (2 * state) & 3]) == "I":
                    insert()
                if edit == "D":
                    rows.append((conv, turn, None, None, fault, edit, DELETE, role))
                    continue
                state = _EXPECTED[state] if edit == "R" else _STATE_OF[role[:1]]
                name = _NAMES[state] if edit == "R" else role
                rows.append((conv, turn, name, text, fault, edit, extra + REROLE * (edit == "R"), role))
            yield batch_of(rows)
            rows = []
        close()
        yield batch_of(rows)

    return run


def repaired(rows: DataFrame) -> DataFrame:
    """Every edit, conversation by conversation and in order: ``conv_id``, ``turn``, the ``role`` and ``text`` that stay (null if
    deleted), ``fault`` (0 to 3), ``edit`` (K, R, D, I), ``cost`` and the role that ``was``. Each conversation lies in one partition."""
    return _repaired(messages(rows).withColumn("dropped", F.lit(False)))


def _repaired(rows: DataFrame) -> DataFrame:
    judged = _faults(rows).select("conv_id", "turn", "role", "text", "seen", "fault", "dropped")
    carried = [("turn", "bigint"), ("role", "string"), ("text", "string"), ("seen", "boolean"), ("fault", "int"), ("dropped", "boolean")]
    backward = judged.sortWithinPartitions(
        F.col("conv_id"), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), F.col("seen").desc()
    )
    pointed = _map(backward, _backpointers, [*carried, ("code", "int")])
    forward = pointed.sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("seen"))
    kinds = {"turn": "bigint", "role": "string", "text": "string", "fault": "int", "edit": "string", "cost": "int", "was": "string"}
    conv_type = pa.string() if isinstance(rows.schema["conv_id"].dataType, T.StringType) else pa.int64()
    return _map(forward, _edits(conv_type), list(kinds.items()))


class _Tally:
    """Running figures of one conversation."""

    def __init__(self, conv: object):
        self.conv, self.counts = conv, [0, 0, 0]
        self.first = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.started, self.before = hashlib.sha256(), False, None

    def add(self, turn, role, text, fault, edit, cost, was) -> None:
        if edit:
            self.audit.append(edit)
        self.cost += cost
        if was is not None:
            if self.before is not None and self.before + was[:1] not in _LEGAL:
                self.illegal += 1
            self.before = was[:1]
            if fault:
                self.counts[fault - 1] += 1
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
        if role is not None:
            self.digest.update(f"{chr(10) * self.started}{role}:{text}".encode())
            self.started = True

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.counts, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of `repaired`, whose partitions are streamed as they come: ``gaps`` between turns, rows by first
    fault, ``illegal`` neighbours before the repair, its ``cost``, ``audit`` (all edits) and the digest of what is left."""
    conv_type = pa.string() if isinstance(edits.schema["conv_id"].dataType, T.StringType) else pa.int64()
    longs = ["gaps", *_FAULTS, "illegal", "cost"]
    names = ["conv_id", *longs, "audit", "repaired_sha256"]
    kinds = [conv_type, *[pa.int64()] * len(longs), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = None
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "edit", "cost", "was")]
            for conv, *edit in zip(*columns, strict=True):
                if tally is None or conv != tally.conv:
                    if tally is not None:
                        done.append(tally.row())
                    tally = _Tally(conv)
                tally.add(*edit)
            yield from batch_of(done)
        yield from batch_of([] if tally is None else [tally.row()])

    def batch_of(done: list[tuple]) -> Iterator[pa.RecordBatch]:
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return _map(edits, run, [*((n, "bigint") for n in longs), ("audit", "string"), ("repaired_sha256", "string")])


def damaged_and_repaired(rows: DataFrame) -> DataFrame:
    """`summaries` of conversations after damage; those without any row left have zeros, an empty audit and the digest of nothing."""
    return summaries(_repaired(damaged(messages(rows))))
