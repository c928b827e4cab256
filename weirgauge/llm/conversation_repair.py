"""Repair of conversations by cheapest edits, streamed in the order of turns.

Rows are dealt out by conversation once; from then on only sorting within partitions happens. Sorted from the last turn
to the first, a pass over Arrow batches carries the state of a dynamic program: for each state of the role automaton,
the cost of repairing what follows. It leaves one byte per row, the best edit for each state (a backpointer). Sorted
from the first turn to the last, a second pass follows the backpointers. So a conversation of any length needs the
memory of a state; its rows and backpointers lie in Spark's sorter, which spills them.

Repaired role initials read ``(s?(ua)+)?``. Keep costs 0, Rerole (to user or assistant) 3, Delete 4 (required for blank
and repeated rows), Insert (an empty user or assistant row, anywhere) 3; a truncated row that stays adds 3. Of equally
cheap edits, those whose initials are least in ASCII order are taken.

A null conv_id is a conversation of its own; null turns come first; rows of one turn are in order of role and text. A
null role or text is one space. Rows whose ``gone`` is true take no part, but their conversation is reported. Texts are
processed whole; an empty table gives no rows; other columns are ignored, whatever their names. The digest of a
conversation is a running one over its rows, so one conversation is one task's work, in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgauge.llm.common import importable, pieces

SPACE = " \t\n\x0b\x0c\r"
RUN_ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the automaton: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or changed row leads from each state, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What a row that stays as it is leads to, by state and role initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
EDITS = "DIKR"
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows with the faults that the crc32 of ``conv_id:turn`` modulo 20 gives them.

    0: gone; 1: without text; 2: without ``.!?``; 3: twice; 4: said by the user.
    """
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, "".join(RUN_ENDS), "")).otherwise(text)
    times = F.when(kind == 0, F.array(F.lit(True))).when(kind == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(F.lit(False)))
    return conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.explode(times).alias("gone"))


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE))


def classified(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone, again, fault (blank, duplicate, truncated or empty), dealt out by conversation."""
    blank = F.lit(" ")
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), gone.alias("gone"))
    # the windows below find their rows together already: no second exchange
    rows = rows.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("again", F.row_number().over(seen) > 1)
    end = _trimmed(F.col("text"))
    fault = F.when(F.length(end) == 0, "blank").when(F.col("again"), "duplicate").when(~F.right(end, F.lit(1)).isin(*RUN_ENDS), "truncated").otherwise("")
    return rows.withColumn("fault", fault)


@lru_cache(maxsize=1 << 16)
def best_edits(after: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int, int]:
    """Costs before a row given those after it, both less their minimum, that minimum, and the states' best edits.

    The edits are places in EDITS, two bits for each state. Differences of costs are bounded, so few cases are ever met.
    """
    stays = fault not in ("blank", "duplicate")
    extra = TRUNCATED if fault == "truncated" else 0
    options = []
    for state in range(4):
        own = [(DELETE + after[state], 0)]
        if stays and (state, initial) in KEPT:
            own.append((KEEP + extra + after[KEPT[state, initial]], 2))
        if stays:
            own.append((REROLE + extra + after[NEXT[state]], 3))
        options.append(min(own))  # of equal costs the lesser letter
    costs = [cost for cost, _ in options]
    direct = list(costs)
    for state in (USER, ASSISTANT, START, SYSTEM):  # two inserts in a row lead back, so one look ahead is enough
        base = direct if state in (USER, ASSISTANT) else costs
        costs[state] = min(direct[state], INSERT + base[NEXT[state]])
    edits = 0
    for state, (cost, letter) in enumerate(options):
        inserted = INSERT + costs[NEXT[state]] == costs[state]
        edits |= min([letter] * (cost == costs[state]) + [1] * inserted) << 2 * state
    least = min(costs)
    return tuple(c - least for c in costs), least, edits


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's backpointers; rows come by conversation, last first."""
    current: object = object()
    after = END
    for batch in batches:
        out = []
        for conv, gone, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "gone", "initial", "fault")), strict=True):
            if conv != current:
                current, after = conv, END
            if gone:
                out.append(0)
                continue
            after, _, edits = best_edits(after, initial, fault)
            out.append(edits)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int16())], [*batch.schema.names, "edits"])


_ROW = "conv_id long, turn long, role string, text string, gone boolean, again boolean, fault string, initial string"


def _with_edits(rows: DataFrame) -> DataFrame:
    """Classified rows with their backpointers, by conversation, first turn first."""
    importable(rows.sparkSession)
    made = classified(rows).withColumn("initial", F.substring("role", 1, 1))
    made = made.sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), F.col("again").desc())
    made = made.mapInArrow(_backward, f"{_ROW}, edits short")
    return made.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again")


class Walk:
    """Follows the backpointers of one conversation, row by row."""

    def __init__(self, conv: int | None):
        self.conv, self.state, self.cost = conv, START, 0
        self.audit = bytearray()

    def _insert(self) -> tuple[str, str]:
        self.state = NEXT[self.state]
        self.cost += INSERT
        self.audit += b"I"
        return ROLE[self.state], ""

    def row(self, role: str, text: str, initial: str, fault: str, edits: int) -> list[tuple[str, str]]:
        """Repaired rows that this one gives: inserted ones before it, and itself unless it goes."""
        out = []
        while (edit := EDITS[edits >> 2 * self.state & 3]) == "I":
            out.append(self._insert())
        self.audit += edit.encode()
        if edit == "D":
            self.cost += DELETE
            return out
        if edit == "K":
            self.state = KEPT[self.state, initial]
            self.cost += KEEP
        else:
            self.state = NEXT[self.state]
            self.cost += REROLE
            role = ROLE[self.state]
        self.cost += TRUNCATED if fault == "truncated" else 0
        return [*out, (role, text)]

    def end(self) -> list[tuple[str, str]]:
        out = []
        while self.state in (SYSTEM, USER):
            out.append(self._insert())
        return out


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Walk, bool, tuple | None, list[tuple[str, str]]]]:
    """For each row: its conversation's walk, whether that is new, the row, and the repaired rows it gives; for each
    conversation's end: the walk, false, None, and the rows inserted there."""
    walk = None
    for batch in batches:
        for part in pieces(iter([batch])):
            columns = [part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault", "initial", "edits")]
            for conv, turn, role, text, gone, fault, initial, edits in zip(*columns, strict=True):
                new = walk is None or conv != walk.conv
                if new:
                    if walk is not None:
                        yield walk, False, None, walk.end()
                    walk = Walk(conv)
                yield walk, new, (turn, gone, fault, initial), [] if gone else walk.row(role, text, initial, fault, edits)
    if walk is not None:
        yield walk, False, None, walk.end()


#: Rows, and characters, that a pass gathers before it passes them on.
OUT_ROWS, OUT_CHARS = 4096, 4 << 20


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, chars, place = [], 0, 0
    for walk, new, row, made in _walked(batches):
        place = 0 if new else place
        for i, (role, text) in enumerate(made):
            own = row is not None and i == len(made) - 1 and walk.audit[-1:] != b"I"
            out.append((walk.conv, place, row[0] if own else None, role, text))
            chars += len(text)
            place += 1
        if len(out) >= OUT_ROWS or chars >= OUT_CHARS:
            yield _batch(out, _REPAIRED)
            out, chars = [], 0
    if out:
        yield _batch(out, _REPAIRED)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SUMMARY = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Summary:
    """What one conversation's rows add up to."""

    def __init__(self) -> None:
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.digest, self.lines = hashlib.sha256(), 0

    def row(self, turn: int | None, fault: str, initial: str) -> None:
        if fault:
            self.faults[fault] += 1
        if self.before is not None and (self.before, initial) not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1

    def write(self, made: list[tuple[str, str]]) -> None:
        for role, text in made:
            self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def result(self, walk: Walk) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return walk.conv, gaps, *self.faults.values(), self.illegal, walk.cost, walk.audit.decode(), self.digest.hexdigest()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, own = [], None
    for walk, new, row, made in _walked(batches):
        own = _Summary() if new else own
        if row is None:
            own.write(made)
            out.append(own.result(walk))
            if len(out) >= OUT_ROWS:
                yield _batch(out, _SUMMARY)
                out = []
            continue
        turn, gone, fault, initial = row
        if not gone:
            own.row(turn, fault, initial)
            own.write(made)
    if out:
        yield _batch(out, _SUMMARY)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), turn (null for an inserted row), role, text: the repaired conversations."""
    return _with_edits(rows).mapInArrow(_repaired, "conv_id long, place long, turn long, role string, text string")


def audited(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    return _with_edits(rows).mapInArrow(_summaries, f"conv_id long, {kinds}, audit string, repaired_sha256 string")
