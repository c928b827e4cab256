import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from weirgauge.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """One conversation's rows after damage to the figures, by trying every edit with memory of what follows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            c, w, out = best(i, AFTER[state], inserted + 1)
            options.append((c + 3, "I" + w, (NAMES[AFTER[state]] + ":", *out)))
        if i < len(rows):
            c, w, out = best(i + 1, state, 0)
            options.append((c + 4, "D" + w, out))
            if faults[i] not in ("blank", "duplicate"):
                extra, (_, _, role, text) = 3 * (faults[i] == "truncated"), rows[i]
                x = role[:1]
                if (state, x) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    c, w, out = best(i + 1, x, 0)
                    options.append((c + extra, "K" + w, (f"{role}:{text}", *out)))
                for x in "ua":
                    if AFTER[state] == x:
                        c, w, out = best(i + 1, x, 0)
                        options.append((c + 3 + extra, "R" + w, (f"{NAMES[x]}:{text}", *out)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "é…", "so it is.  \n", "ü. ", "Yes.\x85"]
    made = []
    for conv in [*range(400), None]:
        for turn in range(r.randrange(0, 9)):
            at = None if r.random() < 0.05 else turn + r.randrange(2) * r.randrange(3)
            made.append((conv, at, r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]), r.choice(texts)))
    return made + [(9001, None, "user", "Hi."), (9001, None, "user", "Hi."), (9002, -5, "a", "x."), (9002, 7, "sys", "Go.")]


def grouped(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_against_brute_force(spark, rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        data = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, edits int, gone string").repartition(4)
        got = {r.conv_id: tuple(r)[1:] for r in cr.audited(cr.damaged(data)).collect()}
        lines = {}
        for r in sorted(cr.repaired(cr.damaged(data)).collect(), key=lambda r: r.place):
            assert r.place == len(lines.setdefault(r.conv_id, []))
            lines[r.conv_id].append(f"{r.role}:{r.text}")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    after = grouped(damage(rows))
    assert set(got) == {r[0] for r in rows}
    for conv, figures in got.items():
        want, kept = brute(after.get(conv, []))
        assert figures == want, conv
        assert lines.get(conv, []) == list(kept)
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in kept))


def test_giant_conversation_in_small_batches(spark):
    r = random.Random(2)
    rows = [(1, i, r.choice(["user", "assistant"]), r.choice(["Yes.", "No", f"n{i}.", ""])) for i in range(6000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        made = cr.audited(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(made) == 1
    audit = made[0].audit
    assert len(audit.replace("I", "")) == 6000 and made[0].cost == sum({"D": 4, "I": 3, "R": 3, "K": 0}[x] for x in audit) + 3 * sum(
        edit != "D" and text == "No" for edit, (_, _, _, text) in zip(audit.replace("I", ""), rows, strict=True)
    )
    few = rows[:200]
    got = cr.audited(spark.createDataFrame(few, "conv_id long, turn long, role string, text string")).first()
    assert tuple(got)[1:] == brute(few)[0]


def test_empty_and_gone(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.audited(cr.damaged(empty)).count() == 0 and cr.repaired(empty).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, gone boolean")
    assert [tuple(r) for r in cr.audited(gone).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    long = spark.createDataFrame([(1, 0, "user", "x " * 500_000 + "."), (1, 1, "assistant", "ok.")], "conv_id long, turn long, role string, text string")
    assert cr.audited(long).first().audit == "KK"
