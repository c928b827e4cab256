import hashlib
import random
import re

import numpy as np
import pytest

from weirgauge.llm import packed
from weirgauge.llm import substring_dedup as sd

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, width):
    order = {}
    docs = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    for i, words in docs:
        key = sd.NULL_ID if i is None else i
        for a in range(len(words) - width + 1):
            w = tuple(words[a : a + width])
            order[w] = min(order.get(w, key), key)
    out = []
    for i, words in docs:
        key = sd.NULL_ID if i is None else i
        gone = set()
        for a in range(len(words) - width + 1):
            if order[tuple(words[a : a + width])] < key:
                gone |= set(range(a, a + width))
        kept = [w for j, w in enumerate(words) if j not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def rows(seed, vocabulary):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    passages = [" ".join(word() for _ in range(r.randint(13, 60))) for _ in range(6)]
    made = []
    for i in range(220):
        parts = [" ".join(word() for _ in range(r.randint(0, 40))) for _ in range(3)]
        if r.random() < 0.6:
            parts.insert(r.randrange(4), r.choice(passages))
        made.append((r.randrange(10**9), r.choice([" ", "\n", " \t "]).join(parts)))
    made += [(-5, passages[0]), (None, passages[0]), (None, passages[1] + " x"), (made[0][0], passages[2]), (made[0][0], passages[2]), (3, None), (4, ""), (5, "a " * 500), (6, "a " * 300 + "b"), (7, "é " * 13), (8, "é " * 12)]
    r.shuffle(made)
    return made


@pytest.mark.parametrize(("seed", "vocabulary", "chunk"), [(1, 10**6, 300), (2, 3, 200), (3, 50, 1 << 21)])
def test_equals_brute_force(spark, seed, vocabulary, chunk):
    made = rows(seed, vocabulary)
    docs = spark.createDataFrame([(*m, "x", 1) for m in made], "doc_id long, text string, doc string, form int").repartition(6)
    got = sorted((tuple(r) for r in sd.deduplicated(docs, chunk=chunk).collect()), key=str)
    assert got == brute(made, 13)


def test_narrow_windows_and_empty(spark):
    made = rows(4, 30)
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in sd.deduplicated(docs, width=2).collect()), key=str) == brute(made, 2)
    assert sd.deduplicated(docs.limit(0)).count() == 0


def test_colliding_hashes_remove_nothing_wrong(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x a b c"), (3, "p q r s")], "doc_id long, text string")
    keyed = {r.doc: r.form for r in sd._keyed(docs).collect()}
    false = [(2, keyed[2], [1], [1], [1], [keyed[1]], [0]), (3, keyed[3], [0], [2], [1], [keyed[1]], [0])]
    monkeypatch.setattr(sd, "paths", lambda *_: spark.createDataFrame(false, sd._PATHS_DDL))
    got = {r.doc_id: r.n_removed for r in sd.deduplicated(docs, width=3).collect()}
    assert got == {1: 0, 2: 3, 3: 0}


def test_packing_is_exact():
    columns = [np.array([2**64 - 1, 0, 5], np.uint64), np.array([-1, 7], np.int64), np.zeros(0, np.int32), np.array([1], np.uint32)]
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(columns, packed.unpack(packed.pack(*columns)), strict=True))
