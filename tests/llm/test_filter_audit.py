import random
import re
from itertools import permutations

import numpy as np
import pytest

from weirgauge.llm import filter_audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Applies the filters one after the other, order by order."""
    rows = []
    for doc_id, text, source in docs:
        text = text or ""
        words = WORDS.findall(text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs),
        }
        marks = [(q, t) for i, q, t in labels if i is not None and i == doc_id]
        rows.append((source or "", fails, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        made = []
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, x in enumerate(order, 1):
                now = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                total[x] += len(now)
                alone = sum(r[1][x] and sum(r[1].values()) == 1 for r in own)
                made.append(((part, "".join(order), step), x, (len(left), len(now), sum(r[1][x] for r in gone), alone, sum(r[2] for r in now), sum(r[3] for r in now))))
                gone = gone + now
        out |= {key: (*figures, total[x]) for key, x, figures in made}
    return out


@pytest.fixture(scope="module")
def tables():
    r = random.Random(4)
    docs = []
    for i in range(260):
        words = [r.choice(["word", "Word", "WORD", "é", "x#", " y", "z"]) + str(r.randrange(r.choice([5, 400]))) for _ in range(r.choice([0, 1, 49, 50, 51, 120]))]
        docs.append((i, r.choice([" ", "\n", "\t "]).join(words), r.choice(["hot", "hot", "a", "b", None, ""])))
    docs += [(r.randrange(300, 900), docs[r.randrange(9)][1], "hot") for _ in range(90)]
    docs += [(None, docs[0][1], "a"), (None, None, None), (1000, None, "n"), (1001, "", "n"), (5, docs[5][1], "a"), (5, docs[5][1], "a"), (1002, "w " * 40_000, "long")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (5, 1, 0)]
    return docs, labels


def result(spark, docs, labels):
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, mask int, part string").repartition(4)
    marks = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, mask int")
    return filter_audit.audit(filter_audit.counted(filter_audit.failures(table), marks)).collect()


def test_against_brute_force(spark, tables):
    want = brute(*tables)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in result(spark, *tables)}
    assert len(got) == 600 * len({d[2] or "" for d in tables[0]}) and got == want


def test_min_plus_steps():
    orders = np.array(list(permutations(range(4))))
    steps = filter_audit.removal_steps(orders)
    for o, order in enumerate(orders):
        for mask in range(16):
            first = next((s for s, f in enumerate(order) if mask >> f & 1), None)
            assert steps[o, mask] == first if first is not None else steps[o, mask] >= filter_audit.NEVER


def test_some_orders_and_empty(spark, tables):
    docs, labels = tables
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sums = filter_audit.counted(filter_audit.failures(table), marks)
    assert {r.filter_order for r in filter_audit.audit(sums, orders=["ABCDE", "EDCBA"]).collect()} == {"ABCDE", "EDCBA"}
    assert result(spark, [], labels) == [] and len(result(spark, docs[:1], [])) == 600
