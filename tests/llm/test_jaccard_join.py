import random
import re

import pytest

from weirgauge.llm import jaccard_join as jj
from weirgauge.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)])


def reach(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and sets[j]]
    roots = reach(len(rows), links)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for (d, _), r in zip(rows, roots, strict=True) if r == roots[i] and d is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return sorted(out, key=str)


def one_of_each(rows):
    """Of each component its smallest id (null ids last); whatever has no words. Rows that could stand for each other are equal."""
    sets = [shingles(t) for _, t in rows]
    roots = reach(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])])
    out, first = [row for row, s in zip(rows, sets, strict=True) if not s], {}
    for row, s, root in zip(rows, sets, roots, strict=True):
        if s:
            first.setdefault(root, []).append(row)
    for group in first.values():
        out.append(min(group, key=lambda r: (r[0] is None, r[0] or 0)))
    return sorted(out, key=str)


def test_rows_with_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = [text + f" end{i}" for i in range(3)]
    made = [(None, t) for t in near] + [(5, "a b c d e f g"), (5, "other words than those of the first row"), (6, "A B c d e f g"), (7, None), (7, None), (None, " ")]
    docs = spark.createDataFrame([(*m, 1, "x", "y") for m in made], "doc_id long, text string, row long, doc string, stays string").repartition(3)
    kept = jj.one_of_each(docs).collect()
    assert sum(r.doc_id is None and r.text in near for r in kept) == 1
    assert sorted(((r.doc_id, r.text) for r in kept if r.text not in near), key=str) == sorted([made[3], made[4], *made[6:]], key=str)


def rows(seed, vocabulary):
    r = random.Random(seed)
    word = lambda: r.choice("Ab") + str(r.randrange(vocabulary))
    made = []
    for _ in range(14):
        base = [word() for _ in range(r.choice([6, 30, 80, 150]))]
        for _ in range(r.randint(1, 14)):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                words[r.randrange(len(words))] = word()
            made.append(r.choice([" ", "\n "]).join(words[r.choice([0, 0, 1, 4]) :]))
    chain = [word() for _ in range(200)]
    made += [" ".join(chain[i : i + 100]) for i in range(0, 100, 8)]
    common = " ".join(word() for _ in range(12))
    made += [common + " " + " ".join(word() for _ in range(r.randint(1, 30))) for _ in range(40)]
    made += ["one", "ONE", "one two", "one two three four", "One two three four", "", "  ", None, None, "a b c d e", "a " * 400, "a " * 300]
    ids = r.sample(range(10**6), len(made))
    return list(zip(ids, made, strict=True)) + [(ids[0], made[1]), (ids[0], made[1]), (None, made[2]), (None, "nothing else has these words here")]


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, 10**5), (3, 3)])
def test_equals_brute_force(spark, seed, vocabulary):
    made = rows(seed, vocabulary)
    docs = spark.createDataFrame([(*m, "x", 1) for m in made], "doc_id long, text string, set string, n int").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.clustered(docs).collect()), key=str)
    assert got == brute(made)
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == one_of_each(made)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jj.clustered(docs).count() == 0 and jj.one_of_each(docs).count() == 0


def test_components(spark):
    r = random.Random(9)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(200)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    roots = reach(2300, links)
    first = {}
    for i in range(2300):
        first.setdefault(roots[i], i)
    assert got == {i: first[roots[i]] for a, b in links if a != b for i in (a, b)}
