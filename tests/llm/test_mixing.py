import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weirgauge.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Iterative resharing, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_ones, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_ones:
        level = left / sum(weight[s] for s in open_ones)
        over = {s for s in open_ones if weight[s] * level >= 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_ones}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ones -= over
    return target


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    made = [(i, r.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"]), " ".join(f"w{r.randrange(99)}" for _ in range(r.choice([0, 1, 5, 70, 900])))) for i in range(700)]
    return made + [(9001, "tiny", "one"), (9002, "none", None), (9003, "blank", " \n "), (None, "a", "x y z"), (7, "a", "x y z"), (7, "a", "x y z"), (9004, "b", "w " * 30000)]


def test_mix(spark, rows):
    docs = spark.createDataFrame([(*row, "q", 1) for row in rows], "doc_id long, source string, text string, size string, draws int").repartition(4)
    drawn = mixing.draws(docs, shards=6)
    got = mixing.taken(drawn).collect()
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(WORDS.findall(text or ""))
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    source_of = {i: s for i, s, _ in rows}
    total = Counter()
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        total[source] += r.taken
    for source, target in want.items():
        assert abs(total[source] - target) <= 2 * mixing.BLOCK_WORDS
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken(mixing.draws(docs.repartition(7), shards=6)).collect()))
    # shards draw disjoint blocks, in sizes that differ by one block at most
    flat = drawn.select("source", F.explode("draws").alias("d")).select("source", "d.*").distinct().collect()
    blocks = {(r.source, r.place): r.shard for r in flat}
    assert all(blocks[r.source, r.place] == r.shard for r in flat)
    counts = Counter(blocks.values())
    assert set(counts) == set(range(6)) and max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("sources,words,most", [(90, 700, 64), (9, 70, mixing.MOST_BLOCKS)])
def test_small_sources_meet_their_targets(spark, monkeypatch, sources, words, most):
    """Sources that are small beside the corpus (as with so few blocks for all of it), or beside a block."""
    monkeypatch.setattr(mixing, "MOST_BLOCKS", most)
    docs = spark.createDataFrame([(i, f"s{i % sources:02}", "w " * (words // 2)) for i in range(2 * sources)], "doc_id long, source string, text string")
    want = brute_targets({f"s{i:02}": words for i in range(sources)})
    got = mixing.draws(docs).select("source", F.expr("aggregate(draws, 0L, (s, d) -> s + d.to - d.from)").alias("n")).groupBy("source").agg(F.sum("n").alias("n")).collect()
    assert len(got) == sources
    for r in got:
        assert abs(r.n - want[r.source]) <= 0.03 * want[r.source], (r, want[r.source])


def test_split_is_exact_and_hypergeometric(spark):
    one = spark.createDataFrame([([40, 0, 25, 1],)], "quotas array<bigint>")
    firsts = []
    for seed in range(120):
        shards = {r.shard: r.quotas for r in mixing.split_quotas(one, 2, seed).collect()}
        assert [sum(x) for x in zip(*shards.values(), strict=True)] == [40, 0, 25, 1] and [sum(shards[i]) for i in (0, 1)] == [33, 33]
        firsts.append(shards[0][0])
    mean, var = 33 * 40 / 66, 33 * 40 / 66 * 26 / 66 * 33 / 65
    assert abs(sum(firsts) / len(firsts) - mean) < 4 * (var / len(firsts)) ** 0.5
    spread = sum((x - mean) ** 2 for x in firsts) / len(firsts)
    assert 0.6 * var < spread < 1.5 * var


def test_shards_and_documents(spark, rows):
    unique = list({i: row for row in rows if (i := row[0]) is not None}.values())
    docs = spark.createDataFrame([(*row, len(row[2] or "")) for row in unique], "doc_id long, source string, text string, n_chars long")
    want = {r.doc_id: r.taken for r in mixing.taken(mixing.draws(docs)).collect()}
    for made in (mixing.shuffled_shards(docs), mixing.mixed_documents(docs)):
        got = Counter()
        for r in made.collect():
            got[r.doc_id] += len(WORDS.findall(r.text))
        assert {i: n for i, n in want.items() if n} == dict(got)
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_rows_with_null_and_repeated_ids(spark):
    """Rows are told apart whatever their ids: the mix holds the words that are taken, none from another row's text."""
    made = [(None, "a", " ".join(f"{c}{i}" for i in range(53))) for c in "xyz"] + [(4, "b", "p q r"), (4, "b", "s t u"), (4, "b", "s t u"), (4, None, "v " * 90)]
    made += [(None, "a", None)] + [(i, "c", f"c{i} " * 40) for i in range(30)]
    docs = spark.createDataFrame([(*m, 1, "x", "y", "z") for m in made], "doc_id long, source string, text string, size int, `row` string, doc string, at string").repartition(3)
    drawn = mixing.draws(docs)
    want = Counter()
    for r in mixing.taken(drawn).collect():
        want[r.doc_id, r.size] += r.taken
    size = {t: len(WORDS.findall(t or "")) for _, _, t in made}
    for got in (mixing.mixed_documents(docs), mixing.shuffled_shards(docs)):
        words, by_text = Counter(), Counter()
        for r in got.collect():
            own = WORDS.findall(r.text)
            whole = next(t for i, _, t in made if i == r.doc_id and t and set(own) <= set(t.split()))
            words[r.doc_id, size[whole]] += len(own)
            by_text[whole] += len(own)
        assert {k: n for k, n in want.items() if n} == dict(words)
        copies = Counter(t for _, _, t in made)
        assert all(n <= 2 * size[t] * copies[t] for t, n in by_text.items())
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_equal_sources_share_alike(spark):
    """Nine sources of the same size, so that several have the same ratio of size to weight."""
    docs = spark.createDataFrame([(i, f"s{i % 9}", "w " * 35) for i in range(18)], "doc_id long, source string, text string")
    got = {r.source: r.target for r in mixing.targets(docs.select("source", mixing.n_words().alias("size"))).collect()}
    assert got == pytest.approx(brute_targets({f"s{i}": 70 for i in range(9)})) and sum(got.values()) == pytest.approx(945)


def test_empty_and_wordless(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.taken(mixing.draws(docs)).count() == 0
    docs = spark.createDataFrame([(1, None, None), (2, "a", "")], "doc_id long, source string, text string")
    assert [(r.size, r.target, r.taken) for r in mixing.taken(mixing.draws(docs)).collect()] == [(0, 0.0, 0)] * 2
