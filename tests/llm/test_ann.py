import numpy as np
import pytest

from weirgauge.llm import ann

SCHEMA = "vec_id long, embedding array<float>, v string, first long"


def brute(rows, every=20, k=20):
    length = max((len(v) for _, v in rows), default=0)
    x = np.array([v for _, v in rows], float).reshape(len(rows), length)
    ids = np.array([i for i, _ in rows])
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % every == 0:
            score = (x * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), score[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24)).astype(np.float32) * rng.choice([0.5, 1, 3], (1500, 1)).astype(np.float32)
    x[::3] = 9 * x[0]
    return [(int(i), [float(a) for a in v]) for i, v in zip(rng.permutation(4000)[:1500], x, strict=True)]


def test_recall_and_scores(spark, rows, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    odd = [(80000, None), (80020, [0.0] * 24), (80040, [float("nan")] * 24), (80060, [float("inf")] * 24), (80080, [None] * 24), (80100, [1.0]), (None, [1.0] * 24)]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows + odd + [rows[5]]], SCHEMA).repartition(4)
    got, want = answers(ann.search(docs)), brute(rows)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert recall(got, want) >= 0.9
    score = {q: dict(w) for q, w in brute(rows, k=len(rows)).items()}
    for q, found in got.items():
        assert all(s == pytest.approx(score[q][i], abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda a: (-a[1], a[0]))
    # rows of the common vector answer exactly, ties to the smaller id
    common = [i for i, v in rows if v == rows[0][1]]
    for q in (i for i in common if i % 20 == 0):
        assert [i for i, _ in got[q]] == sorted(i for i in common if i != q)[:20] == [i for i, _ in want[q]]


@pytest.mark.parametrize("n", [12_000, 24_000, 50_000])
def test_full_answers_with_many_lists(spark, n):
    """Far more lists than LEAST, the sample being the whole table and a part of it: no query lacks a row."""
    assert n // ann.LIST_SIZE > 5 * ann.LEAST and (n < ann.SAMPLE) == (n == 12_000)
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 24)).astype(np.float32) * rng.choice([0.5, 1, 3], (n, 1)).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got, want = answers(ann.search(docs, every=60)), brute(rows, every=60)
    assert set(got) == set(want)
    assert all(len(found) == len({i for i, _ in found}) == 20 for found in got.values())
    assert recall(got, want) >= 0.9


def test_ratio_follows_the_data():
    """Vectors in clusters read few lists; without clusters, as many as their neighbours need."""
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(6000, 24))
    centres = rng.normal(size=(100, 24))
    grouped = centres[rng.integers(0, 100, 6000)] + 0.1 * rng.normal(size=(6000, 24))
    within = []
    for x in (spread, grouped):
        lists = ann.learn(x, float(np.sqrt((x**2).sum(axis=1)).max()), 60)
        near, far = lists.nearest(lists.lengthened(x), ann.REPLICAS)
        row, at = np.nonzero(far <= far[:, :1] * ann.CLOSURE)
        entered = np.zeros((len(x), 60), bool)
        entered[row, near[row, at]] = True
        ratio, most = ann.measured(lists, x, entered, 20)
        assert ratio >= 1 and 1 <= most <= 60
        within.append(most)
    assert within[1] < within[0] / 2
    one = ann.learn(spread[:1], 10.0, 1)
    assert ann.measured(one, spread[:1], np.ones((1, 1), bool), 20) == (1.0, 1)


def test_few_and_none(spark):
    docs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert answers(ann.search(docs)) == {0: [(1, 0.5), (20, 0.5)], 20: [(0, 0.5), (1, 0.25)]}
    assert ann.search(docs.limit(0)).count() == 0
    assert ann.search(docs.where("vec_id = 0")).count() == 0


def test_walks_find_the_nearest_lists():
    rng = np.random.default_rng(0)
    lists = ann.learn(rng.normal(size=(4000, 8)), 10.0, 100)
    points = lists.as_query(rng.normal(size=(300, 8)))
    near, far = lists.nearest(points, 10)
    gap = np.sqrt(((points[:, None] - lists.centroids[None]) ** 2).sum(axis=2))
    want = np.sort(gap, axis=1)[:, :10]
    assert np.isclose(far, want).mean() > 0.95 and np.allclose(np.take_along_axis(gap, near, 1), far)
