import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weirgauge.llm import langid, ngrams, quality
from weirgauge.llm.common import held_out

SYLLABLES = {"en": ["the", "ing", "th", "sh", "er", "and"], "de": ["sch", "ung", "ü", "ein", "heit", "pf"], "fr": ["eau", "oi", "tion", "é", "que", "ai"]}


def sentence(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    made = []
    for i in range(900):
        lang = r.choice(list(SYLLABLES))
        text, good = sentence(r, lang, r.randint(8, 80)), r.random() < 0.7
        if not good:
            text = r.choice([text.upper().replace(" ", "!! "), (text.split()[0] + " ") * 60, text.replace(" ", "### ")])
        made.append((i, text, lang, int(good)))
    return made


def test_features_do_not_depend_on_neighbours():
    texts = ["ab ab c", None, "", "é", "x", "a b a b a b", "words  and\nlines", "z" * 50]
    together = ngrams.Groups(pa.array(texts), 12, (1, 3, 5), True, True, True).sparse()
    for text, (buckets, weights) in zip(texts, together, strict=True):
        alone = ngrams.Groups(pa.array([text], pa.string()), 12, (1, 3, 5), True, True, True).sparse()[0]
        assert np.array_equal(alone[0], buckets) and np.allclose(alone[1], weights)
    table = np.random.default_rng(0).normal(size=(1 << 12, 2))
    means = ngrams.Groups(pa.array(texts), 12, (1, 3, 5), True, True, True).means(table)
    assert np.allclose(means, [weights @ table[buckets] if len(buckets) else [0, 0] for buckets, weights in together])


def test_repeats_see_the_last_distance():
    d = ngrams.Groups._distances(np.array([5, 5, 6, 5, 5, 9], np.uint64), np.array([0, 4, 6]))
    assert d.tolist() == [0, 1, 0, 2, 0, 0]


def test_held_out_is_the_checksum(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in got] == [zlib.crc32(str(r.id).encode()) % 3 == 1 for r in got]


def test_quality(spark, rows):
    odd = [(5000, None), (5001, ""), (5002, "x"), (None, rows[0][1]), (3, rows[3][1]), (5003, "word " * 20000)]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t, _, _ in rows] + [(*o, "a", "b") for o in odd], "doc_id long, text string, label string, score string").repartition(4)
    labels = spark.createDataFrame([(i, q, 0) for i, _, _, q in rows] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, text int")
    got = quality.classified(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    want = {i: q for i, _, _, q in rows}
    tested = [r for r in got if r.held_out and r.doc_id in want]
    assert len(tested) > 200 and sum(r.predicted == want[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    kept = {r.doc_id for r in quality.accepted(docs, labels).collect()}
    assert kept == {r.doc_id for r in got if r.predicted} and quality.accepted(docs, labels).columns == docs.columns


def test_quality_without_both_labels(spark):
    docs = spark.createDataFrame([(0, "a b"), (2, None)], "doc_id long, text string")
    for labels, want in (([], 0.5), ([(0, 1)], 1.0), ([(0, 0)], 0.0)):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        assert [r.score for r in quality.classified(docs, table).collect()] == pytest.approx([want] * 2)
    assert quality.classified(docs.limit(0), table).count() == 0


def test_language(spark, rows):
    odd = [(5000, None, "en"), (5001, "", "en"), (5002, "12 34 !!", "de"), (None, rows[0][1], "fr"), (5003, "the " * 20000, None)]
    docs = spark.createDataFrame([(i, t, lang, "b") for i, t, lang, q in rows if q] + [(*o, "b") for o in odd], "doc_id long, text string, lang string, _letters string").repartition(3)
    got = {r.doc_id: r for r in langid.identified(docs).collect()}
    want = {i: lang for i, _, lang, _ in rows}
    tested = [r for r in got.values() if r.held_out and r.doc_id in want]
    assert sum(r.lang_pred == want[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert [(got[i].lang_pred, got[i].score) for i in (5000, 5001, 5002)] == [("und", 0.0)] * 3
    assert got[5003].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())


def test_language_with_one_or_none(spark):
    docs = spark.createDataFrame([(0, "abc", "xx"), (2, "def", None), (3, "1", "xx")], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.identified(docs).orderBy("doc_id").collect()] == ["xx", "xx", "und"]
    assert {r.lang_pred for r in langid.identified(docs.where("lang is null")).collect()} == {"und"}
    assert langid.identified(docs.limit(0)).count() == 0


def test_codewords_differ():
    for n in (2, 4, 7, 20):
        codes = langid.codewords(n)
        assert len({tuple(c) for c in codes.tolist()}) == n
        if n > 3:
            assert min((a != b).sum() for i, a in enumerate(codes) for b in codes[:i]) >= 3
