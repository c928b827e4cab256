"""Registered queries against SQL on the benchmark tables, and every pipeline stage against brute force on its input."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import oracle_compare as oc

import corpus_pipeline
from weirgauge.llm import quality
from weirgauge.llm.oracles import ORACLES
from weirgauge.llm.queries import QUERIES

SMALL, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="benchmark tables not present")


def test_one_query_per_operator():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert oc.differences(QUERIES[name](spark, SMALL), oc.connect(SMALL), ORACLES[name]) == ""


def test_pipeline_stages(spark):
    from test_bpe import REFERENCE
    from test_jaccard_join import brute
    from test_mixing import WORDS, brute_targets

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], TINY).persist())
        assert name == "encoding" or kept[-1].columns == docs.columns
    rows = [df.collect() for df in kept]
    good = {r.doc_id for r in quality.classified(docs, spark.read.parquet(f"{TINY}/labels.parquet")).collect() if r.predicted}
    assert {r.doc_id for r in rows[1]} == good
    last = {}
    for r in rows[1]:
        key = (r.text or "").translate(lower)
        last[key] = max(last.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(last.values())
    assert sorted(r.doc_id for r in rows[3]) == sorted({c for _, _, c in brute([(r.doc_id, r.text) for r in rows[2]])})
    sizes, taken = Counter(), Counter()
    for r in rows[3]:
        sizes[r.source] += len(WORDS.findall(r.text or ""))
    for r in rows[4]:
        taken[r.source] += len(WORDS.findall(r.text))
    assert all(abs(taken[s] - t) <= 128 for s, t in brute_targets(sizes).items())
    assert Counter((r.doc_id, r.n_tokens) for r in rows[5]) == Counter((r.doc_id, len(REFERENCE.encode_ordinary(r.text or ""))) for r in rows[4])
