import hashlib
import random

import pytest

from weirgauge.llm import exact_dedup as ed

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stayed = False
        for i in sorted(ids, key=str):
            kept = i == keep and not stayed
            stayed |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    words = ["Ab", "aB", "É", "é", "x y", "", None, "long " * 3000, "İ", "K"]
    made = [(i, r.choice(words) if r.random() < 0.6 else f"text {r.randrange(120)}") for i in range(600)]
    return made + [(1000, "twice"), (1000, "twice"), (1000, "other"), (None, "null id"), (None, "null id"), (7, "null id"), (None, "alone")]


@pytest.mark.parametrize(("key_bits", "bucket_bytes"), [(60, 8 << 20), (60, 200), (4, 50), (1, 10)])
def test_groups_equal_brute_force(spark, rows, key_bits, bucket_bytes):
    docs = spark.createDataFrame([(*row, "a", 1) for row in rows], "doc_id long, text string, sha string, bucket int").repartition(5)
    got = sorted((tuple(r) for r in ed.groups(docs, key_bits, bucket_bytes).collect()), key=str)
    assert got == brute(rows)


def test_deduplicated_keeps_one_of_each(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in ed.deduplicated(docs).collect()), key=str)
    assert len(got) == len({(t or "").translate(LOWER) for _, t in rows})
    assert {(i, (t or "").translate(LOWER)) for i, t in got} == {(k, h) for k, h in {(b[1], t) for b in brute(rows) if b[3] for i, t in ((i, (x or "").translate(LOWER)) for i, x in rows) if i == b[1] and hashlib.sha256(t.encode()).hexdigest() == b[4]}}


def test_clashing_names_and_nulls_without_ids(spark):
    docs = spark.createDataFrame([(None, "A", 1, "x"), (None, "a", 2, "y"), (3, None, 3, "z"), (3, "", 4, "z")], "doc_id long, text string, `row` int, doc string").repartition(2)
    got = ed.deduplicated(docs)
    assert got.columns == docs.columns and len(got.collect()) == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ed.groups(docs).count() == 0 and ed.deduplicated(docs).count() == 0


def test_directory_doubles_until_no_bucket_overflows():
    made = ed.Directory({0: 90, 1: 30, 2: 5, 7: 200}, 3, 100)
    assert made.depth == 2 or made.depth == 3
    sizes = {}
    for prefix, size in {0: 90, 1: 30, 2: 5, 7: 200}.items():
        b = made.bucket(prefix, 3)
        sizes[b] = sizes.get(b, 0) + size
    assert sorted(sizes.values()) == [5, 30, 90, 200] and made.bucket(4, 3) == made.bucket(5, 3)


def test_small_memory_changes_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(ed, "REMEMBERED_BYTES", 20)
    # the function runs here, on Arrow batches, as in a task
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "row": n, "text": t} for n, (i, t) in enumerate(rows)], pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("text", pa.string())]))
    made = [r for b in ed._copies_within(iter([batch]), ed.Directory({}, 2, 10), 60) for r in b.to_pylist()]
    assert sum(r["copies"] for r in made) == len(rows) and len(made) > 200
    written = [r for b in ed._chains(iter([pa.RecordBatch.from_pylist(sorted(made, key=lambda r: (r["key"], r["sha"])), ed._ROW)])) for r in b.to_pylist()]
    entries = [r for r in written if r["copies"] is not None]
    assert len(entries) == len({(t or "").translate(LOWER) for _, t in rows})
    assert sorted(n for r in written if r["copies"] is None for n in r["rows"]) == list(range(len(rows)))


def test_bytes_decide_where_digests_collide(spark, monkeypatch):
    # every text has the same digest here, so only the comparison of bytes tells them apart
    import pyarrow as pa

    class Same:
        def __init__(self, data):
            pass

        def digest(self):
            return bytes(32)

        def hexdigest(self):
            return "0" * 64

    monkeypatch.setattr(ed.hashlib, "sha256", Same)
    texts = ["a", "b", "A", None, "", "b"]
    batch = pa.RecordBatch.from_pylist([{"doc_id": n, "row": n, "text": t} for n, t in enumerate(texts)], pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("text", pa.string())]))
    made = list(ed._copies_within(iter([batch]), ed.Directory({}, 1, 10), 60))
    written = [r for b in ed._chains(iter(made + made)) for r in b.to_pylist()]
    assert sorted((r["keep_id"], r["copies"], r["chain"]) for r in written if r["copies"] is not None) == [(2, 4, 0), (4, 4, 1), (5, 4, 2)]
    assert {tuple(r["rows"]): r["chain"] for r in written if r["copies"] is None} == {(0, 2): 0, (3, 4): 1, (1, 5): 2}


def test_a_file_for_each_bucket(spark, rows):
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, row long").repartition(3)
    slots = ed.directory(ed.hashed(docs), bucket_bytes=200)
    files = ed.index(docs, slots).inputFiles()
    assert 1 < slots.buckets and len(files) == len({f.split("bucket=")[1].split("/")[0] for f in files}) <= slots.buckets
