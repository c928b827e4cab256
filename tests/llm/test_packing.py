import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirgauge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
REFERENCE = Tokenizer.from_file(PATH)
REFERENCE.encode_special_tokens = True


@pytest.fixture(scope="module")
def model(spark):
    return packing.read_model(spark, PATH)


def ids_of(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


ODD = [
    None, "", " ", "\n\t ", "a\x1cb c\x1dd", "café café ́x A B C", "DON'T it's we'll 'S", "<|endoftext|> <|startoftext|>x",
    "İstanbul ΣΣ ẞ 12345 !!??", "x" * 70_000, "\U0001f600" * 50 + " ‍‮", "end \x85 next\x0bline\x0c",
]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    made = [" ".join(r.choice(["Lorem", "ipsum,", "Zürich", "42", "naïve", "(end)."]) + str(r.randrange(40)) for _ in range(r.choice([1, 9, 300, 1500, 2500]))) for _ in range(160)]
    return ODD + made + [made[0]] * 40 + ["one two three " * 30_000, made[5] * 3]


def check(rows, wanted, length, least=0.0):
    """Every document's ids, once each, in gapless sequences; wanted: doc_id to the ids of each of its rows."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(wanted)
    for doc_id, pieces in by_doc.items():
        if len(wanted[doc_id]) == 1:
            got = []
            for start, n, ids in sorted(pieces):
                assert start == len(got) and n == len(wanted[doc_id][0])
                got += ids
            assert got == wanted[doc_id][0]
        else:
            assert Counter(i for _, _, ids in pieces for i in ids) == Counter(i for ids in wanted[doc_id] for i in ids)
    used = padded = 0
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert 0 < at <= length
        used += at
        padded += at if at & (at - 1) == 0 else length
    assert used >= least * padded
    return len(by_sequence)


def test_ids_and_sequences(spark, model, texts):
    rows = [(i, t, "q", 1, b"x") for i, t in enumerate(texts)] + [(None, "no id", "q", 1, b"x"), (7, "again", "q", 1, b"x"), (7, "again", "q", 1, b"x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, length int, ids binary").repartition(5)
    wanted = defaultdict(list)
    for i, text, *_ in rows:
        wanted[i].append(ids_of(text))
    got = packing.packed(docs, model, group_docs=32)
    made = got.withColumn("crc", F.crc32("ids")).collect()
    check(made, wanted, packing.LENGTH, 0.99)
    assert all(r.crc == zlib.crc32(r.ids) for r in made)
    summed = packing.sequences(got).agg(F.sum("used").alias("used"), F.sum("padded").alias("padded")).first()
    assert summed.used == sum(len(x) for ids in wanted.values() for x in ids) and summed.used >= 0.99 * summed.padded


class Counted(dict):
    looked_up = 0

    def get(self, *args):
        self.looked_up += 1
        return super().get(*args)


def test_words_of_a_batch_are_looked_up_once_each(texts):
    with open(PATH, encoding="utf-8") as file:
        tokenizer = packing.WordTokenizer(file.read())
    tokenizer.known = Counted()
    batch = texts + [None, "\v a\fb ", "a\xa0b\u3000c\u2028d\x1fe\tf", "(a) 's 'S don't, ", "   "]
    some = pa.array(["before", *batch, "after"]).slice(1, len(batch))
    for _ in range(2):  # unknown, then known
        tokenizer.known.looked_up = 0
        assert [np.frombuffer(ids, packing.ID).tolist() for ids in tokenizer.encode(some)] == [ids_of(t)[:-1] for t in batch]
        different = {word for text in batch for word in (text or "").split()}
        assert tokenizer.known.looked_up <= 5 * len(different)
    for empty in ([], [None], ["", " "]):
        assert tokenizer.encode(pa.array(empty, pa.string())) == [b""] * len(empty)


def test_small_length(spark, model):
    docs = spark.createDataFrame([(i, "word " * (i % 40)) for i in range(300)], "doc_id long, text string")
    wanted = {i: [ids_of("word " * (i % 40))] for i in range(300)}
    check(packing.packed(docs, model, length=16, group_docs=50).collect(), wanted, 16)


def test_empty(spark, model):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(docs, model).count() == 0


def test_one_small_document_needs_no_padding(spark, model):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    got = packing.packed(docs, model)
    assert [(r.used, r.padded) for r in packing.sequences(got).orderBy("used").collect()] == [(1, 1), (2, 2), (4, 4)]


@pytest.mark.parametrize("seed", range(20))
def test_first_fit_decreasing(seed):
    r = random.Random(seed)
    lengths = [r.randrange(1, 100) for _ in range(r.randrange(1, 200))]
    room, bins = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, free in enumerate(room) if free >= lengths[i]), len(room))
        if at == len(room):
            room.append(128)
            bins.append([])
        room[at] -= lengths[i]
        bins[at].append(i)
    assert packing.first_fit_decreasing(lengths, 128) == bins
    # what closing the bins cuts is still everything, once each
    made = packing.closed(bins, lengths, 128)
    parts = defaultdict(list)
    for spans in made:
        n = sum(m for _, _, m in spans)
        assert 128 - n <= packing.SLACK or n & (n - 1) == 0
        for i, first, m in spans:
            parts[i].append((first, m))
    for i, n in enumerate(lengths):
        at = 0
        for first, m in sorted(parts[i]):
            assert first == at and m > 0
            at += m
        assert at == n
