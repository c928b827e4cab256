import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from weirgauge.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ALPHABETS = [" \n", "ab", "a", "  \t\n\r", "'s tx", "0123 ", "éèaß ", "　 \xa0", "abcdefghij klmnop", "!!??..--==", "日本語の ", "🙂👍 a", "\x1c \x85a"]
CASES = [None, "", " ", "  ", "a", " a", "a ", "a  b", "The's dog\n\n don't  stop ", "🙂" * 3, "x" * 5000, "<|endoftext|>", "a  b", " \n a \n"]


def random_texts(n):
    r = random.Random(7)
    return ["".join(r.choice(r.choice(ALPHABETS)) if r.random() < 0.3 else r.choice(a) for _ in range(r.randint(1, 40))) for a in (r.choice(ALPHABETS) for _ in range(n))]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, public_tokenizers.PATTERN)


def test_ids_equal_the_other_library(codec):
    texts = CASES + random_texts(20000)
    for text, (ids, starts, ends) in zip(texts, codec.encode(texts), strict=True):
        want = REFERENCE.encode_ordinary(text or "")
        assert ids.tolist() == want, text
        assert codec.decode(ids.tolist()) == (text or "").encode()
        assert "".join(codec.decode_stream(ids.tolist())) == (text or "")
        covered = {i for a, b in zip(starts, ends, strict=True) for i in range(a, b)}
        assert covered == set(range(len(text or "")))


def test_characters_of_many_scripts(codec):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert [ids.tolist() for ids, _, _ in codec.encode(texts)] == [REFERENCE.encode_ordinary(t) for t in texts]


def test_split_characters_come_with_their_last_token(codec):
    ids = [RANKS[bytes([b])] for b in "é".encode()]
    assert codec.decode_stream(ids) == ["", "é"]
    assert codec.decode_stream(ids[:1]) == ["�"]


def test_operator(spark):
    texts = CASES + random_texts(300)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens string").repartition(3)
    tool = bpe.ByteBpe(spark, PATH, public_tokenizers.PATTERN)
    for row in tool.round_trip(docs, with_ids=True).collect():
        text = texts[row.doc_id] or ""
        ids = REFERENCE.encode_ordinary(text)
        assert row.n_tokens == len(ids) and row.ids == ids
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: (bytes(r.bytes), r.text) for r in tool.decode(tool.encode(docs)).collect()}
    assert back == {i: ((t or "").encode(), t or "") for i, t in enumerate(texts)}
    assert tool.round_trip(docs.limit(0)).count() == 0


def test_cache_limit_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    texts = random_texts(200)
    one_by_one = [[x.tolist() for x in codec.encode([t])[0]] for t in texts]
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10**6)
    assert one_by_one == [[x.tolist() for x in row] for row in codec.encode(texts)]


def test_other_patterns_are_not_cut():
    """With a pattern whose matches hold spaces between words, no place is known where a match ends."""
    own = bpe.Codec(RANKS, "[a-z ]+|[^a-z ]+")
    other = tiktoken.Encoding("spaces", pat_str="[a-z ]+|[^a-z ]+", mergeable_ranks=RANKS, special_tokens={})
    texts = ["the cat sat on the mat", " of the  of 12 the", ""]
    assert [ids.tolist() for ids, _, _ in own.encode(texts)] == [other.encode_ordinary(t) for t in texts]


def test_a_very_long_text(codec):
    text = "".join(random_texts(3000)) * 20
    ((ids, starts, ends),) = codec.encode([text])
    assert ids.tolist() == REFERENCE.encode_ordinary(text) and codec.decode(ids.tolist()) == text.encode()
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all()
