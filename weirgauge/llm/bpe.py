"""Byte-level BPE over Arrow batches, and its reverse.

The ranks of a ``.tiktoken`` file become a model of the tokenizers library: bytes are written as characters by the usual
byte table, and every way to split a token into two others is a merge with the token's rank. Each match of the pattern
is encoded separately, so texts are first cut at places where a match surely ends (with the pattern of the public
tokenizers; with any other, texts are not cut), equal pieces are encoded once per task, and the ids and offsets of whole
texts are put together from them. Digests are made of a whole text's ids and of what these decode to. Decoding maps ids back through the byte table; a character whose bytes lie in
several tokens is whole again once their bytes are joined.

A null text is empty and has no ids; a null list of ids decodes to no bytes; ids outside the vocabulary raise an error.
Repeated rows are encoded alike, other columns pass through where a method keeps them, and texts of any length are
processed whole: a task holds one piece of a batch (or one longer text) and a cache of bounded size.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from weirgauge.llm.common import pieces

#: Distinct pieces whose encoding a task remembers before it starts anew; bounds its memory, not its results.
CACHE_PIECES = 600_000
#: A single space between two non-spaces begins a new match, whatever surrounds it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r" \s|\s ")


def byte_table() -> dict[int, str]:
    """Each byte's character: itself where it prints, else the next free one from U+0100."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in printing else next(spare)) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """Encoder and decoder for one set of ranks and one pattern; made once per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, models, pre_tokenizers

        chars = byte_table()

        def written(token: bytes) -> str:
            return "".join(chars[b] for b in token)

        merges = [
            (written(token[:i]), written(token[i:]))
            for token in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        model = models.BPE(vocab={written(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        back = {c: b for b, c in chars.items()}
        self.token_bytes = {i: bytes(back[c] for c in self.tokenizer.id_to_token(i)) for i in ranks.values()}
        self.written_ids = {i: str(i) for i in self.token_bytes}
        self.matches = regex.compile(pattern).findall
        self.cuts = pattern == public_tokenizers.PATTERN
        #: of each piece that was met: its ids, and, where asked for, where the characters of each start and end; as
        #: packed 32-bit numbers
        self.known: dict[str, bytes] = {}
        self.spans: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """Pieces of the text that no match crosses."""
        if not self.cuts:
            return [text] if text else []
        parts = (_CUT.split(text) if _UNSAFE.search(text) else text.split(" ")) if text else []
        parts[1:] = [f" {part}" for part in parts[1:]]
        return parts if not parts or parts[0] else parts[1:]

    def learn(self, texts: list[list[str]], offsets: bool) -> None:
        """Encodes the pieces that are not yet known, or whose offsets are not."""
        known = self.spans if offsets else self.known
        missing = {part for parts in texts for part in parts if part not in known}
        if len(known) + len(missing) > CACHE_PIECES and known:
            self.known.clear()
            self.spans.clear()
            missing = {part for parts in texts for part in parts}
        todo = list(missing)
        split = [self.matches(part) for part in todo]
        flat = list(dict.fromkeys(m for found in split for m in found))
        encode = self.tokenizer.encode_batch if offsets else self.tokenizer.encode_batch_fast
        coded = dict(zip(flat, encode(flat, add_special_tokens=False), strict=True))
        packed = {m: array("i", one.ids).tobytes() for m, one in coded.items()}
        for part, found in zip(todo, split, strict=True):
            self.known[part] = packed[part] if len(found) == 1 else b"".join([packed[m] for m in found])
            if offsets:
                spans, at = array("i"), 0
                for m in found:
                    spans.extend(at + x for span in coded[m].offsets for x in span)
                    at += len(m)
                self.spans[part] = spans.tobytes()

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.cut(text or "") for text in texts]
        self.learn(cut, offsets=False)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, parts)), np.int32) for parts in cut]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of each text, and the first character and the one after the last of each token.

        Tokens that share a character all cover it.
        """
        cut = [self.cut(text or "") for text in texts]
        self.learn(cut, offsets=True)
        out = []
        for parts in cut:
            ids = [self.known[part] for part in parts]
            spans = np.frombuffer(b"".join(map(self.spans.__getitem__, parts)), np.int32).reshape(-1, 2)
            sizes = np.fromiter(map(len, parts), np.int32, len(parts))
            counts = np.fromiter([len(own) >> 2 for own in ids], np.int32, len(parts))
            at = np.repeat(np.cumsum(sizes, dtype=np.int32) - sizes, counts)
            out.append((np.frombuffer(b"".join(ids), np.int32), spans[:, 0] + at, spans[:, 1] + at))
        return out

    def decode(self, ids: Sequence[int] | None) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids or ()))

    def decode_stream(self, ids: list[int]) -> list[str]:
        """The text each token completes: a split character comes with the last of its tokens."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        return [decoder.decode(self.token_bytes[i], n == len(ids)) for n, i in enumerate(ids, 1)]

    def digests(self, ids: Sequence[int]) -> tuple[int, str, str]:
        """Number of the ids, SHA-256 of them as decimals joined by commas, and SHA-256 of what they decode to."""
        joined = ",".join(map(self.written_ids.__getitem__, ids))
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


def _lists(rows: list[np.ndarray]) -> pa.Array:
    """Rows of 32-bit numbers as one list column."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), pa.int32()))


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> Codec:
    return Codec({base64.b64decode(t): r for t, r in json.loads(ranks)}, pattern)


class ByteBpe:
    """The operator: a rank file, read by the driver and broadcast (a vocabulary is bounded), applied to columns."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = [(base64.b64encode(t).decode(), r) for t, r in read_ranks(path).items()]
        self._ranks = spark.sparkContext.broadcast(json.dumps(ranks).encode())
        self._pattern = pattern

    def _map(self, docs: DataFrame, schema: str, columns: list[str], rows: Callable[[Codec, pa.RecordBatch], list[pa.Array]], sized: str | None) -> DataFrame:
        ranks, pattern = self._ranks, self._pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(ranks.value, pattern)
            for batch in pieces(batches, sized) if sized else batches:
                made = rows(codec, batch)
                kept = [batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(kept + made, [x.strip().split(" ")[0] for x in schema.split(";")])

        return docs.mapInArrow(run, schema.replace(";", ","))

    def encode(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """key, ids, starts, ends: token ids and the characters [start, end) that each covers."""

        def rows(codec: Codec, batch: pa.RecordBatch) -> list[pa.Array]:
            coded = codec.encode(batch.column(text).to_pylist())
            return [_lists([row[i] for row in coded]) for i in range(3)]

        kind = dict(docs.dtypes)[key]
        return self._map(docs.select(key, text), f"{key} {kind}; ids array<int>; starts array<int>; ends array<int>", [key], rows, text)

    def decode(self, coded: DataFrame, key: str = "doc_id", ids: str = "ids") -> DataFrame:
        """key, bytes, text: what the ids stand for; bytes that are no UTF-8 become U+FFFD in the text."""

        def rows(codec: Codec, batch: pa.RecordBatch) -> list[pa.Array]:
            data = [codec.decode(x) for x in batch.column(ids).to_pylist()]
            return [pa.array(data, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in data], pa.string())]

        kind = dict(coded.dtypes)[key]
        return self._map(coded.select(key, ids), f"{key} {kind}; bytes binary; text string", [key], rows, None)

    def round_trip(self, docs: DataFrame, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
        """key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, and the ids if asked for: each text is
        encoded, and what is hashed are its ids and what they decode to."""

        def rows(codec: Codec, batch: pa.RecordBatch) -> list[pa.Array]:
            coded = codec.ids(batch.column(text).to_pylist())
            n, ids, data = zip(*[codec.digests(x.tolist()) for x in coded], strict=True)
            made = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())]
            return made + ([_lists(coded)] if with_ids else [])

        schema = f"{key} {dict(docs.dtypes)[key]}; n_tokens long; ids_sha256 string; decoded_sha256 string"
        return self._map(docs.select(key, text), schema + ("; ids array<int>" if with_ids else ""), [key], rows, text)
