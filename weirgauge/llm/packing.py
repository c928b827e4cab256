"""Packing token ids of documents into sequences of bounded length by first-fit decreasing.

Documents are tokenized once and written to the shared folder: whole sequences' worth of a long document as sequences of
its own, the rest of every document as one piece. The rests are dealt to randomised groups of bounded size; within a
group they are placed by first-fit decreasing, where a tournament tree over the bins' free room finds the first bin that
a piece fits in. What the last bins hold then fills the room that is left in the others, cut as needed, and the last bin
is cut at powers of two, which need no padding; so a group pads at most ``SLACK`` ids in a sequence.

Ids are those of the tokenizers library for the whole text, without special tokens (their strings are ordinary text),
and the end id. A null text is empty and has the end id only; null and repeated doc_ids and repeated rows are documents
each; an empty table gives no rows; other columns are ignored, whatever their names. Texts are processed whole: a task
holds one text's ids at a time, and a cache of words of bounded size.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgauge.llm.common import pieces, stored

LENGTH, END_ID = 4096, 2
#: Documents in a group, about; the pieces of a group are shorter than a sequence each, so a group is bounded.
GROUP_DOCS = 512
#: Room in a bin that is not worth cutting another document for.
SLACK = 8
#: Words whose ids a task remembers, of at most so many characters; bounds its memory, not its results.
CACHE_WORDS, CACHE_CHARS = 1_000_000, 48
#: ASCII signs but for the apostrophe, and the last of the letters that are one letter each in lower case, whatever
#: stands beside them. Runs of either are one match of the tokenizer's pattern each.
_SIGNS, _LAST_LETTER = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~""", "ÿ"
#: Words or parts that are encoded in one call.
_TOGETHER = 4096
ID = np.dtype("<u4")
#: First id of sequences that a long document fills by itself.
WHOLE = 1 << 62


class WordTokenizer:
    """A tokenizer that drops white space, so that words can be encoded on their own; made once per Python worker.

    Signs around a word of plain letters, and the letters, are one match of the tokenizer's pattern each. Such parts are
    encoded together, since the last token of a match is marked as the end of a word.
    """

    def __init__(self, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}

    def _coded(self, words: list[str], together: bool) -> Iterator[bytes]:
        """Ids of each word; together only words that are one match of the pattern each."""
        for at in range(0, len(words), _TOGETHER):
            some = words[at : at + _TOGETHER]
            if together:
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, ID)
                ends = (np.flatnonzero(self.ends[ids]) + 1) * ID.itemsize
                if len(ends) == len(some) and ends[-1] == ids.nbytes:
                    data = ids.tobytes()
                    yield from (data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
                    continue
            yield from (np.array(coded.ids, ID).tobytes() for coded in self.tokenizer.encode_batch_fast(some, add_special_tokens=False))

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not known, and of their parts."""
        cut, others = [], []
        for word in words:
            right = word.lstrip(_SIGNS)
            core = right.rstrip(_SIGNS)
            if core and not (core.isalpha() and (core.isascii() or max(core) <= _LAST_LETTER)):
                others.append(word)
            else:
                cut.append((word[: len(word) - len(right)], core.lower(), right[len(core) :], word))
        parts = dict.fromkeys(chain.from_iterable(own[:3] for own in cut))
        coded = {part: self.known.get(part) for part in parts}
        missing = [part for part, ids in coded.items() if ids is None and part]
        coded.update(zip(missing, self._coded(missing, True), strict=True))
        coded[""] = b""
        coded.update([(word, coded[a] + coded[b] + coded[c]) for a, b, c, word in cut])
        coded.update(zip(others, self._coded(others, False), strict=True))
        return coded

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        # millions of short-lived objects, none in a cycle: collecting garbage costs a quarter of the time
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: pa.Array) -> list[bytes]:
        # each different word is looked up once; only these are Python objects, and the words' ids are joined by Arrow
        split = pc.ascii_split_whitespace(texts)
        every = split.flatten().dictionary_encode()
        words = every.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = list(map(self.known.get, words))
        unknown = [i for i, ids in enumerate(coded) if ids is None]
        if unknown:
            learned = self._learn([words[i] for i in unknown])
            for i in unknown:
                coded[i] = learned[words[i]]
            if len(self.known) < CACHE_WORDS:
                self.known.update((word, ids) for word, ids in learned.items() if len(word) <= CACHE_CHARS)
            elif np.bincount(every.indices)[unknown].sum() * 4 > len(every):  # other texts than those whose words are remembered
                self.known.clear()
        joined = pa.array(coded, pa.large_binary()).take(every.indices)
        _, offsets, data = joined.buffers()
        if data is None:  # no words
            return [b""] * len(texts)
        ends = np.cumsum(pc.list_value_length(split).fill_null(0), dtype=np.int64)
        at = np.frombuffer(offsets, np.int64)[[0, *ends]].tolist()
        data = memoryview(data)
        return [bytes(data[a:b]) for a, b in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def _tokenizer(model: str) -> WordTokenizer:
    return WordTokenizer(model)


def read_model(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file, read by the driver and broadcast (a vocabulary is bounded)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


_PIECE = "doc_id long, row long, doc_tokens long, start long, length int, ids binary"


def tokenized(docs: DataFrame, model: Broadcast, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents, stored: doc_id, row (tells documents apart), doc_tokens, start, length, ids (binary)."""
    end, size = np.array([end_id], ID).tobytes(), ID.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(model.value)
        for batch in pieces(batches):
            coded = tokenizer.encode(batch.column("text"))
            out = []
            for doc_id, row, ids in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), coded, strict=True):
                ids += end
                n = len(ids) // size
                out += [(doc_id, row, n, at, min(length, n - at), ids[at * size : (at + length) * size]) for at in range(0, n, length)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "row", "doc_tokens", "start", "length", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    return stored(rows.mapInArrow(run, _PIECE), "packing-pieces")


class Tournament:
    """Free room of bins in a complete binary tree whose inner nodes hold the larger of their two: finds the first fit."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.tree = [room] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The first bin with that much room; a tree for as many bins as pieces always has one."""
        at = 1
        while at < self.leaves:
            at *= 2
            if self.tree[at] < need:
                at += 1
        return at - self.leaves

    def take(self, place: int, amount: int) -> None:
        at = place + self.leaves
        self.tree[at] -= amount
        while at > 1:
            at //= 2
            self.tree[at] = max(self.tree[2 * at], self.tree[2 * at + 1])


def first_fit_decreasing(lengths: list[int], length: int = LENGTH) -> list[list[int]]:
    """Places of ``lengths`` by bin, in the order they were put there; equal lengths keep their order."""
    tree = Tournament(len(lengths), length)
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = tree.first(lengths[i])
        tree.take(at, lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


#: Of a piece: its place in the group, the first of its ids that is meant, and how many.
Span = tuple[int, int, int]


def _snug(used: int, length: int) -> bool:
    """Whether a sequence needs next to no padding as it is."""
    return length - used <= SLACK or used & (used - 1) == 0


def closed(bins: list[list[int]], lengths: list[int], length: int = LENGTH) -> list[list[Span]]:
    """Bins as sequences without gaps: the last bins' ids fill the room of the others, the last is cut at powers of two."""
    held = [[(i, 0, lengths[i]) for i in b] for b in bins]
    used = [sum(n for _, _, n in b) for b in held]
    last = len(held) - 1
    at = 0
    while at < last:
        if _snug(used[at], length):
            at += 1
            continue
        if _snug(used[last], length):
            last -= 1
            continue
        i, first, n = held[last].pop()  # the shortest piece of the emptiest bin
        moved = min(n, length - used[at])
        held[at].append((i, first, moved))
        used[at] += moved
        used[last] -= moved
        if moved < n:
            held[last].append((i, first + moved, n - moved))
        if not used[last]:
            last -= 1
    out = []
    for spans, n in zip(held, used, strict=True):
        if n and not _snug(n, length):
            out += powers_of_two(spans, n)
        elif n:
            out.append(spans)
    return out


def powers_of_two(spans: list[Span], used: int) -> list[list[Span]]:
    """The same ids as sequences whose lengths are the binary digits of ``used``, the longest first."""
    out, left = [], list(reversed(spans))
    while used:
        room = 1 << used.bit_length() - 1
        used -= room
        own: list[Span] = []
        while room:
            i, first, n = left.pop()
            own.append((i, first, min(n, room)))
            if n > room:
                left.append((i, first + room, n - room))
            room -= own[-1][2]
        out.append(own)
    return out


_PLACED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PLACED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _group(table: pa.Table, length: int) -> pa.Table:
    """Sequences of one group's pieces; a sequence's id is the group's number and, below 2 ** 32, its own."""
    table = table.sort_by([("length", "descending"), ("row", "ascending"), ("start", "ascending")])
    group = table.column("group")[0].as_py() << 32
    columns = {c: table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "length")}
    ids = table.column("ids").to_pylist()
    out, size = [], ID.itemsize
    for number, spans in enumerate(closed(first_fit_decreasing(columns["length"], length), columns["length"], length)):
        offset = 0
        for i, first, n in spans:
            out.append((columns["doc_id"][i], columns["start"][i] + first, n, ids[i][first * size : (first + n) * size], columns["doc_tokens"][i], group + number, offset))
            offset += n
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PLACED, strict=True)], schema=_PLACED)


def packed(docs: DataFrame, model: Broadcast, length: int = LENGTH, end_id: int = END_ID, group_docs: int = GROUP_DOCS, seed: int = 0) -> DataFrame:
    """doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset of every piece.

    ``length`` is a power of two. Sequences of the groups have ids below ``WHOLE``, full ones of long documents from there.
    """
    made = tokenized(docs, model, length, end_id)
    whole = made.where(F.col("length") == length)
    whole = whole.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens", (F.lit(WHOLE) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = made.where(F.col("length") < length)
    groups = max(1, -(-rest.count() // group_docs))
    dealt = rest.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups)) )

    def run(table: pa.Table) -> pa.Table:
        return _group(table, length)

    return dealt.groupBy("group").applyInArrow(run, PLACED).unionByName(whole)


def sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """sequence_id, used, padded: ids in each sequence, and its length with padding."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padded", F.when(power, F.col("used")).otherwise(F.lit(length).cast("long")))
