"""Exact Jaccard join of the word-shingle sets of documents, with skipping by set relations.

Shingles are ordered from rare to common by a count of all shingles (bounded: 2 ** SKETCH_BITS counters, so equal
counters are ordered by hash). Two sets with similarity of at least ``percent`` / 100 share a shingle among the first
of each, so only those enter the inverted index, with set size and position. Index lists are read by blocks of set
size; a pair is skipped unless sizes and positions allow the overlap that the similarity needs.

Sets are derived from similar ones instead of being compared with all:
1. Equal sets are one set from the start, met within each task first.
2. Every set is compared with one head only: the set that most of its lists begin with. That overlap is exact.
3. Sets that are connected by now need no comparison with one another. Other pairs in common lists are skipped if
   their overlaps with a common head already bound theirs; what is left is compared exactly, pair by pair.
So every link between different texts is found or implied, and no group is expanded into its pairs.

A set: distinct ``width``-word shingles of the lower-cased (A-Z) text; with fewer words, the whole sequence as one;
without words, empty and linked with nothing. Null texts have no words. Null ids take part, but no component is named
after them unless it has no other id. Rows that repeat an id are documents each: rows are told apart by a number of their
own. Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgauge.llm.common import lookup, numbered, pieces, stored
from weirgauge.llm.components import components
from weirgauge.llm.packed import bucket_of, pack, unpack
from weirgauge.llm.wordhash import Words, inside, mix, windows

WIDTH, PERCENT = 5, 80
SKETCH_BITS = 22
SEGMENTS = 64
#: Shingles that a task handles at once, and about as many index entries in an owner's hash range.
CHUNK = 1 << 20


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) and the text that each belongs to."""
    found = Words(texts, lower=True)
    words, first = found.hashes(), found.first
    keep = np.flatnonzero(inside(first, width))
    hashes = [windows(words, width)[keep]]
    text = [np.searchsorted(first[1:], keep, side="right")]
    counts = found.counts()
    for n in range(1, width):  # too few words: the sequence as a whole
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes.append(mix(windows(words, n)[first[short]] ^ np.uint64(n)))
            text.append(short)
    return np.concatenate(hashes), np.concatenate(text)


class Sets:
    """The sets of a batch: shingles sorted by text, level and hash, without repeats; size and name of each set."""

    def __init__(self, texts: pa.Array, width: int, levels: np.ndarray | None):
        hashes, text = shingles(texts, width)
        level = levels[hashes >> np.uint64(64 - SKETCH_BITS)] if levels is not None else np.zeros(len(hashes), np.uint8)
        order = np.lexsort((hashes, level, text))
        hashes, text = hashes[order], text[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        self.hashes, self.text = hashes[fresh], text[fresh]
        self.bounds = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.sizes = np.diff(self.bounds)
        total = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(mix(self.hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
        self.names = mix(total[self.bounds[1:]] - total[self.bounds[:-1]] + self.sizes.astype(np.uint64)).view(np.int64)


def _counts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in pieces(batches, limit=1 << 20):
        made = Sets(batch.column("text"), width, None)
        np.add(counts, np.bincount((made.hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32), out=counts)
    parts = np.split(counts, SEGMENTS)
    yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array([pack(p) for p in parts], pa.binary())], ["segment", "data"])


def _level(table: pa.Table) -> pa.Table:
    """How common the shingles of one segment's counters are, from the counts of all tasks."""
    total = np.zeros((1 << SKETCH_BITS) // SEGMENTS, np.uint64)
    for data in table.column("data"):
        total += unpack(data.as_buffer())[0]
    made = np.minimum(8 * np.log2(total + 1.0), 255).astype(np.uint8)
    return pa.table({"segment": table.column("segment").slice(0, 1).cast(pa.int32()), "data": pa.array([pack(made)], pa.binary())})


def levels(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """How common the shingles of each counter are, in eighths of powers of two; counts cover all documents.

    The driver gets a byte for each counter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counts(batches, width)

    made = docs.select("text").mapInArrow(count, "segment int, data binary").groupBy("segment").applyInArrow(_level, "segment int, data binary")
    return np.concatenate([unpack(r.data)[0] for r in sorted(made.collect(), key=lambda r: r.segment)] or [np.zeros(1 << SKETCH_BITS, np.uint8)])


def prefix_lengths(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many of the rarest shingles two sets must share one of, to have the similarity."""
    return np.where(sizes > 0, sizes + (-percent * sizes) // 100 + 1, 0)


_ROW = pa.schema([("bucket", pa.int32()), ("data", pa.binary())])
_LIST = pa.schema([("token", pa.int64()), ("set", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def _index(batches: Iterator[pa.RecordBatch], levels: np.ndarray, width: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    total = 0
    for batch in pieces(batches, limit=1 << 20):
        made = Sets(batch.column("text"), width, levels)
        pos = np.arange(len(made.hashes)) - made.bounds[made.text]
        keep = pos < prefix_lengths(made.sizes, percent)[made.text]
        text = made.text[keep]
        held.append((made.hashes[keep], made.names[text], made.sizes[text].astype(np.int32), pos[keep].astype(np.int32)))
        total += int(keep.sum())
        if total >= CHUNK:
            yield _flush(held, buckets)
            total = 0
    if total:
        yield _flush(held, buckets)


def _flush(held: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    hashes, names, n, pos = (np.concatenate(c) for c in zip(*held, strict=True))
    held.clear()
    order = np.lexsort((names, hashes))
    hashes, names, n, pos = hashes[order], names[order], n[order], pos[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (names[1:] != names[:-1])  # equal sets enter once
    hashes, names, n, pos = hashes[fresh], names[fresh], n[fresh], pos[fresh]
    bounds = np.searchsorted(bucket_of(hashes, buckets), np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(bounds)):
        x, y = bounds[b], bounds[b + 1]
        sets, at, place = np.unique(names[x:y], return_index=True, return_inverse=True)
        rows.append((int(b), pack(np.diff(hashes[x:y], prepend=np.uint64(0)), place.astype(np.uint32), pos[x:y], np.diff(sets, prepend=0), n[x:y][at])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROW, strict=True)], schema=_ROW)


def _partnered(bounds: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Mask of the list entries that sizes and positions allow to link with another entry of their list.

    Entries i and j may link if need[j] <= reach[i] and need[i] <= reach[j]; in order of need, the largest reach so far
    (and the next largest, for an entry's own) tells for each entry whether there is such another one.
    """
    keep = np.zeros(len(n), bool)
    need, reach = percent * n, (100 + percent) * (n - pos) - percent * n
    counts = np.diff(bounds)
    for m in np.unique(counts[counts <= 64]):  # short lists: all of one length at once
        starts, step = bounds[:-1][counts == m], max(1, (1 << 20) // int(m * m))
        for i in range(0, len(starts), step):
            at = starts[i : i + step, None] + np.arange(m)
            met = need[at][:, None] <= reach[at][:, :, None]
            met &= met.transpose(0, 2, 1)
            met[:, np.arange(m), np.arange(m)] = False
            keep[at] = met.any(axis=2)
    for a, b in zip(bounds[:-1][counts > 64].tolist(), bounds[1:][counts > 64].tolist(), strict=True):
        order = a + np.argsort(need[a:b], kind="stable")
        first = second = -1
        best, where, other = [], [], []
        for i, r in zip(order.tolist(), reach[order].tolist(), strict=True):
            if first < 0 or r > best[-1]:
                second, first = first, i
            elif second < 0 or r > reach[second]:
                second = i
            best.append(int(reach[first]))
            where.append(first)
            other.append(int(reach[second]) if second >= 0 else -1)
        upto = np.searchsorted(need[order], reach[a:b], side="right") - 1
        at = np.maximum(upto, 0)
        most = np.where(np.array(where)[at] == np.arange(a, b), np.array(other)[at], np.array(best)[at])
        keep[a:b] = (upto >= 0) & (most >= need[a:b])
    return keep


def _lists(table: pa.Table, percent: int) -> pa.Table:
    """Index entries of one hash range whose shingle is in several sets that may link."""
    parts = []
    for data in table.column("data"):
        gaps, place, pos, sets, n = unpack(data.as_buffer())
        sets = np.cumsum(sets)
        parts.append((np.cumsum(gaps), sets[place], n[place], pos))
    hashes, names, n, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    several = np.zeros(len(ordered), bool)
    several[1:] |= same
    several[:-1] |= same
    order = order[several]
    order = order[np.lexsort((names[order], hashes[order]))]
    hashes, names, n, pos = hashes[order], names[order], n[order], pos[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (names[1:] != names[:-1])
    hashes, names, n, pos = hashes[fresh], names[fresh], n[fresh], pos[fresh]
    head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    keep = _partnered(np.append(head, len(hashes)), n.astype(np.int64), pos.astype(np.int64), percent)
    return pa.Table.from_arrays([pa.array(c) for c in (hashes[keep].view(np.int64), names[keep], n[keep], pos[keep])], schema=_LIST)


def needed(n1: Column, n2: Column, percent: int) -> Column:
    """Overlap that sets of these sizes need for the similarity."""
    return F.ceil(F.lit(percent) * (n1 + n2) / F.lit(100 + percent)).cast("long")


def may_link(n1: Column, pos1: Column, n2: Column, pos2: Column, percent: int) -> Column:
    """Whether sets that share a shingle at these positions can overlap enough, if none before is shared."""
    return F.least(n1 - pos1, n2 - pos2) >= needed(n1, n2, percent)


def _size_class(n: Column, percent: int) -> Column:
    """Sets of which one is at most 100 / percent times as large are in the same or in neighbouring classes."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(100 / percent) + 1e-9)).cast("long")


def _set_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, limit=1 << 20):
        made = Sets(batch.column("text"), width, None)
        data = [pack(np.diff(made.hashes[a:b], prepend=np.uint64(0))) for a, b in zip(made.bounds[:-1], made.bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(made.names), batch.column("head"), pa.array(data, pa.binary())], ["set", "head", "data"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact overlaps of pairs of packed sets."""
    for batch in pieces(batches, "data1", 8 << 20):
        out = []
        for one, two in zip(batch.column("data1"), batch.column("data2"), strict=True):
            x, y = (np.cumsum(unpack(d.as_buffer())[0]) for d in (one, two))
            out.append((len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
        n1, n2, both = (pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ())))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), n1, n2, both], ["a", "b", "n1", "n2", "overlap"])


_OVERLAP = "a long, b long, n1 long, n2 long, overlap long"


def _linked(percent: int) -> Column:
    return F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("n1") + F.col("n2") - F.col("overlap"))


def named_sets(keyed: DataFrame, width: int = WIDTH) -> DataFrame:
    """row, doc_id, set (its name, null if empty) and n_shingles of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=1 << 20):
            made = Sets(batch.column("text"), width, None)
            names = pa.array(made.names, mask=made.sizes == 0)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), names, pa.array(made.sizes, pa.int64())], ["row", "doc_id", "set", "n_shingles"])

    return keyed.mapInArrow(run, "row long, doc_id long, set long, n_shingles long")


def _keyed(rows: DataFrame) -> DataFrame:
    """row, doc_id and text of ``numbered`` documents."""
    return rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.coalesce("doc.text", F.lit("")).alias("text"))


def inverted_lists(docs: DataFrame, order: Broadcast, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """token, set, n, pos: the index entries that several sets share."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 30 // CHUNK + 1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _index(batches, order.value, width, percent, buckets)

    def own(table: pa.Table) -> pa.Table:
        return _lists(table, percent)

    return docs.select("text").mapInArrow(index, "bucket int, data binary").groupBy("bucket").applyInArrow(own, "token long, set long, n int, pos int")


def links(docs: DataFrame, named: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between sets that connect exactly the sets which chains of similar sets connect."""
    order = docs.sparkSession.sparkContext.broadcast(levels(docs, width))
    lists = stored(inverted_lists(docs, order, width, percent), "lists")
    # the head of a list is the set with the fewest rare shingles of its own before the common one
    heads = lists.groupBy("token").agg(F.min(F.struct("pos", "n", "set")).alias("h"), F.count("*").alias("size"))
    pairs = lookup(lists, heads, ["token"], "size", ["set"])
    pairs = pairs.where((F.col("set") != F.col("h.set")) & may_link(F.col("n"), F.col("pos"), F.col("h.n"), F.col("h.pos"), percent))
    votes = pairs.groupBy("set", F.col("h.set").alias("head")).agg(F.count("*").alias("votes"))
    chosen = votes.groupBy("set").agg(F.max(F.struct("votes", "head"))["head"].alias("head"))
    nodes = stored(lists.select("set").distinct().join(chosen, "set", "left"), "nodes")
    # sets of the documents in question, made again from one text each
    one = named.where("set is not null").groupBy("set").agg(F.min("row").alias("_row"))
    texts = docs.join(nodes.join(one, "set"), F.col("row") == F.col("_row")).select("head", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _set_rows(batches, width)

    sets = stored(texts.mapInArrow(make, "set long, head long, data binary"), "sets")
    sets_of = lambda n: sets.select(F.col("set").alias(f"set{n}"), F.col("data").alias(f"data{n}"))
    used = nodes.where("head is not null").select(F.col("head").alias("set2")).distinct()
    first = sets.where("head is not null").select(F.col("set").alias("a"), F.col("head").alias("b"), F.col("data").alias("data1"))
    first = first.join(sets_of(2).join(used, "set2", "left_semi"), F.col("b") == F.col("set2")).select("a", "b", "data1", "data2")
    first = stored(first.mapInArrow(_overlaps, _OVERLAP).distinct(), "head-overlaps")
    found = first.where(_linked(percent)).select("a", "b")
    more = _other_pairs(lists, nodes, first, components(found), percent)
    if more.isEmpty():
        return found
    second = more.join(sets_of(1), F.col("a") == F.col("set1")).select("a", "b", "data1")
    second = second.join(sets_of(2), F.col("b") == F.col("set2")).select("a", "b", "data1", "data2")
    second = stored(second.mapInArrow(_overlaps, _OVERLAP).where(_linked(percent)).select("a", "b"), "pair-links")
    return found.unionByName(second)


def _other_pairs(lists: DataFrame, nodes: DataFrame, first: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets not yet connected that share a list and may be similar."""
    overlaps = first.select(F.col("a").alias("set"), F.col("overlap"))
    known = nodes.join(overlaps, "set", "left").join(labels.withColumnRenamed("node", "set"), "set", "left")
    known = known.select("set", F.coalesce("component", "set").alias("component"), "head", "overlap")
    entries = stored(lists.join(known, "set"), "entries")
    per_part = entries.groupBy("token", "component").agg(F.count("*").alias("n"))
    per_list = per_part.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("most"), F.sum("n").alias("size"))
    open_lists = lookup(entries, per_list.where("parts > 1"), ["token"], "size", ["set"]).where("parts is not null")
    open_lists = stored(open_lists.withColumn("block", _size_class(F.col("n"), percent)).drop("parts", "size"), "open-lists")
    # all but a list's largest component look for partners, in the blocks of sizes that can be similar
    few = open_lists.where("component <> most").withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    few = few.select(*(F.col(c).alias(f"{c}1") for c in ("token", "block", "set", "n", "pos", "component", "head", "overlap")))
    n1, n2 = F.col("n1"), F.col("n")
    bound = F.least("overlap1", "overlap") + F.least(n1 - F.col("overlap1"), n2 - F.col("overlap"))
    derived = F.coalesce(F.col("head1") == F.col("head"), F.lit(False)) & (bound < needed(n1, n2, percent))
    pairs = open_lists.join(
        few,
        (F.col("token") == F.col("token1")) & (F.col("block") == F.col("block1")) & (F.col("component") != F.col("component1")) & may_link(n1, F.col("pos1"), n2, F.col("pos"), percent) & ~derived,
    )
    pairs = pairs.select(F.least("set", "set1").alias("a"), F.greatest("set", "set1").alias("b")).distinct()
    return stored(pairs, "open-pairs")


def clustered(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, n_shingles, component_id and stays (true for one row of each component) of every document."""
    return _clustered(_keyed(numbered(docs.select("doc_id", "text"), "join-documents")), width, percent)


def _clustered(docs: DataFrame, width: int, percent: int) -> DataFrame:
    named = stored(named_sets(docs, width), "named-sets")
    labels = components(links(docs, named, width, percent))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    members = named.where("set is not null").groupBy("set").agg(first.alias("first"), F.count("*").alias("size"))
    placed = stored(members.join(labels, F.col("set") == F.col("node"), "left").select("set", "first", "size", F.coalesce("component", "set").alias("component")), "placed")
    # components hold few different sets or very many; the smallest id is combined within tasks and looked up
    smallest = placed.groupBy("component").agg(F.min("first").alias("named_after"), F.count("*").alias("sets"))
    by_set = lookup(placed, smallest, ["component"], "sets", ["set"]).select("set", "named_after", "size")
    out = lookup(named, by_set, ["set"], "size", ["row"])
    alone = F.col("set").isNull()
    return out.select("row", "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("named_after.doc_id")).alias("component_id"), (alone | (F.col("row") == F.col("named_after.row"))).alias("stays"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents that stay if one of each component does: that after which it is named; all columns kept.

    Documents without words are linked with nothing and stay. Of rows that repeat the id and the words, one stays; of a
    component without any id, one.
    """
    rows = numbered(docs, "join-documents")
    stays = _clustered(_keyed(rows), width, percent).where("stays").select("row")
    return rows.join(stays, "row", "left_semi").select("doc.*")
