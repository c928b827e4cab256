"""Repeated word sequences between documents, by a De Bruijn graph of word windows.

Every window of ``WIDTH`` words is an edge of the graph, known by a 64-bit hash and by its source coordinates (document,
first word). Tasks meet equal edges among their own documents first and pass on only those of the smallest document,
so an edge that a third of the documents hold reaches its owner once per task. Owners of hash ranges find the edges that
several documents hold and send each occurrence, with the coordinates of the edge's first source, to its document.
There, edges that continue one another in both documents compact into nonbranching paths: (start, windows, source,
source start). Documents are then joined with their paths once; every path is verified by a digest of its words taken
at both coordinates, so a collision of hashes cannot remove words.

A null text has no words. A null id is larger than every other; rows with one id are not each other's sources, and are
told apart by their texts. Texts of any length are processed whole, other columns are ignored, an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.llm.common import pieces, stored
from weirgauge.llm.packed import bucket_of, pack, unpack
from weirgauge.llm.wordhash import Words, inside, windows

WIDTH = 13
#: Windows that a task compares among themselves before it passes them on, and about as many in an owner's range.
CHUNK_WINDOWS = 1 << 20
NULL_ID = 2**63 - 1

_ROW = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("data", pa.binary())])
_PATHS = pa.schema(
    [("doc", pa.int64()), ("form", pa.int32()), ("starts", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("source", pa.list_(pa.int64())), ("source_form", pa.list_(pa.int32())), ("source_starts", pa.list_(pa.int32()))]
)
_PATHS_DDL = "doc long, form int, starts array<int>, counts array<int>, source array<long>, source_form array<int>, source_starts array<int>"


def _shard(doc: np.ndarray, shards: int) -> np.ndarray:
    return bucket_of(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), shards)


def _sends(doc: np.ndarray, form: np.ndarray, start: np.ndarray, source: np.ndarray, source_form: np.ndarray, source_start: np.ndarray, shards: int, bucket: int) -> pa.RecordBatch:
    """Occurrences (document, window) with their source, packed for the shards of the documents."""
    shard = _shard(doc, shards)
    order = np.lexsort((start, form, doc, shard))
    columns = [c[order] for c in (doc, form, start, source, source_form)] + [(source_start - start)[order]]
    ends = np.flatnonzero(np.diff(shard[order])) + 1
    bounds = [0, *ends.tolist(), len(order)] if len(order) else [0]
    blocks = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        part = [c[a:b] for c in columns]
        moved = [np.diff(c, prepend=c.dtype.type(0)) for c in part[:5]]
        blocks.append((bucket, int(shard[order[a]]), pack(*moved, part[5])))
    return _batch(blocks, _ROW)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _first_source(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For occurrences sorted by hash, document and start: mask of those with a smaller document, index of their
    source, and mask of those that belong to the smallest document."""
    head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    source = np.repeat(head, np.diff(np.append(head, len(hashes))))
    covered = doc > doc[source]
    return covered, source, ~covered


def _edges(batches: Iterator[pa.RecordBatch], width: int, buckets: int, shards: int, chunk: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    total = 0
    for batch in pieces(batches, limit=1 << 20):
        found = Words(batch.column("text"))
        hashes, first = windows(found.hashes(), width), found.first
        keep = np.flatnonzero(inside(first, width))
        text = np.searchsorted(first[1:], keep, side="right")
        ids = batch.column("doc").to_numpy()[text]
        held.append((hashes[keep], ids, batch.column("form").to_numpy()[text], (keep - first[text]).astype(np.int32)))
        total += len(keep)
        if total >= chunk:
            yield from _flush(held, buckets, shards)
            held, total = [], 0
    if total:
        yield from _flush(held, buckets, shards)


def _flush(held: list[tuple[np.ndarray, ...]], buckets: int, shards: int) -> Iterator[pa.RecordBatch]:
    hashes, doc, form, start = (np.concatenate(c) for c in zip(*held, strict=True))
    held.clear()
    order = np.lexsort((start, doc, hashes))
    hashes, doc, form, start = hashes[order], doc[order], form[order], start[order]
    covered, source, own = _first_source(hashes, doc)
    c, s = np.flatnonzero(covered), source[covered]
    if len(c):  # already decided; they pass an owner on their way
        yield _sends(doc[c], form[c], start[c], doc[s], form[s], start[s], shards, int(hashes[0] % np.uint64(buckets)))
    hashes, doc, form, start = hashes[own], doc[own], form[own], start[own]
    bucket = bucket_of(hashes, buckets)
    bounds = np.searchsorted(bucket, np.arange(buckets + 1))
    rows, size = [], 0
    for b in range(buckets):
        x, y = bounds[b], bounds[b + 1]
        if x == y:
            continue
        # documents as a table of their own: which they are, and for each edge its place in the table
        docs, place = np.unique(np.stack([doc[x:y], form[x:y].astype(np.int64)]), axis=1, return_inverse=True)
        last = np.zeros(docs.shape[1] + 1, np.int64)
        np.maximum.at(last, place + 1, start[x:y] + 1)
        offset = np.cumsum(last)
        data = pack(np.diff(hashes[x:y], prepend=np.uint64(0)), (offset[place] + start[x:y]).astype(np.uint32), np.diff(docs[0], prepend=0), docs[1].astype(np.int32), np.diff(offset).astype(np.uint32))
        rows.append((b, -1, data))
        size += len(data)
        if size > 1 << 22:
            yield _batch(rows, _ROW)
            rows, size = [], 0
    yield _batch(rows, _ROW)


def _own(table: pa.Table, shards: int) -> pa.Table:
    """Occurrences of one hash range: those that have a source in a smaller document go to their documents."""
    out, parts = [], []
    for bucket, shard, data in zip(*(table.column(c) for c in _ROW.names), strict=True):
        if shard.as_py() >= 0:
            out.append(_batch([(bucket.as_py(), shard.as_py(), data.as_py())], _ROW))
            continue
        gaps, place, ids, forms, lengths = unpack(data.as_buffer())
        offset = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
        which = np.searchsorted(offset, place, side="right") - 1
        parts.append((np.cumsum(gaps), np.cumsum(ids)[which], forms[which], (place - offset[which]).astype(np.int32)))
    if parts:
        hashes, doc, form, start = (np.concatenate(c) for c in zip(*parts, strict=True))
        parts.clear()
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        same = ordered[1:] == ordered[:-1]
        several = np.zeros(len(ordered), bool)
        several[1:] |= same
        several[:-1] |= same
        order = order[several]  # most edges occur once and need no more sorting
        order = order[np.lexsort((start[order], doc[order], hashes[order]))]
        hashes, doc, form, start = hashes[order], doc[order], form[order], start[order]
        covered, source, _ = _first_source(hashes, doc)
        c, s = np.flatnonzero(covered), source[covered]
        if len(c):
            out.append(_sends(doc[c], form[c], start[c], doc[s], form[s], start[s], shards, 0))
    return pa.Table.from_batches(out, _ROW)


def _compact(table: pa.Table) -> pa.Table:
    """Paths of the documents of one shard."""
    parts = []
    for data in table.column("data"):
        *moved, shift = unpack(data.as_buffer())
        doc, form, start, source, source_form = (np.cumsum(c, dtype=c.dtype) for c in moved)
        parts.append((doc, form, start, source, source_form, start + shift))
    doc, form, start, source, source_form, source_start = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((source_start, source, start, form, doc))
    doc, form, start, source, source_form, source_start = (c[order] for c in (doc, form, start, source, source_form, source_start))
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (form[1:] != form[:-1]) | (start[1:] != start[:-1])])
    doc, form, start, source, source_form, source_start = (c[fresh] for c in (doc, form, start, source, source_form, source_start))
    new_doc = np.concatenate([[True], (doc[1:] != doc[:-1]) | (form[1:] != form[:-1])])
    branch = new_doc.copy()
    branch[1:] |= (np.diff(start) != 1) | (np.diff(source) != 0) | (np.diff(source_form) != 0) | (np.diff(source_start) != 1)
    at = np.flatnonzero(branch)
    counts = np.diff(np.append(at, len(doc)))
    docs_at = np.flatnonzero(new_doc)
    offsets = pa.array(np.append(np.searchsorted(at, docs_at), len(at)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c, t)) for c, t in ((start[at], pa.int32()), (counts, pa.int32()), (source[at], pa.int64()), (source_form[at], pa.int32()), (source_start[at], pa.int32()))]
    return pa.Table.from_arrays([pa.array(doc[docs_at], pa.int64()), pa.array(form[docs_at], pa.int32()), *lists], schema=_PATHS)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (never null), form (tells rows of one id apart), doc_id, text."""
    text = F.coalesce("text", F.lit(""))
    ident = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(ident, F.lit(NULL_ID)).alias("doc"), F.hash(text).alias("form"), ident.alias("doc_id"), text.alias("text"))


def paths(docs: DataFrame, width: int = WIDTH, chunk: int = CHUNK_WINDOWS) -> DataFrame:
    """One row per document with repeated windows: doc, form, and arrays starts, counts (of windows), source,
    source_form, source_starts, one element per path."""
    keyed = _keyed(docs)
    spark = docs.sparkSession
    words = (keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    # at least as many ranges as shuffle partitions, and more as the corpus grows, so that a range stays small
    buckets = shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // CHUNK_WINDOWS + 1)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _edges(batches, width, buckets, shards, chunk)

    def own(table: pa.Table) -> pa.Table:
        return _own(table, shards)

    row = "bucket int, shard int, data binary"
    sent = keyed.select("doc", "form", "text").mapInArrow(edges, row).groupBy("bucket").applyInArrow(own, row)
    return sent.groupBy("shard").applyInArrow(_compact, _PATHS_DDL)


_DIGESTS = "array<struct<doc: long, form: int, start: int, count: int, digest: binary>>"
_RESULT = f"doc_id long, doc long, form int, n_words long, n_removed long, kept_sha256 string, mine {_DIGESTS}, asked {_DIGESTS}"
_RESULT_NAMES = ["doc_id", "doc", "form", "n_words", "n_removed", "kept_sha256", "mine", "asked"]


def cleaned_words(text: bytes, starts: list[int], counts: list[int], width: int) -> tuple[list[bytes], list[bytes]]:
    """All words, and those that no path covers."""
    words = text.split()  # splits at the six bytes that separate words
    if not starts:
        return words, words
    keep = bytearray(b"\1") * len(words)
    for start, count in zip(starts, counts, strict=True):
        n = count + width - 1
        keep[start : start + n] = bytes(n)
    return words, list(compress(words, keep))


def _apply(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    digests = pa.list_(pa.struct([("doc", pa.int64()), ("form", pa.int32()), ("start", pa.int32()), ("count", pa.int32()), ("digest", pa.binary())]))

    def digest(words: list[bytes], start: int, count: int) -> bytes:
        return hashlib.sha1(b" ".join(words[start : start + count + width - 1])).digest()

    for batch in pieces(batches):
        lists = {c: batch.column(c).to_pylist() for c in ("doc_id", "doc", "form", "starts", "counts", "source", "source_form", "source_starts", "wanted")}
        out = []
        for i, text in enumerate(batch.column("text")):
            row = {c: v[i] for c, v in lists.items()}
            words, kept = cleaned_words(text.as_buffer().to_pybytes(), row["starts"] or [], row["counts"] or [], width)
            mine = [
                {"doc": d, "form": f, "start": s, "count": n, "digest": digest(words, a, n)}
                for a, n, d, f, s in zip(*(row[c] or [] for c in ("starts", "counts", "source", "source_form", "source_starts")), strict=True)
            ]
            asked = [{"doc": row["doc"], "form": row["form"], "start": w["start"], "count": w["count"], "digest": digest(words, w["start"], w["count"])} for w in row["wanted"] or []]
            out.append((row["doc_id"], row["doc"], row["form"], len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), mine, asked))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), digests, digests]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], _RESULT_NAMES)


def _removed(docs: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Result rows with digests of their paths here (mine) and of the paths whose source they are (asked)."""
    parts = found.select(F.explode(F.arrays_zip("source", "source_form", "source_starts", "counts")).alias("p"))
    asked = parts.select(F.col("p.source").alias("doc"), F.col("p.source_form").alias("form"), F.col("p.source_starts").alias("start"), F.col("p.counts").alias("count")).distinct()
    asked = asked.groupBy("doc", "form").agg(F.collect_list(F.struct("start", "count")).alias("wanted"))
    joined = _keyed(docs).join(found, ["doc", "form"], "left").join(asked, ["doc", "form"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _apply(batches, width)

    return joined.mapInArrow(run, _RESULT)


def deduplicated(docs: DataFrame, width: int = WIDTH, chunk: int = CHUNK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    found = stored(paths(docs, width, chunk), "paths")
    result = stored(_removed(docs, found, width), "removed")
    same = ["doc", "form", "start", "count", "digest"]
    mine = result.select(F.col("doc").alias("at"), F.col("form").alias("at_form"), F.explode("mine").alias("m")).select("at", "at_form", "m.*")
    asked = result.select(F.explode("asked").alias("a")).select("a.*").distinct()
    wrong = stored(mine.join(asked, same, "left_anti").select("at", "at_form", "doc", "form", "start", "count"), "wrong-paths")
    out = result.select("doc_id", "n_words", "n_removed", "kept_sha256", "doc", "form")
    if not wrong.isEmpty():  # two word sequences share a 64-bit hash: such a path removes nothing
        docs_wrong = wrong.select(F.col("at").alias("doc"), F.col("at_form").alias("form")).distinct()
        zipped = found.join(docs_wrong, ["doc", "form"], "left_semi").select(F.col("doc").alias("at"), F.col("form").alias("at_form"), F.explode(F.arrays_zip("starts", "counts", "source", "source_form", "source_starts")).alias("p"))
        right = zipped.join(
            wrong.withColumnsRenamed({"doc": "source", "form": "source_form", "start": "source_starts", "count": "counts"}),
            [zipped["at"] == wrong["at"], zipped["at_form"] == wrong["at_form"]] + [F.col(f"p.{c}") == F.col(c) for c in ("source", "source_form", "source_starts", "counts")],
            "left_anti",
        )
        names = ("starts", "counts", "source", "source_form", "source_starts")
        again = right.groupBy(F.col("at").alias("doc"), F.col("at_form").alias("form")).agg(*(F.collect_list(f"p.{c}").alias(c) for c in names))
        keyed = _keyed(docs)
        some = keyed.join(docs_wrong, ["doc", "form"], "left_semi").select("doc_id", "text")
        redone = _removed(some, again, width).select("doc_id", "n_words", "n_removed", "kept_sha256", "doc", "form")
        out = out.join(docs_wrong, ["doc", "form"], "left_anti").unionByName(redone)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")
