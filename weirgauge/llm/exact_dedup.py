"""Exact duplicates through an extendible-hash index whose files lie in the shared folder, one for each bucket.

The first bits of a text's key choose a directory slot; slots share a bucket until it overflows, then the directory
doubles and the bucket splits. Each bucket is a range of keys that one owner task works through in key order: texts of
one key are compared byte by byte with the chain of different texts found for that key so far, so neither a short key
nor a collision can join different texts. Copies are met within a task first, so of a text that fills a third of the
table, each task passes on one copy with the rows that hold it. The owner writes to the bucket's file an entry for each
link of a chain, and for each copy passed on the address (bucket, key, link) that its bytes were found at; rows get
their answer from the entry at their address.

Texts are equal when their bytes are equal after lower-casing A-Z. A null text counts as empty. Of equal texts the
largest doc_id stays (null ids last); of rows that repeat both id and text, one stays. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.llm.common import lookup, numbered, shared_path

#: Bytes of different texts above which a bucket splits, and the most bits that a directory may use.
BUCKET_BYTES = 8 << 20
MAX_DEPTH = 16
#: Bytes of texts that a task remembers while it looks for copies; more than one task's share changes nothing but speed.
REMEMBERED_BYTES = 32 << 20
#: Bytes that a remembered row counts for beside its text.
ROW_BYTES = 80

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LIST = pa.list_(pa.int64())
_ROW = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("sha", pa.string()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("copies", pa.int64()), ("ids", _LIST), ("rows", _LIST), ("data", pa.binary())])
#: An entry has no ids and rows; an address has nothing else.
_FILE = pa.schema([("key", pa.int64()), ("chain", pa.int32()), ("sha", pa.string()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("copies", pa.int64()), ("ids", _LIST), ("rows", _LIST), ("bucket", pa.int32())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", _LIST: "array<long>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _stays(a: tuple[int | None, int], b: tuple[int | None, int]) -> tuple[int | None, int]:
    """Of two rows (doc_id, row) with equal texts the one that stays: the larger id, then the smaller row."""
    return max(a, b, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))


def hashed(docs: DataFrame, key_bits: int = 60) -> DataFrame:
    """key (the first bits of the digest), size (bytes) and sha (hex SHA-256) of each normalised text."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower())
    rows = docs.select(F.octet_length(text).cast("long").alias("size"), F.sha2(text, 256).alias("sha"))
    key = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")
    return rows.select(F.shiftright(key, 60 - key_bits).alias("key"), "size", "sha")


class Directory:
    """Slots to buckets. Built by doubling: a bucket that overflows at the directory's own depth doubles the directory."""

    def __init__(self, sizes: dict[int, int], resolution: int, capacity: int):
        """``sizes``: bytes for each prefix of ``resolution`` bits."""
        self.resolution = resolution
        prefix_sums = [0]
        for prefix in range(1 << resolution):
            prefix_sums.append(prefix_sums[-1] + sizes.get(prefix, 0))

        def held(prefix: int, depth: int) -> int:
            width = 1 << (resolution - depth)
            return prefix_sums[(prefix + 1) * width] - prefix_sums[prefix * width]

        depth, slots = 0, [(0, 0)]  # a slot holds its bucket's prefix and depth
        while True:
            full = {b for b in slots if b[1] < resolution and held(*b) > capacity}
            if not full:
                break
            if any(local == depth for _, local in full):
                slots = [b for b in slots for _ in (0, 1)]
                depth += 1
            slots = [(slot >> (depth - b[1] - 1), b[1] + 1) if b in full else b for slot, b in enumerate(slots)]
        self.depth = depth
        numbers = {b: i for i, b in enumerate(dict.fromkeys(slots))}
        self.slots = [numbers[b] for b in slots]
        self.buckets = len(numbers)

    def bucket(self, key: int, key_bits: int) -> int:
        return self.slots[key >> (key_bits - self.depth)] if key_bits >= self.depth else self.slots[key << (self.depth - key_bits)]


def directory(rows: DataFrame, key_bits: int = 60, bucket_bytes: int = BUCKET_BYTES) -> Directory:
    """The directory for the different texts of ``hashed`` rows; the driver sees one sum per prefix, 2 ** MAX_DEPTH at most."""
    bits = min(MAX_DEPTH, key_bits)
    different = rows.groupBy("key", "sha").agg(F.first("size").alias("size"))
    sums = different.groupBy(F.shiftright("key", key_bits - bits).alias("prefix")).agg(F.sum("size").alias("size")).collect()
    return Directory({r.prefix: r.size for r in sums}, bits, bucket_bytes)


class _Copies:
    """A text that a task remembers and the rows that hold it."""

    def __init__(self, bucket: int, key: int, sha: str, data: bytes):
        self.bucket, self.key, self.sha, self.data = bucket, key, sha, data
        self.stays: tuple[int | None, int] | None = None
        self.ids: list[int | None] = []
        self.rows: list[int] = []

    def add(self, doc_id: int | None, row: int) -> None:
        self.stays = (doc_id, row) if self.stays is None else _stays(self.stays, (doc_id, row))
        self.ids.append(doc_id)
        self.rows.append(row)

    def size(self) -> int:
        return len(self.data) + ROW_BYTES * len(self.rows)

    def values(self) -> tuple:
        return self.bucket, self.key, self.sha, *self.stays, len(self.rows), self.ids, self.rows, self.data


def _copies_within(batches: Iterator[pa.RecordBatch], slots: Directory, key_bits: int) -> Iterator[pa.RecordBatch]:
    """Each different text that the task remembers once, with its rows; a text met again after it was passed on is
    passed on again."""
    seen: OrderedDict[tuple[bytes, int], _Copies] = OrderedDict()
    held, ready, ready_size = 0, [], 0

    def batch_of(copies: list[_Copies]) -> pa.RecordBatch:
        columns = zip(*(c.values() for c in copies), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW, strict=True)], schema=_ROW)

    for batch in batches:
        for doc_id, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text"), strict=True):
            data = (text.as_buffer().to_pybytes() if text.is_valid else b"").translate(_LOWER)
            digest, chain = hashlib.sha256(data), 0
            sha = digest.digest()
            while (found := seen.get((sha, chain))) is not None and found.data != data:
                chain += 1  # the same digest, other bytes
            if found is None:
                key = int.from_bytes(sha[:8], "big") >> (64 - key_bits)
                found = seen[sha, chain] = _Copies(slots.bucket(key, key_bits), key, digest.hexdigest(), data)
                held += len(data)
            else:
                seen.move_to_end((sha, chain))
            found.add(doc_id, row)
            held += ROW_BYTES
            while held > REMEMBERED_BYTES:
                ready.append(seen.popitem(last=False)[1])
                held -= ready[-1].size()
                ready_size += ready[-1].size()
            if ready_size > 4 << 20:
                yield batch_of(ready)
                ready, ready_size = [], 0
    for copies in seen.values():
        ready.append(copies)
        ready_size += copies.size()
        if ready_size > 4 << 20:
            yield batch_of(ready)
            ready, ready_size = [], 0
    if ready:
        yield batch_of(ready)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in key order to the address of each and an entry for each link; only the chain of the current key is held."""
    key, chain = None, []

    def entries(links: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*links, strict=True)) if links else [()] * 7
        named = dict(zip(("bucket", "key", "chain", "sha", "keep_id", "keep_row", "copies"), columns, strict=True))
        none = [None] * len(links)
        return pa.RecordBatch.from_arrays([pa.array(named.get(f.name, none), f.type) for f in _FILE], schema=_FILE)

    def closed(chain: list[list]) -> list[tuple]:
        return [(*key, i, sha, *stays, copies) for i, (_, sha, stays, copies) in enumerate(chain)]

    for batch in batches:
        out, links = [], []
        columns = [batch.column(c).to_pylist() for c in ("bucket", "key", "sha", "keep_id", "keep_row", "copies")]
        for (bucket, own, sha, keep_id, keep_row, copies), data in zip(zip(*columns, strict=True), batch.column("data"), strict=True):
            if (bucket, own) != key:
                out += closed(chain)
                key, chain = (bucket, own), []
            data = data.as_buffer()
            link = next((i for i, c in enumerate(chain) if c[0] == data), None)
            if link is None:
                link = len(chain)
                chain.append([pa.py_buffer(data.to_pybytes()), sha, (keep_id, keep_row), copies])
            else:
                chain[link][2] = _stays(chain[link][2], (keep_id, keep_row))
                chain[link][3] += copies
            links.append(link)
        yield entries(out)
        known = {"bucket": batch.column("bucket"), "key": batch.column("key"), "chain": pa.array(links, pa.int32()), "ids": batch.column("ids"), "rows": batch.column("rows")}
        yield pa.RecordBatch.from_arrays([known[f.name].cast(f.type) if f.name in known else pa.nulls(len(links), f.type) for f in _FILE], schema=_FILE)
    yield entries(closed(chain))


def index(docs: DataFrame, slots: Directory, key_bits: int = 60) -> DataFrame:
    """The index of texts with doc_id and row, as read from its files: entries (key, chain, sha, keep_id, keep_row,
    copies) and addresses (key, chain, ids, rows), in a file for each bucket."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _copies_within(batches, slots, key_bits)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row", "text").mapInArrow(within, _ddl(_ROW))
    owned = rows.repartition("bucket").sortWithinPartitions("bucket", "key", "sha")
    path = shared_path(docs.sparkSession, "hash-index")
    owned.mapInArrow(_chains, _ddl(_FILE)).write.partitionBy("bucket").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_ddl(_FILE)).parquet(path)


def groups(docs: DataFrame, key_bits: int = 60, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _grouped(docs.select("doc_id", "text"), key_bits, bucket_bytes).drop("row")


def _grouped(docs: DataFrame, key_bits: int, bucket_bytes: int) -> DataFrame:
    """The same with ``row``: the number that ``docs`` have or else get."""
    slots = directory(hashed(docs, key_bits), key_bits, bucket_bytes)
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id()
    found = index(docs.select("doc_id", row.cast("long").alias("row"), "text"), slots, key_bits)
    address = ["bucket", "key", "chain"]
    entries = found.where("copies is not null").select(*address, "sha", "keep_id", "keep_row", "copies")
    # an address stands for all rows of a task that hold the text; they part after they got their answer
    answered = lookup(found.where("copies is null").select(*address, "ids", "rows"), entries, address, "copies", ["rows"])
    parted = answered.select("keep_id", "keep_row", "copies", "sha", F.explode(F.arrays_zip("ids", "rows")).alias("of"))
    return parted.select(
        F.col("of.ids").alias("doc_id"), F.col("of.rows").alias("row"), "keep_id", F.col("copies").alias("group_size"), (F.col("of.rows") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def deduplicated(docs: DataFrame, key_bits: int = 60, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = numbered(docs, "dedup-documents")
    kept = _grouped(rows.select("doc.doc_id", "doc.text", "row"), key_bits, bucket_bytes).where("kept").select("row")
    return rows.join(kept, "row", "left_semi").select("doc.*")
