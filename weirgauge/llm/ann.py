"""Nearest neighbours by largest inner product, over balanced posting lists.

Equal vectors are one vector with their smallest ids (as many as a result can need), so a vector that a third of all
rows share is one entry. One more coordinate makes all vectors equally long, which turns the largest inner product into
the smallest distance. The driver learns the lists' centroids from a bounded sample by halving groups at the median
between two means, so lists are balanced; it links each centroid to its nearest ones, and tasks walk this graph in
memory to find a vector's nearest lists. A vector near a boundary enters several lists (all within ``CLOSURE`` of the
nearest distance, ``REPLICAS`` at most). A query reads the lists whose distance is within a ratio of its nearest one, at
least ``LEAST`` of them, and more while those hold too few vectors for a full answer. The ratio is measured, not set: it
is the least at which ``PROBES`` of the sample's vectors find ``FOUND`` of their neighbours in the sample, so vectors in
clusters read few lists, and vectors without any read as many as the recall needs. Long lists and many queries are cut into
blocks that meet pairwise, so no task holds a whole list. Found vectors that cannot be in the answer are left out early,
by a floor under each query's scores: the last of the k + 1 best among the sample's vectors in the very lists that the
query reads. These are found, so a floor never costs a row.

Vectors that are null or zero, hold null or non-finite values, or have another length than most, take no part; nor do
rows without an id. Rows that repeat an id count once, with the smallest of their vectors. Fewer candidates than asked
for are all returned. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgauge.llm.common import lookup, stored

K = 20
#: Vectors that the centroids are learned from, at most; vectors in a list on average; lists at most.
SAMPLE, LIST_SIZE, MOST_LISTS = 20_000, 200, 2048
REPLICAS, CLOSURE = 4, 1.15
LEAST = 8
#: Vectors of the sample that the ratio is measured with, and the share of their neighbours that has to be found.
PROBES, FOUND = 256, 0.97
DEGREE = 16
#: Vectors and queries that meet in one task at once.
BLOCK = 4096


@dataclass
class Lists:
    """Centroids in the lengthened space, the graph between them, where walks start, and the length of all vectors."""

    centroids: np.ndarray
    graph: np.ndarray
    starts: np.ndarray
    length: float

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.length**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def as_query(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors * (self.length / np.sqrt((vectors**2).sum(axis=1)))[:, None]
        return np.column_stack([scaled, np.zeros(len(vectors))])

    def nearest(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first walks over the graph, all points of a block in step: nearest lists found, and their distances."""
        width = min(width, len(self.centroids))
        found = [self._walk(points[i : i + 256], width) for i in range(0, len(points), 256)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _walk(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, rows = len(points), np.arange(len(points))[:, None]
        norms = (self.centroids**2).sum(axis=1)
        keep = max(width, len(self.starts))
        ids = np.full((n, keep), -1)
        gaps = np.full((n, keep), np.inf)
        done = np.ones((n, keep), bool)
        seen = np.zeros((n, len(self.centroids)), bool)
        fresh = np.broadcast_to(self.starts, (n, len(self.starts)))
        while True:
            new = ~seen[rows, fresh]
            seen[rows, fresh] = True
            gap = norms[fresh] - 2 * np.einsum("nd,nmd->nm", points, self.centroids[fresh])
            # a neighbour met twice in one step counts once
            order = np.argsort(fresh, axis=1, kind="stable")
            again = np.zeros_like(new)
            again[rows, order[:, 1:]] = np.diff(np.take_along_axis(fresh, order, 1), axis=1) == 0
            gap = np.where(new & ~again, gap, np.inf)
            ids, gaps, done = np.column_stack([ids, fresh]), np.column_stack([gaps, gap]), np.column_stack([done, np.isinf(gap)])
            best = np.argsort(gaps, axis=1, kind="stable")[:, :keep]
            ids, gaps, done = ids[rows, best], gaps[rows, best], done[rows, best]
            todo = ~done
            active = todo.any(axis=1)
            if not active.any():
                break
            at = np.where(active, todo.argmax(axis=1), 0)
            done[np.arange(n), at] |= active
            fresh = self.graph[np.maximum(ids[np.arange(n), at], 0)]
        far = np.sqrt(np.maximum(gaps[:, :width] + (points**2).sum(axis=1)[:, None], 0))
        return ids[:, :width], far


def learn(sample: np.ndarray, length: float, lists: int, seed: int = 0) -> Lists:
    """Balanced groups of the sample by repeated halving; their means are the centroids."""
    made = Lists(np.zeros((0, 0)), np.zeros((0, 0), int), np.zeros(0, int), length)
    points, rng = made.lengthened(sample), np.random.default_rng(seed)
    groups = [np.arange(len(points))]
    while len(groups) < min(lists, len(points)):
        groups.sort(key=len)
        group = groups.pop()
        part = points[group]
        means = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            side = ((part - means[0]) ** 2).sum(axis=1) - ((part - means[1]) ** 2).sum(axis=1)
            order, half = np.argsort(side, kind="stable"), len(part) // 2
            means = np.stack([part[order[:half]].mean(axis=0), part[order[half:]].mean(axis=0)])
        groups += [group[order[:half]], group[order[half:]]]
    centroids = np.stack([points[g].mean(axis=0) for g in groups])
    gap = (centroids**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * centroids @ centroids.T
    near = np.argsort(gap, axis=1, kind="stable")[:, 1 : DEGREE + 1]
    if near.shape[1] == 0:
        near = np.zeros((len(centroids), 1), int)
    # a ring through all centroids keeps the graph connected
    ring = np.roll(np.arange(len(centroids)), -1)[:, None]
    starts = np.unique(np.linspace(0, len(centroids) - 1, min(len(centroids), 8)).astype(int))
    return Lists(centroids, np.column_stack([near, ring]), starts, length)


def measured(lists: Lists, sample: np.ndarray, entered: np.ndarray, k: int) -> tuple[float, int]:
    """The ratio of distances, and the most lists within it, at which probes find ``FOUND`` of their k nearest.

    ``entered`` says in which lists each vector of the sample is. A neighbour is found by the nearest of its lists.
    """
    at = np.unique(np.linspace(0, len(sample) - 1, min(len(sample), PROBES)).astype(int))
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0, 1
    scores = sample[at] @ sample.T
    scores[np.arange(len(at)), at] = -np.inf
    nearest = np.argpartition(scores, len(sample) - k, axis=1)[:, len(sample) - k :]
    points = lists.as_query(sample[at])
    gap = (points**2).sum(axis=1)[:, None] + (lists.centroids**2).sum(axis=1) - 2 * points @ lists.centroids.T
    gap = np.sqrt(np.maximum(gap, 0))
    best = gap.min(axis=1)
    met = np.stack([np.where(entered[near], far, np.inf).min(axis=1) for near, far in zip(nearest, gap, strict=True)])
    floor = np.finfo(float).tiny
    ratio = float(np.quantile(met / np.maximum(best, floor)[:, None], FOUND, method="higher"))
    return ratio, int((gap <= best[:, None] * ratio).sum(axis=1).max())


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and v (array of double) of the rows that take part, one per id."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.coalesce(good, F.lit(False))).groupBy("id").agg(F.min("v").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == F.lit(lengths["d"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best(table: pa.Table, other: pa.Table, k: int) -> pa.Table:
    """The k best vectors of one block for each query of another: by inner product, then by smallest id; none below
    the query's floor, which its k best reach."""
    ids, firsts, x = (table.column(c) for c in ("uid", "first", "v"))
    ids, firsts, x = ids.to_numpy(), firsts.to_numpy(), _matrix(x)
    queries, q, floors = other.column("uid").to_numpy(), _matrix(other.column("v")), other.column("floor").to_numpy()
    if not len(ids) or not len(queries):
        return pa.table({"query": pa.array([], pa.int64()), "uid": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    n, out = min(k, len(ids)), []
    for a in range(0, len(queries), 512):
        part = q[a : a + 512]
        rough = part @ x.T
        cut = np.maximum(np.partition(rough, len(ids) - n, axis=1)[:, len(ids) - n], floors[a : a + 512])
        # what ties with the last one, up to rounding, is scored exactly as well
        row, col = np.nonzero(rough >= (cut - 1e-9 * (1 + np.abs(cut)))[:, None])
        score = (part[row] * x[col]).sum(axis=1)
        order = np.lexsort((firsts[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < n
        out.append((queries[a + row[keep]], ids[col[keep]], firsts[col[keep]], score[keep]))
    return pa.table(dict(zip(("query", "uid", "first", "score"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))


def search(vectors: DataFrame, every: int = 20, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, key, vector), "vectors")
    # of equal vectors, k + 1 ids are enough for any result
    by_id = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    counts = rows.groupBy("v").agg(F.count("*").alias("size"), F.max(F.col("id") % every == 0).alias("asked"))
    different = stored(few.join(counts, "v").select(F.monotonically_increasing_id().alias("uid"), "v", "ids", F.col("ids")[0].alias("first"), "size", "asked"), "vectors")
    n, longest = different.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = different.orderBy(F.xxhash64("v"), "first").limit(SAMPLE).select("uid", "v").toArrow()
    known_vectors = _matrix(sample.column("v"))
    lists = learn(known_vectors, float(longest), max(1, min(MOST_LISTS, n // LIST_SIZE)))
    shared = spark.sparkContext.broadcast(lists)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            near, far = shared.value.nearest(shared.value.lengthened(_matrix(batch.column("v"))), REPLICAS)
            row, at = np.nonzero((near >= 0) & (far <= far[:, :1] * CLOSURE))
            columns = [batch.column(c).take(pa.array(row)) for c in ("uid", "first", "v")]
            yield pa.RecordBatch.from_arrays([pa.array(near[row, at].astype(np.int32)), *columns, pa.nulls(len(row), pa.float64())], ["list", "uid", "first", "v", "floor"])

    schema = "list int, uid long, first long, v array<double>, floor double"
    entries = stored(different.select("uid", "first", "v").mapInArrow(enter, schema), "posting-lists")
    held = {r["list"]: r["count"] for r in entries.groupBy("list").count().collect()}
    sizes_of = np.array([held.get(i, 0) for i in range(len(lists.centroids))])
    # in which lists the sample's vectors really are
    sampled = spark.createDataFrame(sample.select(["uid"]))
    placed = entries.join(F.broadcast(sampled), "uid").select("uid", "list").toArrow()
    order = np.argsort(sample.column("uid").to_numpy())
    entered = np.zeros((len(known_vectors), len(lists.centroids)), bool)
    entered[order[np.searchsorted(sample.column("uid").to_numpy(), placed.column("uid").to_numpy(), sorter=order)], placed.column("list").to_numpy()] = True
    known_sample = spark.sparkContext.broadcast((known_vectors, np.packbits(entered, axis=1), sizes_of))
    # of the k nearest in the table, the sample holds its share
    ratio, within = measured(lists, known_vectors, entered, max(1, -(-k * len(known_vectors) // n)))
    reach = max(LEAST, within)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (sample, bits, sizes) = shared.value, known_sample.value
        # a vector is in REPLICAS lists at most, so lists with so many entries hold k + 1 vectors
        entered, need = np.unpackbits(bits, axis=1, count=len(sizes)).astype(np.float32), (k + 1) * REPLICAS
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                x = _matrix(part.column("v"))
                near, far = known.nearest(known.as_query(x), reach)
                keep = (near >= 0) & (far <= far[:, :1] * ratio)
                keep[:, :LEAST] |= near[:, :LEAST] >= 0
                count = np.where(near >= 0, sizes[near], 0)
                keep |= (near >= 0) & (np.cumsum(count, axis=1) - count < need)
                reads = np.zeros((len(x), len(sizes)), bool)
                row, at = np.nonzero(keep)
                reads[row, near[row, at]] = True
                reads[reads @ sizes < need] = True
                floor = np.full(len(x), -np.inf)
                if len(sample) > k:
                    scores = np.where(reads.astype(np.float32) @ entered.T > 0, x @ sample.T, -np.inf)
                    floor = np.partition(scores, len(sample) - k - 1, axis=1)[:, len(sample) - k - 1]
                    floor -= 1e-9 * (1 + known.length * np.sqrt((x**2).sum(axis=1)))  # beyond all rounding
                row, at = np.nonzero(reads)
                columns = [part.column(c).take(pa.array(row)) for c in ("uid", "first", "v")]
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *columns, pa.array(floor[row])], ["list", "uid", "first", "v", "floor"])

    asked = stored(different.where("asked").select("uid", "first", "v").mapInArrow(ask, schema), "list-queries")
    # blocks of long lists and of many queries: every block of one meets every block of the other; at most MOST_LISTS rows
    parts = {i: n // BLOCK + 1 for i, n in held.items()}
    turns = {r["list"]: r["count"] // BLOCK + 1 for r in asked.groupBy("list").count().collect()}
    sizes = spark.createDataFrame([(i, parts.get(i, 1), turns.get(i, 1)) for i in range(len(lists.centroids))], "list int, parts int, turns int")

    def blocks(rows: DataFrame, own: str, other: str, name: str, across: str) -> DataFrame:
        met = rows.join(F.broadcast(sizes), "list")
        met = met.withColumn(name, F.pmod(F.xxhash64("uid"), F.col(own)).cast("int"))
        return met.withColumn(across, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("list", "part", "turn", "uid", "first", "v", "floor")

    def best(one: pa.Table, two: pa.Table) -> pa.Table:
        return _best(one, two, k + 1)

    keys = ["list", "part", "turn"]
    met = blocks(entries, "parts", "turns", "part", "turn").groupBy(*keys).cogroup(blocks(asked, "turns", "parts", "turn", "part").groupBy(*keys))
    found = met.applyInArrow(best, "query long, uid long, first long, score double")
    # a vector comes from at most REPLICAS lists
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first", "uid")
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= (k + 1) * REPLICAS).drop("r").dropDuplicates(["query", "uid"])
    top = top.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    named = top.join(different.select("uid", "ids"), "uid").select("query", "score", F.explode("ids").alias("vec_id"))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1)
    answers = named.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("answers"))
    # from vectors back to rows: the rows of one vector share its answers, each without itself
    per_vector = stored(different.where("asked").join(answers, F.col("uid") == F.col("query")).select("v", "answers", "size"), "answers")
    queries = lookup(rows.where(F.col("id") % every == 0), per_vector, ["v"], "size", ["id"])
    own = F.expr("slice(filter(answers, a -> a.vec_id <> id), 1, " + str(k) + ")")
    out = queries.select(F.col("id").alias("query_id"), F.posexplode(own).alias("rank", "a"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))
