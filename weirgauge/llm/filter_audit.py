"""Interaction audit of filters: what each filter removes in every order of applying them.

A document's failures are a bit mask. Masks of all documents are counted by part with Spark; an order of filters is a
permutation. In min-plus algebra the step at which an order removes a mask is the product of two matrices: masks by
filters (0 where the mask fails the filter, else infinity) and the filters' positions in every order (the inverse
permutations), combined by addition and minimum. That step says where a mask's documents are scattered to, weighted by
their number; what fails a filter and is not scattered to its step was removed earlier.

The counted masks number at most 2 ** filters for each part, whatever the number of documents. Texts are equal when
their SHA-256 is. A null text is empty, a null part is the empty string and one with it. A null doc_id is neither
smaller nor larger than others and has no label; rows that repeat an id are documents each, none smaller than the other.
Labels that repeat an id count as one, which is 1 if any is. An empty table has no parts and no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgauge.llm.common import importable, lookup, stored

LETTERS = "ABCDE"
#: Thresholds of the filters A to D.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 50, 65, 5, "#$%&*|"
#: Beyond every step: the infinity of the min-plus product.
NEVER = 1 << 20
#: Parts whose rows are made at once.
PARTS = 256


def word_array(text: Column) -> Column:
    """Maximal runs of characters other than space and 0x09-0x0D."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D on a text that is not null: true where it fails."""
    words = word_array(text)
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * CAPITAL_PERCENT,
        "D": F.length(F.translate(text, SYMBOLS, "")) < F.length(text),
    }


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of every document; bit i of the mask is the failure of the i-th letter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    own = sum((fails.cast("int") * (1 << LETTERS.index(letter)) for letter, fails in text_failures(F.col("text")).items()), F.lit(0))
    rows = stored(rows.select("doc_id", "part", own.alias("mask"), F.unhex(F.sha2("text", 256)).alias("form")), "audit-documents")
    same = rows.groupBy("form").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    same = stored(same.where("copies > 1"), "audit-copies")
    found = lookup(rows, same, ["form"], "copies", ["doc_id", "part"])
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << LETTERS.index("E"))
    return found.select("doc_id", "part", (F.col("mask") + copy).alias("mask"))


def counted(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, masks: array of (mask, n, good, toxic): documents, those of quality 1 and the toxic ones, by their mask."""
    marked = labels.select(F.col("doc_id").cast("long").alias("_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marked = marked.where("_id is not null and (good or toxic)").groupBy("_id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    # rows that repeat an id, or have none, are met before they move
    rows = failed.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n")).join(marked, F.col("doc_id") == F.col("_id"), "left")
    sums = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c) for c in ("good", "toxic")))
    return sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))


def removal_steps(orders: np.ndarray) -> np.ndarray:
    """Step (from 0) at which each order (a row) removes each mask (a column); NEVER or more for the mask 0."""
    filters = orders.shape[1]
    position = np.argsort(orders, axis=1)
    bits = np.arange(1 << filters)[:, None] >> np.arange(filters) & 1
    unfailed = np.where(bits == 1, 0, NEVER)
    return (position[:, None, :] + unfailed[None, :, :]).min(axis=2)


def tables(counts: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """Figures (parts, orders, steps) from ``counts`` (parts, 2 ** filters, 3): documents, good and toxic ones by mask."""
    n, filters = orders.shape
    steps = removal_steps(orders)
    scatter = (steps[:, None, :] == np.arange(filters)[None, :, None]).astype(np.int64).reshape(n * filters, -1)  # (order, step) by mask
    removed, good, toxic = (counts[:, :, i] @ scatter.T for i in range(3))
    removed, good, toxic = (x.reshape(-1, n, filters) for x in (removed, good, toxic))
    bits = (np.arange(1 << filters)[:, None] >> np.arange(filters) & 1).astype(np.int64)
    fails = counts[:, :, 0] @ bits  # by part and filter
    shapley = np.zeros_like(fails)
    for f in range(filters):
        shapley[:, f] = removed[:, orders == f].sum(axis=1)
    alone = counts[:, 1 << np.arange(filters), 0]
    return {
        "kept": counts[:, :, 0].sum(axis=1)[:, None, None] - np.cumsum(removed, axis=2),
        "removed": removed,
        "redundant": fails[:, orders] - removed,
        "unique_fails": alone[:, orders],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": shapley[:, orders],
    }


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(sums: DataFrame, letters: str = LETTERS, orders: Sequence[str] | None = None) -> DataFrame:
    """part, filter_order, step and the figures, from ``counted`` masks; all orders of the letters unless some are given."""
    importable(sums.sparkSession)
    named = ["".join(o) for o in permutations(letters)] if orders is None else list(orders)
    numbers = np.array([[letters.index(x) for x in o] for o in named])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = numbers.size
        order, step = np.repeat(named, len(letters)), np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(named))
        for batch in batches:
            for at in range(0, len(batch), PARTS):
                some = batch.slice(at, PARTS)
                masks = some.column("masks")
                of, entries = masks.value_parent_indices().to_numpy(), masks.flatten()
                counts = np.zeros((len(some), 1 << len(letters), 3), np.int64)
                at_mask = entries.field("mask").to_numpy()
                for i, name in enumerate(("n", "good", "toxic")):
                    np.add.at(counts, (of, at_mask, i), entries.field(name).to_numpy())
                made = tables(counts, numbers)
                part = some.column("part").take(pa.array(np.repeat(np.arange(len(some)), each)))
                columns = [part, pa.array(np.tile(order, len(some)), pa.string()), pa.array(np.tile(step, len(some)))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(made[f].ravel()) for f in FIGURES], ["part", "filter_order", "step", *FIGURES])

    return sums.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES))
