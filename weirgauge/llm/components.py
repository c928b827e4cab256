"""Connected components of links between numbered nodes, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.llm.common import stored


def _moved(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """The rows with ``column`` led to its parent where it has one. A hot node is split by adaptive execution."""
    at = parents.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    others = [c for c in rows.columns if c != column]
    return rows.join(at, F.col(column) == F.col("_node"), "left").select(*others, F.coalesce("_to", column).alias(column))


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node that its links reach) for every node of the links (a, b).

    Each round orders the nodes, by number and by a seeded hash in turns: the first gathers stars, the second breaks up
    long chains. Every node looks at the first of its neighbours. Where that is a root (it comes before all its own
    neighbours), or looks at a root, the node is merged into the root, and the links are drawn anew between what is left,
    without loops and repeats. The first node of a component is a root, so each round merges some; rounds grow as a
    logarithm. A node with very many links is combined within tasks. Links and merges are written to the shared folder in
    every round; labels are led through the merges once, at the end.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = labels.select("node", F.col("node").alias("component"))
    turn = 0
    while not links.isEmpty():
        turn += 1
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = lambda c, turn=turn: F.struct((F.xxhash64(F.lit(turn), F.col(c)) if turn % 2 == 0 else F.lit(0).cast("long")).alias("place"), F.col(c).alias("node"))
        first = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        pointers = stored(first.select(F.col("a").alias("node"), F.least(place("a"), F.col("first"))["node"].alias("to")), "pointers")
        near = pointers.where("node <> to").join(pointers.where("node = to").select(F.col("node").alias("root")), F.col("to") == F.col("root"), "left")
        at_root = near.where("root is not null").select("node", "to")
        next_to_it = near.where("root is null").select("node", "to").join(at_root.select(F.col("node").alias("_at"), F.col("to").alias("_to")), F.col("to") == F.col("_at"))
        parents = stored(at_root.union(next_to_it.select("node", F.col("_to").alias("to"))), "parents")
        labels = _moved(labels, "component", parents)
        drawn = _moved(_moved(links, "a", parents), "b", parents).where("a <> b")
        links = stored(drawn.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = stored(labels, "labels")
    smallest = labels.groupBy("component").agg(F.min("node").alias("to")).select(F.col("component").alias("node"), "to")
    return _moved(labels, "component", smallest).select("node", "component")
