"""Duplicate natural keys: how many, how much surplus, which ones.

The grouped frame is the only wide shuffle. Its partial aggregation runs before
the exchange, so a key holding a large share of the rows arrives as one row per
map task. Statistics and top keys both read that same exchange. Wide keys that
are mostly unique can be screened first, so that few of them move.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.functions.expr import aggregate, date_of, day, name, struct, text
from weirgauge.sources.daily import scratch

#: Cells that hold several rows are broadcast up to this many (8 bytes each); beyond, keys are grouped without them.
MOST_CELLS = 1 << 20


@dataclass(frozen=True)
class KeySpec:
    """Natural key of one table and the part of it that is shown to a reader."""

    df: DataFrame
    keys: Sequence[str]
    show: Sequence[str]
    date: str | None = None

    @property
    def field(self) -> str:
        return ", ".join(self.keys)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return aggregate(df.groupBy(*keys), "count(1) as row_count").where("row_count > 1")


def screened_groups(df: DataFrame, keys: Sequence[str], cells: int | None = None, most: int = MOST_CELLS) -> DataFrame:
    """The same groups, for wide keys that are mostly unique: only keys that may repeat are exchanged.

    Rows are first counted by the cell of their key's 64-bit hash (or that modulo ``cells``), so what is exchanged for
    every row is a number and not the key. Rows outside of cells with several rows are unique and stay where they are;
    the others are grouped by their keys, so keys that share a cell are told apart. The cells are counted when this is
    called, which reads the key columns once; where there are more than ``most``, keys repeat too often for a screen
    to pay, and all are grouped. NULLs are key values like others, as in any grouping.
    """
    spark = df.sparkSession
    cell = F.xxhash64(*[df[name(key)] for key in keys])
    cell = cell if cells is None else F.pmod(cell, F.lit(cells))
    path = scratch(spark, "cells")
    duplicate_groups(df.select(cell.alias("cell")), ("cell",)).select("cell").write.parquet(path)
    several = spark.read.schema("cell bigint").parquet(path)
    if several.count() > most:
        return duplicate_groups(df, keys)
    return duplicate_groups(df.join(F.broadcast(several), cell == several["cell"], "left_semi"), keys)


STATS = ("count(1) as duplicate_key_groups", "coalesce(sum(row_count - 1), 0) as extra_duplicate_rows")


def duplicate_stats(groups: DataFrame) -> DataFrame:
    """One row: number of duplicated keys and rows beyond the first of each (0, 0 if none)."""
    return aggregate(groups, *STATS)


def _worst(groups: DataFrame, keys: Sequence[str], item: str, n: int, *constants: str) -> DataFrame:
    """One row: the ``n`` most repeated keys as an ordered array.

    The limit is a bounded heap per task and one merge; the array is built from
    what is left. Ties go to the smaller key, NULLs last, and are ordered the
    same way inside the array.

    What is left is exchanged, so that the grouping ends in a stage of its own:
    beside others in one stage, adaptive execution gives it a share of the
    tasks only, and the groupings that get one task each run in the same one.
    """
    best = groups.orderBy(F.expr("row_count").desc(), *[F.expr(name(k)).asc_nulls_last() for k in keys]).limit(n)
    position = ", ".join(f"{name(k)} is null as null_{i}, {name(k)} as key_{i}" for i, k in enumerate(keys))
    packed = f"sort_array(collect_list(struct(-row_count as by_count, {position}, {item} as item)))"
    return aggregate(best.repartition(1), *constants, f"transform({packed}, entry -> entry.item) as top_duplicate_keys")


def top_duplicates(groups: DataFrame, keys: Sequence[str], show: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` worst keys as rows ``rank, <show>, row_count``.

    Keys are grouped by all of ``keys`` but only ``show`` is displayed, so two
    entries may look the same.
    """
    item = struct({column: name(column) for column in (*show, "row_count")})
    worst = _worst(groups, keys, item, n)
    return worst.selectExpr("posexplode(top_duplicate_keys) as (pos, item)").selectExpr("pos + 1 as rank", "item.*")


def duplicate_report(
    specs: Mapping[str, KeySpec], as_of: dt.date | str | None = None, n: int = 5
) -> DataFrame:
    """One row per table: statistics and the ordered array of worst keys.

    Tables show different columns, so an array element has the union of them;
    a column a table does not show is NULL there and vanishes from the JSON.
    """
    shown = list(dict.fromkeys(column for spec in specs.values() for column in spec.show))
    parts: list[DataFrame] = []
    for table, spec in specs.items():
        rows = spec.df
        if as_of is not None and spec.date is not None:
            rows = rows.where(f"{date_of(spec.date)} = {day(as_of)}")
        groups = duplicate_groups(rows, spec.keys)
        element = struct(
            {c: name(c) if c in spec.show else "null" for c in shown}
            | {"row_count": "row_count", "field": text(spec.field)}
        )
        label = f"{text(table)} as source_table"
        parts += [aggregate(groups, label, *STATS), _worst(groups, spec.keys, element, n, label)]
    # Each part is one row; regrouping by table name brings the two halves together.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return aggregate(
        stacked.groupBy("source_table"),
        "max(duplicate_key_groups) as duplicate_key_groups",
        "max(extra_duplicate_rows) as extra_duplicate_rows",
        "first(top_duplicate_keys, true) as top_duplicate_keys",
    )
