"""Daily state: small rollups kept by day, so that a run reads one new day of the large tables.

Counts by table and sums by entity are written for one day at a time; baselines and changes are then computed from the
kept days. A rerun of a day replaces that day only. The answers are those of the operators on the whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from weirgauge.functions.expr import aggregate, all_of, as_date, day, holds, name, pinned
from weirgauge.operators import presence
from weirgauge.operators.change import ChangeCheck, PinnedTable, Side, combined_sides
from weirgauge.operators.volume import DailyTable, daily_counts
from weirgauge.sources.daily import DAY, read_days, write_day


@dataclass(frozen=True)
class DailyState:
    """Folders under ``path``: ``counts``, and ``entities/<table>`` for each table of the change checks."""

    spark: SparkSession
    path: str

    def update_counts(self, tables: Mapping[str, DailyTable], as_of: dt.date | str) -> None:
        """Rows of every table on the day; a table without rows has a zero, so that every day is there."""
        expected = presence.catalogue(self.spark, dict.fromkeys(tables))
        counts = presence.zero_filled(daily_counts(tables, as_of, 0), expected, day(as_of), day(as_of))
        write_day(counts.drop("record_date").coalesce(1), f"{self.path}/counts", as_of)

    def counts(self, as_of: dt.date | str, days: int = 7) -> DataFrame:
        """The same as ``volume.daily_counts``, from the kept days."""
        rows = read_days(self.spark, f"{self.path}/counts", as_date(as_of) - dt.timedelta(days=days), as_of)
        return rows.where("record_count > 0").select("source_table", DAY, "record_count")

    def update_entities(
        self, tables: Mapping[str, PinnedTable], checks: Sequence[ChangeCheck], as_of: dt.date | str, key: str
    ) -> None:
        """Sums by entity of every check on the day: one scan and one exchange per table."""
        for table, source in tables.items():
            own = [i for i, c in enumerate(checks) if table in (c.current.table, c.previous.table)]
            if not own:
                continue
            rows = source.df.where(pinned(source.dates, as_of)).selectExpr(
                f"{name(key)} as entity",
                *[f"{holds(checks[i].where)} as hit_{i}" for i in own],
                *[f"case when {checks[i].where} then {name(checks[i].measure)} end as value_{i}" for i in own],
            )
            sums = [e for i in own for e in (f"max(hit_{i}) as hit_{i}", f"sum(value_{i}) as value_{i}")]
            write_day(aggregate(rows.groupBy("entity"), *sums), f"{self.path}/entities/{table}", as_of)

    def entity_rollup(self, checks: Sequence[ChangeCheck], as_of: dt.date | str) -> DataFrame:
        """The same as ``change.entity_rollup``, from the kept days."""
        sides = list(dict.fromkeys(side for c in checks for side in (c.current, c.previous)))
        return combined_sides(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self._side(s, n, checks, as_of) for n, s in enumerate(sides)]), checks)

    def _side(self, side: Side, number: int, checks: Sequence[ChangeCheck], as_of: dt.date | str) -> DataFrame:
        on = as_date(as_of) - dt.timedelta(days=side.lag)
        rows = read_days(self.spark, f"{self.path}/entities/{side.table}", on, on)
        out = ["entity", f"{number} as side"]
        for i, check in enumerate(checks):
            mine = [p for p, s in (("cur", check.current), ("prev", check.previous)) if s == side]
            out += [f"value_{i} as {p}_{i}" for p in mine] + [f"{all_of([f'hit_{i}'])} as hit_{i}" if mine else f"false as hit_{i}"]
        return rows.selectExpr(*out)
