"""Change between two sides (table and day), and the entities that drove it.

All checks handed to one call share their scans: every table is read once for
all the days and measures asked of it, and the rows are grouped by entity once.
That rollup feeds the totals and the top drivers, and holds fixed-width
aggregates only, so it hashes without sorting. Entity names are looked up
afterwards for the few winners instead of travelling through the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.functions.expr import (
    aggregate,
    all_of,
    any_of,
    carrier,
    day,
    exceeds_amount,
    exceeds_ratio,
    holds,
    inline,
    is_floating,
    name,
    number,
    ordered_array,
    percent,
    pinned,
    status,
    text,
)


@dataclass(frozen=True)
class Side:
    """Rows of ``table`` on the day ``lag`` days before the as-of day."""

    table: str
    lag: int = 0


@dataclass(frozen=True)
class ChangeCheck:
    """Compare ``sum(measure)`` of two sides.

    The threshold is a share of the previous total, or an amount if
    ``absolute`` is set. ``where`` is SQL text applied to both sides.
    """

    name: str
    current: Side
    previous: Side
    measure: str
    threshold: Decimal | str
    where: str = "true"
    absolute: bool = False

    def breach(self, rounded: bool = False, current: str = "current_value", previous: str = "previous_value") -> str:
        """Threshold test on the two totals; ``rounded`` tests the shown figure."""
        gap = f"abs({current} - {previous})"
        if self.absolute and rounded:
            return holds(f"round({gap}, 2) > {number(self.threshold)}")
        if self.absolute:
            return exceeds_amount(current, previous, self.threshold)
        if rounded:
            return holds(f"{percent(gap, previous)} > {number(Decimal(self.threshold) * 100)}")
        return exceeds_ratio(current, previous, self.threshold)


@dataclass(frozen=True)
class PinnedTable:
    """A table and the date columns that all have to equal a side's day.

    A snapshot table has two of them (snapshot day and business day); leaving
    one open would add up several business days.
    """

    df: DataFrame
    dates: Sequence[str]


def _sides(checks: Sequence[ChangeCheck]) -> list[Side]:
    return list(dict.fromkeys(side for c in checks for side in (c.current, c.previous)))


def _side_rows(
    tables: Mapping[str, PinnedTable],
    checks: Sequence[ChangeCheck],
    as_of: dt.date | str,
    columns: Mapping[str, str],
    values: bool,
) -> DataFrame:
    """Rows of all sides, each tagged with the number of its side; one scan per table.

    ``hit_i`` says whether the row belongs to check i. With ``values`` the
    measures are split into ``cur_i`` and ``prev_i``.
    """
    sides = _sides(checks)
    frames = []
    for table in dict.fromkeys(side.table for side in sides):
        dates = tables[table].dates
        mine = {no: pinned(dates, as_of, side.lag) for no, side in enumerate(sides) if side.table == table}
        wanted = any_of(
            [
                all_of([on_day, any_of([c.where for c in checks if sides[no] in (c.current, c.previous)])])
                for no, on_day in mine.items()
            ]
        )
        tag = "case " + " ".join(f"when {on_day} then {no}" for no, on_day in mine.items()) + " end"
        out = [f"{name(source)} as {target}" for target, source in columns.items()]
        out.append(f"{tag} as side")
        for i, check in enumerate(checks):
            on = {
                prefix: all_of([mine[sides.index(side)], check.where])
                for prefix, side in (("cur", check.current), ("prev", check.previous))
                if side.table == table
            }
            out.append(f"{holds(any_of(list(on.values())) or 'false')} as hit_{i}")
            if values:
                out += [f"case when {row} then {name(check.measure)} end as {p}_{i}" for p, row in on.items()]
        frames.append(tables[table].df.where(wanted).selectExpr(*out))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def entity_rollup(
    tables: Mapping[str, PinnedTable], checks: Sequence[ChangeCheck], as_of: dt.date | str, key: str
) -> DataFrame:
    """Per entity and check: sums on both sides, wide. The one large shuffle of a change check.

    NULL entities group per side: they are never matched with each other.
    """
    return combined_sides(_side_rows(tables, checks, as_of, {"entity": key}, values=True), checks)


def combined_sides(rows: DataFrame, checks: Sequence[ChangeCheck]) -> DataFrame:
    """Rows (entity, side, cur_i, prev_i, hit_i) to one row per entity."""
    return aggregate(
        rows.selectExpr("*", "case when entity is null then side end as null_side").groupBy("entity", "null_side"),
        *[
            expression
            for i in range(len(checks))
            for expression in (
                f"sum(cur_{i}) as cur_{i}",
                f"sum(prev_{i}) as prev_{i}",
                f"max(hit_{i}) as hit_{i}",
            )
        ],
    )


def _carrier(frame: DataFrame, checks: Sequence[ChangeCheck]) -> str:
    return carrier(frame, [f"{side}_{i}" for i in range(len(checks)) for side in ("cur", "prev")])


def _exact_gaps(rollup: DataFrame, checks: Sequence[ChangeCheck]) -> dict[int, str]:
    """Sizes of the deltas in the measures' own types, by check, where the shown type would lose digits of them."""
    if _carrier(rollup, checks) != "double":
        return {}
    kinds = {i: [rollup.schema[f"{side}_{i}"].dataType for side in ("cur", "prev")] for i in range(len(checks))}
    return {i: f"abs(coalesce(cur_{i}, 0) - coalesce(prev_{i}, 0))" for i, own in kinds.items() if not any(map(is_floating, own))}


def _by_entity(rollup: DataFrame, checks: Sequence[ChangeCheck], figures: Mapping[str, str]) -> DataFrame:
    """One row per check and entity present on either side, with figures computed in the measure's own type."""
    exact = _carrier(rollup, checks)
    rows = [
        {
            "check_name": text(check.name),
            "check_no": str(i),
            "hit": f"hit_{i}",
            **{column: f"cast({figure.format(i=i)} as {exact})" for column, figure in figures.items()},
        }
        for i, check in enumerate(checks)
    ]
    gaps = [c for c in rollup.columns if c.startswith("gap_")]
    return rollup.selectExpr("entity", "null_side", *gaps, inline(rows)).where("hit").drop("hit")


DELTA = {"delta": "coalesce(cur_{i}, 0) - coalesce(prev_{i}, 0)"}


def entity_deltas(rollup: DataFrame, checks: Sequence[ChangeCheck]) -> DataFrame:
    """Both values and the signed delta of every entity of every check; a missing side counts as 0."""
    figures = {"current_value": "cur_{i}", "previous_value": "prev_{i}", **DELTA}
    return _by_entity(rollup, checks, figures)


def _per_check(one_row: DataFrame, checks: Sequence[ChangeCheck], figures: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per check from one wide row; ``figures``: more columns, with a text for each check."""
    exact = _carrier(one_row, checks)
    rows = [
        {
            "check_name": text(check.name),
            "current_value": f"cast(cur_{i} as {exact})",
            "previous_value": f"cast(prev_{i} as {exact})",
            **{column: texts[i] for column, texts in (figures or {}).items()},
        }
        for i, check in enumerate(checks)
    ]
    return one_row.selectExpr(inline(rows))


def _wide_totals(rollup: DataFrame, checks: Sequence[ChangeCheck]) -> DataFrame:
    """Sum of the entity sums in the measures' own types; NULL where a side has no value at all.

    The presence flag is part of the sum so that this branch needs the same
    columns of the rollup as the drivers do and both read one exchange.
    """
    sums = [f"sum({side}_{i}) filter (where hit_{i}) as {side}_{i}" for i in range(len(checks)) for side in ("cur", "prev")]
    return aggregate(rollup, *sums)


def totals(rollup: DataFrame, checks: Sequence[ChangeCheck]) -> DataFrame:
    """check_name, current_value, previous_value from an entity rollup."""
    return _per_check(_wide_totals(rollup, checks), checks)


def side_totals(
    tables: Mapping[str, PinnedTable], checks: Sequence[ChangeCheck], as_of: dt.date | str
) -> DataFrame:
    """Totals of both sides per check without the entity rollup: one scan per table, one row per task."""
    rows = _side_rows(tables, checks, as_of, {}, values=True)
    sums = [f"sum({side}_{i}) as {side}_{i}" for i in range(len(checks)) for side in ("cur", "prev")]
    return _per_check(aggregate(rows, *sums), checks)


def _winners(rollup: DataFrame, checks: Sequence[ChangeCheck], n: int) -> DataFrame:
    """Rank 1..n by size of the delta per check; ties go to the smaller entity.

    The rank limit is applied in every task before rows are exchanged by check,
    so at most n rows per check and task move. Sorting looks at the size as a
    double first, which is cheap to compare and never contradicts the exact
    decimal that follows it.
    """
    gaps = _exact_gaps(rollup, checks)
    ties = [f"case when check_no = {i} then gap_{i} end desc nulls last" for i in gaps] or ["abs(delta) desc"]
    order = f"size desc, {', '.join(ties)}, entity asc nulls last, null_side"
    return (
        _by_entity(rollup.selectExpr("*", *[f"{gap} as gap_{i}" for i, gap in gaps.items()]), checks, DELTA)
        .selectExpr("*", "abs(cast(delta as double)) as size")
        .selectExpr("*", f"row_number() over (partition by check_no order by {order}) as rank")
        .where(f"rank <= {int(n)}")
        .select("entity", "null_side", "check_name", "check_no", "delta", "rank")
    )


def _named(
    winners: DataFrame,
    tables: Mapping[str, PinnedTable],
    checks: Sequence[ChangeCheck],
    as_of: dt.date | str,
    key: str,
    label: str,
) -> DataFrame:
    """Attach the largest name of the current side, else of the previous one.

    The winning entities (at most n per check) are the broadcast side of a
    second, narrow scan, each with the list of its wins so that a row matches
    once. Matches are reduced to distinct names before the exchange, so a winner
    owning many rows stays cheap. Every winner has a row on some side, hence an
    inner join keeps them all.
    """
    sides = _sides(checks)
    entities = aggregate(
        winners.groupBy("entity", "null_side"), "collect_list(struct(check_name, check_no, rank, delta)) as wins"
    )
    hits = [f"hit_{i}" for i in range(len(checks))]
    rows = _side_rows(tables, checks, as_of, {"row_key": key, "label": label}, values=False)
    same = "row_key <=> entity and case when row_key is null then side end <=> null_side"
    distinct_names = (
        rows.join(F.broadcast(entities), F.expr(same), "inner")
        .select("entity", "wins", "side", *hits, "label")
        .distinct()
    )
    current = "array(" + ", ".join(str(sides.index(c.current)) for c in checks) + ")"
    per_win = (
        distinct_names.selectExpr("entity", "side", "label", f"array({', '.join(hits)}) as hits", "inline(wins)")
        .where("hits[check_no]")
        .selectExpr("check_name", "rank", "entity", "delta", "label", f"side = {current}[check_no] as is_current")
    )
    return aggregate(
        per_win.groupBy("check_name", "rank", "entity", "delta"),
        "coalesce(max(label) filter (where is_current), max(label) filter (where not is_current)) as name",
    )


def top_drivers(
    tables: Mapping[str, PinnedTable],
    checks: Sequence[ChangeCheck],
    as_of: dt.date | str,
    key: str,
    label: str | None = None,
    n: int = 5,
) -> DataFrame:
    """The n entities with the largest signed change per check, as rows; ``label`` is the name column."""
    return _drivers(entity_rollup(tables, checks, as_of, key), tables, checks, as_of, key, label, n)


def _drivers(rollup, tables, checks, as_of, key, label, n) -> DataFrame:
    winners = _winners(rollup, checks, n)
    if label is None:
        return winners.selectExpr("check_name", "rank", "entity", "cast(null as string) as name", "delta")
    named = _named(winners, tables, checks, as_of, key, label)
    return named.select("check_name", "rank", "entity", "name", "delta")


def label_drivers(drivers: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Fill ``name`` from a dimension table of any size: the largest name of each entity, however many rows it has.

    The drivers are the small side of one join, which tells for every row of the
    dimension the ranks it names; names are combined per rank within tasks before
    they move. A driver without a row in the dimension keeps a NULL name.
    """
    kept = [c for c in drivers.columns if c != "name"]
    dimension = labels.selectExpr(f"{name(key)} as label_key", f"{name(label)} as label_name").where("label_key is not null")
    named = dimension.join(drivers.drop("name"), F.expr("label_key = entity"), "right")
    return aggregate(named.groupBy(*kept), "max(label_name) as name").select(*drivers.columns)


def change_scorecard(
    tables: Mapping[str, PinnedTable],
    checks: Sequence[ChangeCheck],
    as_of: dt.date | str,
    key: str,
    label: str | None = None,
    n: int = 5,
    rounded: bool = False,
    no_data: bool = False,
) -> DataFrame:
    """One row per check: both totals, difference, percent, status, and the ordered drivers.

    Every check is computed in its measure's own type, so what others measure has no influence on it; only the shown
    figures share a type. ``rounded`` tests the figure as shown (two digits) instead of the exact one. With ``no_data`` a
    check with a missing total has the status NO_DATA instead of OK.
    """
    rollup = entity_rollup(tables, checks, as_of, key)
    drivers = aggregate(
        _drivers(rollup, tables, checks, as_of, key, label, n).groupBy("check_name"),
        f"{ordered_array('rank', 'struct(entity, name, delta)')} as top_drivers",
    )
    wide = _wide_totals(rollup, checks)
    exact = _carrier(wide, checks)
    numbers = range(len(checks))
    gaps = [f"abs(cur_{i} - prev_{i})" for i in numbers]
    missing = [f"(cur_{i} is null or prev_{i} is null)" if no_data else "false" for i in numbers]
    figures = {
        "alert_date": [day(as_of, c.current.lag) for c in checks],
        "abs_difference": [f"cast(round({gap}, 2) as {exact})" for gap in gaps],
        "change_pct": [percent(gap, f"prev_{i}") for i, gap in enumerate(gaps)],
        "status": [status(c.breach(rounded, f"cur_{i}", f"prev_{i}"), missing[i]) for i, c in enumerate(checks)],
    }
    return _per_check(wide, checks, figures).join(drivers, "check_name", "left").selectExpr(
        "check_name",
        "current_value",
        "previous_value",
        *figures,
        "coalesce(top_drivers, array()) as top_drivers",
    )
