"""Population coverage: which eligible entities have no measure today.

The building blocks (``eligible``, ``refine``, ``measure``) can be composed by
hand. ``entity_facts`` evaluates several sub-checks at once: population rows
and measure rows are stacked and grouped by entity a single time, so there is
one exchange, no join, and a hot entity collapses before it is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame

from weirgauge.functions.expr import (
    aggregate,
    any_of,
    date_of,
    day,
    holds,
    inline,
    name,
    number,
    ordered_array,
    percent,
    status,
    struct,
    text,
)

CHECK = ("check_name", "source_table", "check_date")


@dataclass(frozen=True)
class CoverageCheck:
    """One sub-check: a source of the measure table and who is expected in it."""

    name: str
    source: str
    extra: str = "true"
    lag: int = 0


@dataclass(frozen=True)
class CoverageSpec:
    """Column roles and predicates (SQL text) of a coverage check.

    ``rows`` selects the population rows that count at all, ``member`` is the
    further test at least one of them has to pass. ``extra`` of a sub-check is
    tested on its own: the row that satisfies it need not be the row that
    satisfies ``member``.
    """

    checks: Sequence[CoverageCheck]
    key: str
    rows: str
    member: str
    population_date: str
    source: str
    value: str
    measure_date: str


def eligible(df: DataFrame, key: str, where: str, date: str, as_of: dt.date | str) -> DataFrame:
    """Distinct entities with a row on the day that passes the predicate."""
    return df.where(f"{date_of(date)} = {day(as_of)} and ({where})").select(key).distinct()


def refine(population: DataFrame, rows: DataFrame, key: str, where: str = "true") -> DataFrame:
    """Entities of the population that also have a row passing ``where``.

    The right side is made distinct first, so a key that owns many rows is
    reduced before the shuffle instead of landing on one join task. A NULL
    entity never matches.
    """
    return population.join(rows.where(where).select(key).distinct(), key, "left_semi")


def refine_each(rows: DataFrame, key: str, rules: Mapping[str, str]) -> DataFrame:
    """``rule, <key>``: for each rule, the entities with a row that passes it; all rules from one grouping of the rows.

    A row of flags per entity leaves each task, whatever the number of rules or of an entity's rows. An entity may meet
    several rules; a NULL entity meets none.
    """
    entity, numbered = name(key), list(enumerate(rules.items()))
    flags = aggregate(
        rows.where(f"{entity} is not null").groupBy(key),
        *[f"max({holds(predicate)}) as met_{i}" for i, (_, predicate) in numbered],
    )
    met = inline([{"rule": text(rule), "met": f"met_{i}"} for i, (rule, _) in numbered])
    return flags.selectExpr(entity, met).where("met").select("rule", key)


def measure(
    df: DataFrame, key: str, value: str, where: str, date: str, as_of: dt.date | str, lag: int = 0
) -> DataFrame:
    """Sum of the measure per entity on one day, NULL counted as 0."""
    rows = df.where(f"{date_of(date)} = {day(as_of, lag)} and ({where})")
    return aggregate(rows.groupBy(key), f"sum(coalesce({name(value)}, 0)) as usage_value")


def entity_facts(
    population: DataFrame, usage: DataFrame, spec: CoverageSpec, as_of: dt.date | str
) -> DataFrame:
    """One row per (sub-check, eligible entity): measure (0 if missing) and number of matching rows."""
    key, numbered = name(spec.key), list(enumerate(spec.checks))
    today = population.where(
        f"{date_of(spec.population_date)} = {day(as_of)} and ({spec.rows}) and {key} is not null"
    ).selectExpr(
        f"{key} as entity",
        f"{holds(spec.member)} as is_member",
        *[f"cast({holds(c.extra)} as bigint) as rows_{i}" for i, c in numbered],
    )
    wanted = [
        f"{name(spec.source)} = {text(c.source)} and {date_of(spec.measure_date)} = {day(as_of, c.lag)}"
        for c in spec.checks
    ]
    measured = usage.where(f"({any_of(wanted)}) and {key} is not null").selectExpr(
        f"{key} as entity",
        *[f"case when {w} then coalesce({name(spec.value)}, 0) end as value_{i}" for i, w in enumerate(wanted)],
    )
    per_entity = aggregate(
        today.unionByName(measured, allowMissingColumns=True).groupBy("entity"),
        "max(is_member) as is_member",
        *[f"sum(rows_{i}) as rows_{i}" for i, _ in numbered],
        *[f"sum(value_{i}) as value_{i}" for i, _ in numbered],
    ).where("is_member")
    per_check = inline(
        [
            {
                "check_name": text(c.name),
                "source_table": text(c.source),
                "check_date": day(as_of, c.lag),
                "usage_value": f"coalesce(value_{i}, 0)",
                "matching_rows": f"rows_{i}",
            }
            for i, c in numbered
        ]
    )
    return (
        per_entity.selectExpr("entity", per_check)
        .where("matching_rows > 0")
        .selectExpr(*CHECK, f"entity as {key}", "usage_value", "matching_rows")
    )


def coverage(facts: DataFrame) -> DataFrame:
    """Eligible entities, entities with a positive measure, and their share, per sub-check.

    Facts hold each entity once per sub-check, so plain counts are distinct counts.
    """
    counted = aggregate(
        facts.groupBy(*CHECK), "count(1) as eligible", "count_if(usage_value > 0) as with_usage"
    )
    return counted.selectExpr("*", f"{percent('with_usage', 'eligible')} as coverage_pct")


def _ranked(rows: DataFrame, order: str, n: int) -> DataFrame:
    position = f"row_number() over (partition by {', '.join(CHECK)} order by {order})"
    return rows.selectExpr("*", f"{position} as rank").where(f"rank <= {int(n)}")


def _first_missing(facts: DataFrame, key: str, n: int, dedupe: bool) -> DataFrame:
    first = _ranked(facts.where("usage_value = 0"), name(key), n)
    if dedupe:
        return first
    # An entity appears once per matching row; more than n repeats cannot be seen.
    # The n first entities hold at least the n first rows, so only they are repeated.
    copies = f"explode(sequence(1, cast(least(matching_rows, {int(n)}) as int))) as copy"
    return _ranked(first.drop("rank").selectExpr("*", copies), f"{name(key)}, copy", n)


def missing_sample(facts: DataFrame, key: str, n: int = 10, dedupe: bool = True) -> DataFrame:
    """First ``n`` entities without measure per sub-check, as an array ordered by entity.

    The rank filter is applied inside every task before the exchange, so a
    sub-check with most of the rows sends ``n`` rows per task. ``dedupe=False``
    lists an entity once for every row that made it eligible.
    """
    first = _first_missing(facts, key, n, dedupe)
    sample = ordered_array("rank", struct({key: name(key)}))
    return aggregate(first.groupBy(*CHECK), f"{sample} as sample_missing")


def missing_sample_rows(facts: DataFrame, key: str, n: int = 10, dedupe: bool = True) -> DataFrame:
    """The same sample as rows ``check, rank, entity``."""
    return _first_missing(facts, key, n, dedupe).select(*CHECK, "rank", key)


def coverage_scorecard(
    facts: DataFrame, key: str, min_ratio: Decimal | str = "0.5", n: int = 10, dedupe: bool = True
) -> DataFrame:
    """Coverage per sub-check with status and sample; fires strictly below ``min_ratio``.

    A sub-check without eligible entities has no row.
    """
    counted = coverage(facts)
    too_few = f"with_usage < eligible * {number(min_ratio)}"
    # Both sides are already distributed by the same three columns: no further exchange.
    return counted.join(missing_sample(facts, key, n, dedupe), list(CHECK), "left").selectExpr(
        *counted.columns,
        f"{status(too_few)} as status",
        "coalesce(sample_missing, array()) as sample_missing",
    )
