"""SQL expression text shared by the checks.

Checks state their expressions as Spark SQL text, as predicates in a
specification are. Everything is composed of built-in functions, so it stays
inside whole-stage code generation, and a text is parsed in one call where a
chain of column objects would cost a driver round trip per operator.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALERT = "ALERT"
OK = "OK"
#: Nothing to compare with; only where a check is asked to tell it from OK.
NO_DATA = "NO_DATA"


def as_date(value: dt.date | str) -> dt.date:
    """Accept a date or an ISO string as the day a check runs for."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def text(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """Quoted identifier."""
    return "`" + column.replace("`", "``") + "`"


def number(value: Decimal | str | int) -> str:
    """Exact numeric literal, never in exponent form."""
    return format(Decimal(value), "f")


def day(as_of: dt.date | str, lag: int = 0) -> str:
    """Date literal ``lag`` days before ``as_of`` (a literal, so scans can prune on it)."""
    return f"date '{as_date(as_of) - dt.timedelta(days=lag)}'"


def date_of(column: str) -> str:
    """The column as a date; the cast is pushed to the scan as a range on timestamps."""
    return f"cast({name(column)} as date)"


def pinned(columns: Sequence[str], as_of: dt.date | str, lag: int = 0) -> str:
    """True where every one of the date columns equals the day ``as_of - lag``."""
    return all_of([f"{date_of(column)} = {day(as_of, lag)}" for column in columns])


def all_of(conditions: Sequence[str]) -> str:
    return " and ".join(f"({c})" for c in conditions)


def any_of(conditions: Sequence[str]) -> str:
    return " or ".join(f"({c})" for c in conditions)


def holds(predicate: str) -> str:
    """Predicate as a two-valued flag: NULL counts as not satisfied."""
    return f"coalesce(({predicate}), false)"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` as double, NULL where the denominator is 0."""
    return f"(cast({part} as double) / nullif(cast({whole} as double), 0d))"


def is_floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def carrier(frame: DataFrame, columns: Sequence[str]) -> str:
    """One type that shows sums of several measures: exact for decimals and integers if it holds all their digits before
    and after the point; else double. Only for showing: what is tested and ranked keeps the measure's own type."""
    kinds = [frame.schema[c].dataType for c in columns if c in frame.columns]
    exact = [(k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (20, 0) for k in kinds if not is_floating(k)]
    scale = max((s for _, s in exact), default=0)
    if len(exact) < len(kinds) or max((n for n, _ in exact), default=0) + scale > 38:
        return "double"
    return f"decimal(38,{scale})"


def percent(part: str, whole: str, digits: int = 2) -> str:
    """``part / whole`` in percent, rounded once."""
    return f"round({ratio(part, whole)} * 100, {digits})"


def exceeds_ratio(current: str, base: str, threshold: Decimal | str) -> str:
    """Strict test ``|current - base| / base > threshold``.

    Written as a product so that a change of exactly the threshold never fires
    through a floating-point remainder. As with the signed quotient, a base
    that is zero, negative or missing never fires.
    """
    return holds(f"({base}) > 0 and abs(({current}) - ({base})) > {number(threshold)} * ({base})")


def exceeds_amount(current: str, base: str, threshold: Decimal | str) -> str:
    """Strict test ``|current - base| > threshold``; missing values never fire."""
    return holds(f"abs(({current}) - ({base})) > {number(threshold)}")


def status(breached: str, missing: str = "false") -> str:
    """ALERT or OK; NO_DATA comes first where ``missing`` holds."""
    no_data = "" if missing == "false" else f"when {missing} then '{NO_DATA}' "
    return f"case {no_data}when {breached} then '{ALERT}' else '{OK}' end"


def deviation_cause(days: int = 7) -> str:
    return text(f"row count deviation vs {days}-day average")


def likely_cause(duplicate_groups: str, days: int = 7) -> str:
    """Why a row count moved: duplicated natural keys, or the count alone."""
    return (
        f"case when coalesce({duplicate_groups}, 0) > 0 then 'duplicate rows on natural key' "
        f"else {deviation_cause(days)} end"
    )


def ordered_array(position: str, payload: str) -> str:
    """Aggregate: payloads as an array sorted by their (unique) position.

    Only ever used on frames already cut to a top-k, so the array is bounded.
    """
    packed = f"sort_array(collect_list(struct({position} as pos, {payload} as item)))"
    return f"transform({packed}, entry -> entry.item)"


def plain(value: str, digits: int = 2) -> str:
    """Fixed-point form for JSON, so large numbers are not printed in exponent form; NULL beyond 38 digits."""
    return f"try_cast(round({value}, {digits}) as decimal(38,{digits}))"


def struct(members: Mapping[str, str]) -> str:
    return "struct(" + ", ".join(f"{value} as {name(member)}" for member, value in members.items()) + ")"


def inline(rows: Sequence[Mapping[str, str]]) -> str:
    """One output row per mapping, all with the same members."""
    return "inline(array(" + ", ".join(struct(row) for row in rows) + "))"


def aggregate(grouped: GroupedData | DataFrame, *expressions: str) -> DataFrame:
    """``agg`` with SQL text such as ``sum(x) as total``."""
    return grouped.agg(*[F.expr(e) for e in expressions])
