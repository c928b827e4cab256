"""Output contracts: expectations that hold when they return no rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from weirgauge.functions.expr import aggregate, inline, name, text


@dataclass(frozen=True)
class Rule:
    """A named violation predicate on a column."""

    rule: str
    column: str
    violated: str


def not_null(column: str) -> Rule:
    return Rule("not_null", column, f"{name(column)} is null")


def accepted_values(column: str, allowed: Sequence[str]) -> Rule:
    """NULL is left to the not-null rule."""
    return Rule("accepted_values", column, f"{name(column)} not in ({', '.join(text(v) for v in allowed)})")


def retired_value(column: str, pattern: str) -> Rule:
    """The lower-cased value contains a retired pattern."""
    return Rule("retired_value", column, f"contains(lower({name(column)}), {text(pattern.lower())})")


def _offenders(df: DataFrame, rule: Rule) -> DataFrame:
    return aggregate(df.where(rule.violated).groupBy(rule.column), "count(1) as n_rows")


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is NULL."""
    return df.where(not_null(column).violated)


def expect_in(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the closed set, with their row count."""
    return _offenders(df, accepted_values(column, allowed))


def expect_absent(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Values whose lower-cased text contains a retired pattern, with their row count."""
    return _offenders(df, retired_value(column, pattern))


def contract_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of every rule from one scan: ``rule, column_name, violations``."""
    counted = aggregate(df, *[f"count_if({r.violated}) as violations_{i}" for i, r in enumerate(rules)])
    return counted.selectExpr(
        inline(
            [
                {"rule": text(r.rule), "column_name": text(r.column), "violations": f"violations_{i}"}
                for i, r in enumerate(rules)
            ]
        )
    )
