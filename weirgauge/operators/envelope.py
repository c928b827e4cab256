"""The common alert record: nine columns whatever the check, detail as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from weirgauge.functions.expr import ALERT, NO_DATA, struct

KEYS = ("alert_type", "issue_type", "source_table", "alert_date")
METRICS = ("metric_1", "metric_2", "metric_3", "metric_4")
RECORD = (*KEYS, *METRICS, "detail")
#: Names and types of the alert record, for publishing.
RECORD_SCHEMA = ", ".join(
    [*(f"{c} string" for c in KEYS[:-1]), f"{KEYS[-1]} date", *(f"{c} double" for c in METRICS), "detail string"]
)


def detail(members: Mapping[str, str], null_members: bool = False) -> str:
    """JSON object of the given members (SQL text); NULL members are left out, or kept as null."""
    options = ", map('ignoreNullFields', 'false')" if null_members else ""
    return f"to_json({struct(members)}{options})"


def with_variant(record: DataFrame) -> DataFrame:
    """The record with its detail as a variant, whose members can be reached without a schema."""
    return record.selectExpr(*[c for c in record.columns if c != "detail"], "parse_json(detail) as detail")


def envelope(card: DataFrame, keys: Sequence[str], metrics: Sequence[str], payload: str) -> DataFrame:
    """Project a scorecard (with ``status``) to the alert record plus status.

    ``keys`` are the four key columns and ``metrics`` up to four figures, as SQL
    text; missing figures are NULL. All figures are doubles.
    """
    figures = [*metrics, *["null"] * (len(METRICS) - len(metrics))]
    return card.selectExpr(
        *[f"{value} as {column}" for column, value in zip(KEYS, keys, strict=True)],
        *[f"cast({value} as double) as {column}" for column, value in zip(METRICS, figures, strict=True)],
        "status",
        f"{payload} as detail",
    )


def scorecard(*arms: DataFrame) -> DataFrame:
    """All checks, breached or not."""
    return reduce(DataFrame.unionByName, arms)


def alerts(card: DataFrame, no_data: bool = False) -> DataFrame:
    """The breached rows in the nine-column record; with ``no_data`` also those that had nothing to compare with."""
    wanted = f"status in ('{ALERT}', '{NO_DATA}')" if no_data else f"status = '{ALERT}'"
    return card.where(wanted).select(*RECORD)


def ordered_report(alert_rows: DataFrame) -> DataFrame:
    """Five columns of the alerts in reading order."""
    return alert_rows.select(*KEYS, "detail").orderBy("alert_type", "issue_type")
