"""Row-count anomalies against a trailing average of daily counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.functions.expr import (
    aggregate,
    date_of,
    day,
    exceeds_ratio,
    holds,
    likely_cause,
    number,
    percent,
    ratio,
    status,
    text,
)
from weirgauge.operators.presence import outages, zero_filled

GAP = "abs(current_record_count - expected_record_count)"


@dataclass(frozen=True)
class DailyTable:
    """A table and the date column its rows are counted by."""

    df: DataFrame
    date: str


def daily_counts(
    tables: Mapping[str, DailyTable], as_of: dt.date | str, days: int = 7, first: dt.date | str | None = None
) -> DataFrame:
    """Rows per (table, day) from ``days`` before ``first`` (default ``as_of``) to ``as_of``.

    The tables are stacked before they are grouped: one exchange for all of
    them, carrying one row per table, day and map task. Days without rows are
    absent, not zero.
    """
    start = day(first if first is not None else as_of, days)
    stacked = reduce(
        DataFrame.unionByName,
        [
            t.df.where(f"{date_of(t.date)} between {start} and {day(as_of)}").selectExpr(
                f"{text(table)} as source_table", f"{date_of(t.date)} as record_date"
            )
            for table, t in tables.items()
        ],
    )
    return aggregate(stacked.groupBy("source_table", "record_date"), "count(1) as record_count")


def trailing_baseline(counts: DataFrame, as_of: dt.date | str, days: int = 7, *carried: str) -> DataFrame:
    """Per table: rows on the day, and the mean over the days present before it.

    The total and the number of days are kept beside the mean so that the
    threshold can be tested without rounding. Columns to be ``carried`` along
    hold one value per table.
    """
    before = f"record_date between {day(as_of, days)} and {day(as_of, 1)}"
    return aggregate(
        counts.groupBy("source_table"),
        f"max(record_count) filter (where record_date = {day(as_of)}) as current_record_count",
        f"sum(record_count) filter (where {before}) as baseline_rows",
        f"count(1) filter (where {before}) as baseline_days",
        f"avg(record_count) filter (where {before}) as expected_record_count",
        *[f"max({c}) as {c}" for c in carried],
    )


def _breach(threshold: Decimal | str, rounded: bool = False) -> str:
    if rounded:
        return holds(f"{percent(GAP, 'expected_record_count')} > {number(Decimal(threshold) * 100)}")
    # |count - rows/days| / (rows/days) > t, multiplied out by the number of days.
    return exceeds_ratio("current_record_count * baseline_days", "baseline_rows", threshold)


def volume_scorecard(
    tables: Mapping[str, DailyTable],
    as_of: dt.date | str,
    days: int = 7,
    threshold: Decimal | str = "0.20",
    duplicates: DataFrame | None = None,
    rounded: bool = False,
    expected: DataFrame | None = None,
    zero_days: bool = False,
) -> DataFrame:
    """One row per table that has rows today and at least one earlier day in range.

    ``duplicates`` is the frame of ``duplicate_report``; with it every row
    carries the duplicate diagnostics and a likely cause. ``rounded`` tests the
    deviation after rounding to two digits. ``expected`` is a ``catalogue``:
    with it, expected tables without rows today are reported as well; with
    ``zero_days`` too, their days without rows count as zero in the average.
    """
    counts = daily_counts(tables, as_of, days)
    if expected is not None and zero_days:
        counts = zero_filled(counts, expected, day(as_of, days), day(as_of))
    base = trailing_baseline(counts, as_of, days)
    card = base.where("current_record_count is not null and baseline_days > 0").selectExpr(
        "source_table",
        f"{day(as_of)} as record_date",
        "current_record_count",
        "expected_record_count",
        f"{percent(GAP, 'expected_record_count')} as deviation_pct",
        f"{status(_breach(threshold, rounded))} as status",
    )
    if expected is not None and not zero_days:
        card = card.unionByName(outages(counts, expected, as_of, days).select(*card.columns))
    if duplicates is None:
        return card
    # Both sides are one row per table: stacked and regrouped by name, so that no join is planned for them.
    diagnostics = ("duplicate_key_groups", "extra_duplicate_rows", "top_duplicate_keys")
    stacked = card.unionByName(duplicates.select("source_table", *diagnostics), allowMissingColumns=True)
    columns = [c for c in (*card.columns, *diagnostics) if c != "source_table"]
    met = aggregate(stacked.groupBy("source_table"), *[f"first({c}, true) as {c}" for c in columns])
    return met.where("status is not null").selectExpr(
        *card.columns,
        "coalesce(duplicate_key_groups, 0) as duplicate_key_groups",
        "coalesce(extra_duplicate_rows, 0) as extra_duplicate_rows",
        "coalesce(top_duplicate_keys, array()) as top_duplicate_keys",
        f"{likely_cause('duplicate_key_groups', days)} as likely_cause",
    )


def volume_scorecard_single(
    table: DailyTable,
    label: str,
    as_of: dt.date | str,
    days: int = 7,
    threshold: Decimal | str = "0.20",
) -> DataFrame:
    """The same test for one table, reporting the signed row difference and a plain ratio."""
    return single_scorecard(daily_counts({label: table}, as_of, days), label, as_of, days, threshold)


def single_scorecard(
    counts: DataFrame, label: str, as_of: dt.date | str, days: int = 7, threshold: Decimal | str = "0.20"
) -> DataFrame:
    """``volume_scorecard_single`` from the ``daily_counts`` of any tables, the one with that label among them.

    The table is picked from the baselines by an aggregate of its name. A test of the name itself would move down to the
    scans, whose exchange could then no longer be the one that the check of all tables reads.
    """
    base = trailing_baseline(counts.withColumn("counted_table", F.col("source_table")), as_of, days, "counted_table")
    return base.where(f"counted_table = {text(label)} and current_record_count is not null").selectExpr(
        "source_table",
        f"{day(as_of)} as record_date",
        "current_record_count",
        "current_record_count - expected_record_count as diff_record",
        "round(expected_record_count, 2) as expected_record_count",
        f"round({ratio(GAP, 'expected_record_count')}, 2) as deviation_ratio",
        f"{status(_breach(threshold))} as status",
    )


def volume_backfill(
    tables: Mapping[str, DailyTable],
    first: dt.date | str,
    last: dt.date | str,
    days: int = 7,
    threshold: Decimal | str = "0.20",
    expected: DataFrame | None = None,
) -> DataFrame:
    """The volume check for every day of a range in one pass.

    The trailing mean is a window over calendar distance, on frames that hold
    one row per table and day. A day without any earlier day in range keeps a
    NULL expectation and never alerts. With a catalogue of ``expected`` tables,
    days without rows are there with a count of zero.
    """
    frame = (
        "(partition by source_table order by unix_date(record_date) "
        f"range between {days} preceding and 1 preceding)"
    )
    counts = daily_counts(tables, last, days, first)
    if expected is not None:
        counts = zero_filled(counts, expected, day(first, days), day(last))
    return (
        counts.selectExpr(
            "source_table",
            "record_date",
            "record_count as current_record_count",
            f"sum(record_count) over {frame} as baseline_rows",
            f"count(record_count) over {frame} as baseline_days",
            f"avg(record_count) over {frame} as expected_record_count",
        )
        .where(f"record_date >= {day(first)}")
        .selectExpr(
            "source_table",
            "record_date",
            "current_record_count",
            "expected_record_count",
            f"{percent(GAP, 'expected_record_count')} as deviation_pct",
            f"{status(_breach(threshold))} as status",
        )
    )
