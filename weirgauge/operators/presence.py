"""Expected tables and days: what should be there, as the driving side, beside what is.

The checks that count rows see only what has rows. A catalogue of expected tables, crossed with nothing but its own days
(each table's calendar is made from its row), lets a table without rows and a day without rows be reported.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from weirgauge.functions.expr import ALERT, NO_DATA, aggregate, day, inline, text

NO_ROWS = "no rows on the day"


def catalogue(spark: SparkSession, tables: Mapping[str, dt.date | str | None]) -> DataFrame:
    """source_table and since: the expected tables, with the day from which rows are expected (None: always)."""
    rows = [
        {"source_table": text(table), "since": "cast(null as date)" if since is None else day(since)}
        for table, since in tables.items()
    ]
    return spark.range(1).selectExpr(inline(rows))


def spine(expected: DataFrame, first: str, last: str) -> DataFrame:
    """One row per expected table and day from ``first`` to ``last`` (SQL dates), not before the table's own first day."""
    start = f"greatest(coalesce(since, {first}), {first})"
    return expected.where(f"{start} <= {last}").selectExpr(
        "source_table", f"explode(sequence({start}, {last}, interval 1 day)) as record_date"
    )


def zero_filled(counts: DataFrame, expected: DataFrame, first: str, last: str) -> DataFrame:
    """Daily counts of the expected tables with zero for the days that have no rows."""
    joined = spine(expected, first, last).join(counts, ["source_table", "record_date"], "left")
    return joined.selectExpr("source_table", "record_date", "coalesce(record_count, 0) as record_count")


def outages(counts: DataFrame, expected: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """A row for every expected table without rows on the day, from ``volume.daily_counts``.

    ``last_record_date`` is the last earlier day in range that has rows. A table that has some is an ALERT; one without
    any is NO_DATA: there is nothing to compare with.
    """
    before = f"record_date between {day(as_of, days)} and {day(as_of, 1)}"
    seen = aggregate(
        counts.groupBy("source_table"),
        f"coalesce(sum(record_count) filter (where record_date = {day(as_of)}), 0) as current_record_count",
        f"avg(record_count) filter (where {before}) as expected_record_count",
        f"max(record_date) filter (where {before} and record_count > 0) as last_record_date",
    )
    due = expected.where(f"since is null or since <= {day(as_of)}").select("source_table")
    return (
        due.join(seen, "source_table", "left")
        .where("coalesce(current_record_count, 0) = 0")
        .selectExpr(
            "source_table",
            f"{day(as_of)} as record_date",
            "cast(0 as bigint) as current_record_count",
            "expected_record_count",
            "case when expected_record_count > 0 then 100d end as deviation_pct",
            f"case when last_record_date is null then '{NO_DATA}' else '{ALERT}' end as status",
            "last_record_date",
            f"{text(NO_ROWS)} as likely_cause",
        )
    )
