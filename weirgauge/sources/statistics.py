"""Counts and extremes from file statistics: footers are read, rows are not."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from weirgauge.functions.expr import aggregate, as_date, name

#: The file source that takes aggregates, in a session of its own.
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def statistics(
    spark: SparkSession,
    path: str,
    date: str,
    first: dt.date | str,
    last: dt.date | str,
    extremes: Sequence[str] = (),
) -> DataFrame:
    """Per day of a Parquet table partitioned by ``date``: record_count, and min and max of numeric columns.

    Only partition columns are filtered and grouped by, so the aggregates are answered from the footers of the days'
    files; days without files are absent.
    """
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    days = f"{name(date)} between date '{as_date(first)}' and date '{as_date(last)}'"
    bounds = [f"{f}({name(c)}) as {f}_{c}" for c in extremes for f in ("min", "max")]
    return aggregate(session.read.parquet(path).where(days).groupBy(date), "count(1) as record_count", *bounds)
