"""Results kept by day: one folder per day, replaced as a whole, so that a rerun of a day changes nothing else.

A day's rows replace what the day had before, even if there are none now. Readers prune to the days they ask for.
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgauge.functions.expr import as_date, inline, text
from weirgauge.operators.contracts import Rule

DAY = "record_date"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share; a local one only if the session runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='weirgauge-')}"
    return f"{shared.rstrip(os.sep)}/{name}-{uuid.uuid4().hex}"


def schema_differences(df: DataFrame, contract: str) -> list[str]:
    """How names, types and order of the columns differ from the contract (a DDL text); nothing if they agree."""
    wanted = T.StructType.fromDDL(contract) if isinstance(contract, str) else contract
    got = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in wanted]
    found = [f"{n} {t} is missing" for n, t in want if (n, t) not in got]
    found += [f"{n} {t} is not expected" for n, t in got if (n, t) not in want]
    return found or (["columns are in another order"] if got != want else [])


def write_day(df: DataFrame, path: str, as_of: dt.date | str, contract: str | None = None) -> None:
    """The day's rows, in place of those that the day had."""
    if contract is not None and (found := schema_differences(df, contract)):
        raise ValueError(f"rows for {path} break its schema: {'; '.join(found)}")
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{DAY}={as_date(as_of)}")


def read_days(spark: SparkSession, path: str, first: dt.date | str | None = None, last: dt.date | str | None = None) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, with ``record_date``; other days' files are not opened."""
    rows = spark.read.parquet(path).withColumn(DAY, F.col(DAY).cast("date"))
    for bound, sign in ((first, ">="), (last, "<=")):
        if bound is not None:
            rows = rows.where(f"{DAY} {sign} date '{as_date(bound)}'")
    return rows


def write_checked(df: DataFrame, path: str, as_of: dt.date | str, rules: Sequence[Rule], contract: str | None = None) -> DataFrame:
    """Writes the day and returns the violations of every rule, counted on the rows as they are written: no second scan."""
    seen = Observation()
    counted = [F.expr(f"count_if({r.violated})").alias(f"violations_{i}") for i, r in enumerate(rules)]
    write_day(df.observe(seen, *counted), path, as_of, contract)
    found = seen.get
    return df.sparkSession.range(1).selectExpr(
        inline(
            [
                {"rule": text(r.rule), "column_name": text(r.column), "violations": f"{found[f'violations_{i}']}L"}
                for i, r in enumerate(rules)
            ]
        )
    )


#: Between two texts of a day's file.
TEXT_END = "\n\n"


def write_text_day(df: DataFrame, column: str, path: str, as_of: dt.date | str) -> None:
    """The day's texts as text files, in place of those that the day had; blank lines within a text are left out.

    The day is entered under ``<path>-complete`` when its files are there, so that readers never see half a day.
    """
    on = as_date(as_of)
    rows = df.select(F.regexp_replace(column, "\n{2,}", "\n").alias("value"))
    rows.write.mode("overwrite").text(f"{path.rstrip('/')}/{DAY}={on}", lineSep=TEXT_END)
    df.sparkSession.range(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}-complete/{DAY}={on}")


def read_text_days(spark: SparkSession, path: str, first: dt.date | str | None = None, last: dt.date | str | None = None) -> DataFrame:
    """record_date and value: the texts of the complete days from ``first`` to ``last``."""
    complete = read_days(spark, f"{path.rstrip('/')}-complete", first, last).select(DAY)
    rows = spark.read.text(path, lineSep=TEXT_END).select(F.col(DAY).cast("date").alias(DAY), "value")
    return rows.join(F.broadcast(complete), DAY, "left_semi")  # a row per day
