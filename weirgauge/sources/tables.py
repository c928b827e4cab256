"""Reading input tables and publishing results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """A parquet table ``<location>/<name>.parquet``, or the catalog table ``name``."""
    if location is None:
        return spark.table(name)
    return spark.read.parquet(f"{location.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, names: Iterable[str], location: str | None = None) -> dict[str, DataFrame]:
    return {name: read_table(spark, name, location) for name in names}


def publish(df: DataFrame, name: str, as_table: bool = False) -> DataFrame:
    """Expose a result under a stable name and return it read through that name.

    A view is evaluated by every reader. A table is evaluated once, which is the
    better choice when a report and contracts both read the alerts.
    """
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_published(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_messages(messages: DataFrame, path: str, as_text: bool = False) -> None:
    """Write rendered messages as parquet, or as text with one message per file row."""
    if as_text:
        messages.select("message").write.mode("overwrite").text(path, lineSep="\n\n")
    else:
        messages.write.mode("overwrite").parquet(path)
