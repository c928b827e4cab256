"""Helpers shared by the operators: shared storage, row identity, and lookups that survive hot keys."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key that holds more than this share of the rows is looked up by broadcast; so there are at most this many of them.
HOT_KEYS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where one machine runs all, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='weirgauge-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: evaluated once, and safe from lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows as one struct column ``doc``, whatever their columns are called, with a ``row`` number each; stored, so
    that a row keeps its number and rows with null or repeated ids can be told apart."""
    columns = F.struct(*(docs[f"`{c.replace('`', '``')}`"] for c in docs.columns))
    return stored(docs.select(columns.alias("doc"), F.monotonically_increasing_id().alias("row")), name)


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine find the package even if the driver was started elsewhere; a cluster ships it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def lookup(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, spread: list[str]) -> DataFrame:
    """``rows`` left-joined with ``groups`` (one row per key, its number of rows in ``size``), even if keys are hot.

    Groups with at least a thousandth of all rows number at most a thousand, so they are broadcast. Their rows get a
    key of their own, from the columns ``spread``, which meets nothing in the shuffled join and spreads evenly.
    """
    values = [c for c in groups.columns if c not in keys]
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) * HOT_KEYS >= total)
    cold = groups.where(F.col(size) * HOT_KEYS < total)
    hot = hot.select(*(F.col(k).alias(f"_hot_{k}") for k in keys), F.struct(*values).alias("_hot"))
    cold = cold.select(*(F.col(k).alias(f"_cold_{k}") for k in keys), F.lit(0).cast("long").alias("_cold_spread"), F.struct(*values).alias("_cold"))
    met = rows.join(F.broadcast(hot), [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys], "left")
    spread_key = F.when(F.col("_hot").isNull(), F.lit(0).cast("long")).otherwise(F.greatest(F.abs(F.xxhash64(*spread)), F.lit(1)))
    met = met.withColumn("_spread", spread_key)
    joined = met.join(cold, [F.col(k) == F.col(f"_cold_{k}") for k in keys] + [F.col("_spread") == F.col("_cold_spread")], "left")
    return joined.select(*rows.columns, *(F.coalesce(F.col("_hot"), F.col("_cold"))[v].alias(v) for v in values))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text, or one longer text."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < len(sizes):
            yield batch.slice(start)
