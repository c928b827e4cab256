"""Session settings for running the checks."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution sizes the shuffles at run time; the rest keeps results
#: independent of the machine and query construction cheap.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; a cluster's own submit settings stay in force.

    The number of shuffle partitions is left to the cluster (adaptive execution
    coalesces it downwards); pass ``spark_sql_shuffle_partitions`` for local use.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
