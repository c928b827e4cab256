"""Compare a Spark result with DuckDB: row count, column names, order-insensitive values."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set threads to 4")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql):
    """Empty string if equal, else a short account of the first difference."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    wanted = _rows(names, expected.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows vs {len(wanted)}"
    for a, b in zip(got, wanted, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} vs {b}"
    return ""
