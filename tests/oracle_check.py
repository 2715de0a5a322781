"""Compare registered queries with their SQL: `python tests/oracle_check.py [sf] [key ...]`."""

import datetime
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def tables_at(sf: str) -> str:
    return f"/root/testdata/sf{sf}"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as sortable text tuples, columns by name."""
    df = df[sorted(df.columns)]
    columns = []
    for name in df.columns:
        values = df[name]
        if pd.api.types.is_extension_array_dtype(values) and values.dtype.kind == "i":
            values = values.astype("float64" if values.hasnans else "int64")
        if pd.api.types.is_datetime64_any_dtype(values):
            values = values.astype("datetime64[us]").astype(str)
        if values.map(lambda v: type(v) is datetime.date).any():
            values = values.map(str)
        columns.append(["NULL" if v is None or v is pd.NaT or v != v else repr(v) for v in values.tolist()])
    return sorted(zip(*columns))


def compare(spark, con, key, query, sql, sf_dir):
    """None if equal, else what differs."""
    ours = query(spark, sf_dir).toPandas()
    theirs = con.execute(sql).fetchdf()
    for name in theirs:  # as Spark hands them over: whole numbers with NULLs as floats
        if theirs[name].dtype.kind == "i" and theirs[name].hasnans:
            theirs[name] = theirs[name].astype("float64")
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    kinds = {
        c: (str(ours[c].dtype), str(theirs[c].dtype))
        for c in ours.columns
        if ours[c].dtype.kind != theirs[c].dtype.kind
        and not pd.api.types.is_datetime64_any_dtype(theirs[c])
        or (ours[c].dtype.kind in "iuf" and ours[c].dtype != theirs[c].dtype)
    }
    a, b = normal(ours), normal(theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}, types {kinds}"
    return f"types {kinds}" if kinds else None


def main(sf="0.01", *keys):
    from pyspark.sql import SparkSession

    from tillroll.oracle import ORACLE
    from tillroll.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillroll-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(tables_at(sf))
    failed = 0
    for key in keys or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, key, QUERIES[key], ORACLE[key], tables_at(sf))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{key:22s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main(*sys.argv[1:])
