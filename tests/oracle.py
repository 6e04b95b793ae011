"""Compare registered queries with their SQL in DuckDB: ``python -m tests.oracle [folder] [names...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from logweir.queries import ORACLES, QUERIES
from logweir.session import release

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Spark and DuckDB names of the same type.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a result and its SQL, or None."""
    cursor = con.execute(sql)
    wanted_types = {d[0]: str(d[1]) for d in cursor.description}
    wanted_rows = cursor.fetchall()
    types = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if types != wanted_types:
        return f"schema {types} != {wanted_types}"
    names, order = sorted(types), list(wanted_types)
    rows = Counter(tuple(row[name] for name in names) for row in df.collect())
    wanted = Counter(tuple(row[order.index(name)] for name in names) for row in wanted_rows)
    if rows != wanted:
        return f"{rows.total()} rows, {wanted.total()} wanted; only here {list((rows - wanted))[:3]}, only in SQL {list((wanted - rows))[:3]}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or QUERIES:
        start = time.monotonic()
        try:
            df = QUERIES[name](spark, folder)
            problem = difference(df, con, ORACLES[name]) if name in ORACLES else None
            count = "" if name in ORACLES else f"{df.count()} rows, no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            count = ""
        release(spark)
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.monotonic() - start:.2f}s {count}{problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    folder, *names = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(folder, names) > 0)
