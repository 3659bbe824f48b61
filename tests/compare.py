"""Run queries against their DuckDB statements: python tests/compare.py [folder] [name-prefix ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns: list[str], rows: list) -> list[tuple]:
    """Rows as strings in column-name order, doubles by exact value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def check(spark, con, folder: str, query, sql: str) -> str:
    """'' when row counts, columns, types and values agree; else the first difference."""
    df = query(spark, folder)
    got = df.collect()
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(set(df.columns) ^ set(rel.columns))}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        if kinds.get(kind, kind) != duck_types[name]:
            return f"type of {name}: {kind} and {duck_types[name]}"
    a, b = _rows(df.columns, got), _rows(rel.columns, rel.fetchall())
    if len(a) != len(b):
        return f"rows {len(a)} and {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, p, q) for c, p, q in zip(sorted(df.columns), x, y) if p != q]
            return f"values {diff[:4]}"
    return ""


def session(compiled: bool = True):
    """Local session; interpreted plans start faster on tables of a few thousand rows."""
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("venue-tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.wholeStage", str(compiled).lower())
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, con = session(), duck(folder)
    statements = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in statements:
                problem = check(spark, con, folder, query, statements[name])
            else:
                problem = "" if len(query(spark, folder).collect()) else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += bool(problem)
        print(f"{name:45s} {time.time() - start:6.1f}s {'ok' if not problem else problem}{'' if name in statements else ' (rows only)'}", flush=True)
    print("bad:", bad)
