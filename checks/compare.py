"""Run registered queries in Spark and their twins in DuckDB and compare.

python -m checks.compare SF_DIR [NAME ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import all_checks
from tidemark.session import session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# DuckDB type -> Spark type a column should have.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "HUGEINT": "-",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(rows, names, order):
    at = [names.index(c) for c in order]
    return sorted([tuple(plain(r[i]) for i in at) for r in rows], key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, name: str) -> tuple[str, float, int]:
    query, sql = all_checks()[name]
    start = time.time()
    df = query(spark, sf)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return "rows only", took, len(got)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS differ: {sorted(set(names) ^ set(df.columns))}", took, len(got)
    if len(got) != len(expected):
        return f"ROWS differ: {len(got)} and {len(expected)}", took, len(got)
    order = sorted(names)
    mine, theirs = rows_of(got, df.columns, order), rows_of(expected, names, order)
    if mine != theirs:
        bad = next((a, b) for a, b in zip(mine, theirs) if a != b)
        cells = [(c, x, y) for c, x, y in zip(order, *bad) if x != y]
        return f"VALUES differ: {cells[:4]}", took, len(got)
    off = [(c, k, dict(df.dtypes)[c]) for c, k in zip(names, kinds) if TYPES.get(k, "?") != dict(df.dtypes)[c]]
    return (f"TYPES differ: {off}" if off else "ok"), took, len(got)


def main() -> int:
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    failures = 0
    for name in all_checks():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            verdict, took, n = compare(spark, con, sf, name)
        except Exception as error:  # report and go on
            verdict, took, n = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0.0, 0
        failures += verdict not in ("ok", "rows only")
        print(f"{name:40s} {took:6.2f}s {n:7d} rows  {verdict}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(main())
