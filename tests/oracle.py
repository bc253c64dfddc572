"""Run a registered query in Spark and its SQL in DuckDB and compare the rows as values."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, (bytearray, bytes, memoryview)):
        return bytes(value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql):
    """None when equal, else a short description."""
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted_rows(names, cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first: {bad[0]}"
    types = [type_pair(g, w) for g, w in zip(got[1][0], want[1][0])] if got[1] else []
    wrong = [t for t in types if t]
    return f"types differ: {wrong}" if wrong else None


def type_pair(g, w):
    return None if g is None or w is None or type(g) is type(w) else (type(g).__name__, type(w).__name__)


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            verdict = differences(df, con, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - reported, not hidden
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(verdict)
        print(f"{'ok  ' if not verdict else 'DIFF'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print("not ok:", failed)
