"""Run queries and oracle SQL side by side: ``python -m conformance.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from conformance.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def cell(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows(names: list[str], data: list[tuple]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([cell(row[i]) for i in order]) for row in data)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, else what differs first."""
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = rows(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows, expected {len(want)}; only here {only_got}; only expected {only_want}"


def main() -> None:
    from pyspark.sql import SparkSession

    from conformance.oracle import oracle_sql
    from conformance.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, expected = connect(sf_dir), oracle_sql()
    for name in sys.argv[2:] or QUERIES:
        begun = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            verdict = difference(df, con, expected[name]) if name in expected else f"rows only: {df.count()}"
        except Exception as failure:  # noqa: BLE001
            verdict = f"{type(failure).__name__}: {str(failure)[:700]}"
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {time.time() - begun:.2f}s {verdict or ''}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
