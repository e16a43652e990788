"""Compare queries with their oracle SQL: python tests/check_oracles.py [sf] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    order = sorted(names)
    place = [names.index(n) for n in order]
    expected = Counter(tuple(r[i] for i in place) for r in expected_rows)
    actual = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in order]).collect())
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}\n  columns  {order}\n"
        f"  missing  {list(missing)[:2]}\n  extra    {list(extra)[:2]}"
    )


if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", "/tmp/clinlake-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            found = difference(df, con, oracle_sql()[name]) if name in oracle_sql() else None if df.count() else "no rows"
        except Exception as e:
            found = "".join(traceback.format_exception_only(e))[:600]
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} of {len(wanted)} differ")
