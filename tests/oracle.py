"""Compare every registered query with its SQL twin: ``python -m tests.oracle <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [
        tuple(repr(r[i]) if isinstance(r[i], float) else r[i] for i in order)
        for r in rows
    ]
    return sorted(columns), sorted(out, key=_key)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    df = query(spark, sf_dir)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = canonical(names, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if not want:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        for x, y in zip(g, w):
            if x != y or type(x) is not type(y):
                return f"row {g} != {w}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, con, queries[name], sql[name], sf_dir)
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
