"""Compare registered queries with their SQL: python tests/check.py [name ...] [--sf DIR]."""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value) -> str:
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 9) + 0.0)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    return str(value)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, function, check: str | None, sf_dir: str) -> tuple[str, float, float]:
    start = time.time()
    df = function(spark, sf_dir)
    got = normal(df.columns, df.collect())
    spark_seconds = time.time() - start
    if check is None:
        return f"rows-only {len(got)}", spark_seconds, 0.0
    start = time.time()
    result = con.execute(check)
    columns = [d[0] for d in result.description]
    want = normal(columns, result.fetchall())
    seconds = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} <> {sorted(columns)}", spark_seconds, seconds
    kinds = {c[0]: str(c[1]) for c in result.description}
    types = {c: (t, kinds[c]) for c, t in df.dtypes}
    if got != want:
        extra, missing = [r for r in got[:100000] if r not in set(want)][:2], [r for r in want[:100000] if r not in set(got)][:2]
        return f"DIFFER {len(got)} <> {len(want)}; extra {extra}; missing {missing}", spark_seconds, seconds
    odd = {
        c: pair
        for c, pair in types.items()
        if (pair[0], pair[1]) not in {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("boolean", "BOOLEAN")}
    }
    return f"ok {len(got)}" + (f" TYPES {odd}" if odd else ""), spark_seconds, seconds


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    options = parser.parse_args()
    import __spark_entry__ as e
    from sonoloom.session import build_session

    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(options.sf)
    queries, checks = e.queries(), e.oracle_sql()
    bad = 0
    for name in options.names or queries:
        try:
            verdict, a, b = compare(spark, con, name, queries[name], checks.get(name), options.sf)
        except Exception as error:
            verdict, a, b = f"FAILED {type(error).__name__}: {str(error)[:600]}", 0, 0
        bad += not verdict.startswith(("ok", "rows-only"))
        print(f"{name:28s} {a:6.2f}s {b:6.2f}s {verdict}", flush=True)
    print(f"{bad} bad of {len(options.names or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
