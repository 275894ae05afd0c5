"""Run registered queries against their SQL counterparts and print what differs.

Usage: python tests/check_contract.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from knownby.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, repr(v)) for v in row)


def differences(spark_rows: list[tuple], sql_rows: list[tuple]) -> tuple[int, list]:
    """Number of rows that are not exactly equal as multisets, and a few samples."""
    left, right = sorted(spark_rows, key=_key), sorted(sql_rows, key=_key)
    bad = [(a, b) for a, b in zip(left, right) if _key(a) != _key(b)]
    return len(bad) + abs(len(left) - len(right)), bad[:2]


def _clean(row: tuple) -> tuple:
    return tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    started = time.time()
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [_clean(tuple(r)) for r in df.select(*columns).collect()]
    took = time.time() - started
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return {"rows": len(got), "took": took, "bad": 0, "sample": [], "columns": columns}
    started = time.time()
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    rows = cursor.fetchall()
    oracle_took = time.time() - started
    if sorted(names) != columns:
        return {"rows": len(got), "took": took, "bad": -1,
                "sample": [("columns", columns, sorted(names))], "columns": columns}
    order = [names.index(c) for c in columns]
    want = [_clean(tuple(r[i] for i in order)) for r in rows]
    bad, sample = differences(got, want)
    return {"rows": len(got), "took": took, "oracle_took": oracle_took, "bad": bad, "sample": sample,
            "columns": columns, "oracle_rows": len(want)}


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(contract.queries())
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        try:
            out = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the other queries
            failed += 1
            print(f"FAIL {name}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            continue
        ok = out["bad"] == 0
        failed += not ok
        print(f"{'ok  ' if ok else 'DIFF'} {name} rows={out['rows']}/{out.get('oracle_rows')} "
              f"bad={out['bad']} spark={out['took']:.2f}s sql={out.get('oracle_took', 0):.2f}s",
              flush=True)
        if not ok:
            print("    ", out["columns"])
            for sample in out["sample"]:
                for side in sample:
                    print("    ", side)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
