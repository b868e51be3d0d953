"""Runs registered queries and their SQL side by side and compares names, counts and values.

usage: python tools/check_sql.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from segmentry.plans import registry
from segmentry.plans.inputs import TABLES
from segmentry.session import build_session


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    queries, sql = registry.all_queries(), registry.all_sql()
    bad = []
    for name in wanted or queries:
        started = time.perf_counter()
        try:
            df = queries[name](spark, sf)
            got = df.collect()
            took = time.perf_counter() - started
            if name not in sql:
                print(f"rows  {name:28} {len(got):8} rows {took:6.2f}s", flush=True)
                continue
            started = time.perf_counter()
            rel = con.execute(sql[name])
            names, kinds = [d[0] for d in rel.description], {d[0]: str(d[1]) for d in rel.description}
            expected = rel.fetchall()
            sql_took = time.perf_counter() - started
            a, b = rows_of(df.columns, got), rows_of(names, expected)
            problem = ""
            if sorted(df.columns) != sorted(names):
                problem = f"columns {sorted(df.columns)} != {sorted(names)}"
            elif a != b:
                only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
                problem = f"{len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"
            spark_kinds = {n: k for n, k in df.dtypes}
            shape = {n: (spark_kinds[n], kinds[n]) for n in names if n in spark_kinds}
            odd = [f"{n}:{s}/{d}" for n, (s, d) in shape.items() if (s, d) not in SAME]
            print(f"{'FAIL ' if problem else 'ok   '} {name:28} {len(got):8} rows {took:6.2f}s sql {sql_took:5.2f}s {' '.join(odd)}", flush=True)
            if problem:
                print("      " + problem[:1500], flush=True)
                bad.append(name)
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


SAME = {
    ("int", "INTEGER"), ("bigint", "BIGINT"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("boolean", "BOOLEAN"),
    ("timestamp_ntz", "TIMESTAMP"), ("float", "FLOAT"), ("date", "DATE"),
}

if __name__ == "__main__":
    sys.exit(main())
