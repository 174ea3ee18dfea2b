"""Compare registered queries with their DuckDB statements: names, types, rows and exact values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    """Values as they print: 1.0 differs from 1, NaN equals NaN, -0.0 differs from 0.0."""
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, db, sql: str) -> list[str]:
    """Differences, empty when the results agree."""
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    expected = bag(names, result.fetchall())
    actual = bag(df.columns, [tuple(r) for r in df.collect()])
    if expected == actual:
        return []
    extra, missing = actual - expected, expected - actual
    return [
        f"rows {sum(actual.values())} vs {sum(expected.values())}, {sum(extra.values())} differ",
        f"columns {sorted(names)}",
        *[f"  spark  {r}" for r in sorted(extra)[:3]],
        *[f"  duckdb {r}" for r in sorted(missing)[:3]],
    ]


def main(argv: list[str]) -> int:
    from paneloom.oracles import oracle_sql
    from paneloom.queries import QUERIES
    from paneloom.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    db, statements, failed = connect(sf_dir), oracle_sql(), []
    for name in argv[2:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in statements:
                notes = compare(df, db, statements[name])
            else:
                notes = [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            notes = [f"{type(error).__name__}: {str(error)[:600]}"]
        verdict = "FAIL" if notes else ("ok" if name in statements else "rows")
        print(f"{verdict:5s}{name:28s}{time.time() - start:7.2f}s", *notes, sep="\n      " if notes else "", flush=True)
        failed += [name] if notes else []
    print(f"{len(failed)} failed {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
