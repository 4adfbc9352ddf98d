"""Run registered queries next to their SQL twins. ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, list):
        return repr([_norm(x) for x in v])
    return repr(v)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(row[i]) for i in order) for row in rows)


def compare(spark, con, fn, sql: str, sf_dir: str) -> list[str]:
    """Differences between the Spark query and its SQL; empty when equal."""
    got = fn(spark, sf_dir)
    got_rows = [tuple(row) for row in got.collect()]
    rel = con.sql(sql)
    want_rows = rel.fetchall()
    problems = []
    if sorted(got.columns) != sorted(rel.columns):
        return [f"columns {sorted(got.columns)} != {sorted(rel.columns)}"]
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    for c, t in got.dtypes:
        if TYPES.get(t, t) != want_types[c]:
            problems.append(f"type of {c}: {t} vs {want_types[c]}")
    a, b = _table(got.columns, got_rows), _table(rel.columns, want_rows)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        cols = sorted(got.columns)
        first = [(c, x, y) for c, x, y in zip(cols, *diff[0]) if x != y]
        problems.append(f"{len(diff)} of {len(a)} rows differ, e.g. {first} in {diff[0][0][:6]}")
    if not a:
        problems.append("no rows")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from ebbline.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and name not in wanted and not any(w.endswith("*") and name.startswith(w[:-1]) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, fn, oracles[name], sf_dir)
                note = "ok"
            else:
                problems, note = [], f"rows only: {len(fn(spark, sf_dir).collect())}"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        took = time.time() - start
        bad += bool(problems)
        print(f"{name:22s} {took:6.2f}s {'; '.join(problems) or note}", flush=True)
    print("failed:", bad)
    spark.stop()
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
