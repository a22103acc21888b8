"""Run the registered queries beside their SQL.

    python tests/compare.py [sf_dir] [name ... | key=value ...]

Arguments with `=` are Spark settings.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain_value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, bool) or v is None:
        return repr(v)
    return f"{type(v).__name__}:{v}"


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain_value(r[i]) for i in order) for r in rows)


def difference(spark, con, sf: str, fn, sql: str | None):
    """None when both sides agree, else what differs; and the number of rows."""
    df = fn(spark, sf)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = sorted_rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}\n  only ours {[r for r in got if r not in want][:3]}\n  only SQL {[r for r in want if r not in got][:3]}", len(got)
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return (f"{len(wrong)} rows differ, first\n  {wrong[0][0]}\n  {wrong[0][1]}" if wrong else None), len(got)


def main() -> None:
    from lakeops.session import build_session
    from suite import ORACLES, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    settings |= {"spark.driver.memory": "12g"} | dict(a.split("=", 1) for a in sys.argv[2:] if "=" in a)
    names = [a for a in sys.argv[2:] if "=" not in a] or list(QUERIES)
    spark = build_session("local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff, n = difference(spark, con, sf, QUERIES[name], ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            diff, n = f"{type(e).__name__}: {str(e)[:600]}", 0
        bad += diff is not None
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {n} rows {time.time() - start:.1f}s{kind}", flush=True)
        if diff:
            print("     " + diff, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
