"""Compare every query with its SQL: ``python tests/check_catalog.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback
from collections import Counter
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def value(v):
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, datetime):
        return v.isoformat()
    return v


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(value(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        return (f"{sum(got.values())} rows != {sum(want.values())}; "
                f"only here {list((got - want).items())[:2]}; only there {list((want - got).items())[:2]}")
    return None if got else "no rows"


def main() -> int:
    from tests.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in args[1:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = "".join(traceback.format_exception_only(error))[:700]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} bad of {len(args[1:] or entry.queries())}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
