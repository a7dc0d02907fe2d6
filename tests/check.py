"""Compare a query with its SQL counterpart: same columns, same rows in any order.

Run as a script with query names (or none for all): ``python tests/check.py name ...``.
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")


def connect(folder: str = DATA):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return format(v.normalize(), "f") if v else "0"
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_rows, got_names = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(sql)
    want_names = [d[0] for d in res.description]
    want_rows = res.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(set(got_names) ^ set(want_names))}"
    got, want = bag(got_rows, got_names), bag(want_rows, want_names)
    if got != want:
        a, b = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {len(got_rows)} vs {len(want_rows)}\n  cols {sorted(got_names)}\n  spark {a}\n  sql   {b}"
    if not got_rows:
        return "EMPTY result"
    return None


def types_of(df, con, sql: str) -> list[str]:
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN", "date": "DATE"}
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for name, kind in df.dtypes:
        expect = kinds.get(kind, kind.upper())
        if want[name].replace(" ", "") != expect.replace(" ", ""):
            out.append(f"{name}: {kind} vs {want[name]}")
    return out


def main(names: list[str]) -> int:
    from ledgerloom.session import build_session

    import __spark_entry__ as entry

    # CHECK_CONF holds extra settings, such as spark.sql.autoBroadcastJoinThreshold=-1.
    extra = dict(item.split("=", 1) for item in os.environ.get("CHECK_CONF", "").split(",") if item)
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "14g", "spark.driver.maxResultSize": "4g", **extra})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con, bad = connect(), 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, DATA)
            diff = compare(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
            kinds = types_of(df, con, oracles[name]) if name in oracles else []
        except Exception as e:  # noqa: BLE001
            diff, kinds = f"{type(e).__name__}: {str(e)[:1500]}", []
        bad += diff is not None and not diff.startswith("no SQL")
        if diff or kinds or names:
            print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - start:.1f}s {diff or ''} {kinds or ''}", flush=True)
    print(f"{len(names or queries)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
