"""Spark-versus-DuckDB comparison used by the tests and by ``python -m tests.compare``.

Rows are compared order-insensitively after sorting the columns by name;
floats are compared at 9 significant digits, timestamps as text.
"""

from __future__ import annotations

import datetime as _dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["match"] = None
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["match"] = False
        res["why"] = f"columns {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["match"] = a == b
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        res["why"] = f"first spark-only rows: {diff}; duck-only: {[x for x in b if x not in set(a)][:3]}"
    return res


def main(argv: list[str]) -> int:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from rollcall.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session()
    con = duck(sf_dir)
    ok = True
    for name, fn in queries().items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, fn, oracle_sql().get(name), sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            r = {"match": False, "why": f"{type(exc).__name__}: {str(exc)[:400]}"}
        ok &= r.get("match") is not False
        print(name, r, flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
