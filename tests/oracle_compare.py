"""Compare every registered Spark query with its DuckDB oracle.

Usage: ``python tests/oracle_compare.py [sf_dir] [key ...]``. Checks row count,
column names and the order-insensitive multiset of row values, like the
driver's correctness gate.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    return ("s", v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark, con, key: str, make_df, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = make_df(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    same = Counter(_rows(s_cols, s_rows)) == Counter(_rows(d_cols, d_rows))
    out["values_match"] = same
    out["status"] = "ok" if (same and out["columns_match"]) else "MISMATCH"
    if not out["columns_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    if not same and out["columns_match"]:
        a, b = Counter(_rows(s_cols, s_rows)), Counter(_rows(d_cols, d_rows))
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    return out


def main(argv):
    import __spark_entry__ as E
    from touchcredit.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_session("local[8]", 8, extra={"spark.sql.session.timeZone": "UTC"})
    con = duck_connection(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            res = compare(spark, con, key, qs[key], oracle.get(key), sf_dir)
        except Exception as exc:  # report and continue
            res = {"key": key, "status": "ERROR", "error": repr(exc)[:500]}
        bad += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    print(f"{len(keys or qs) - bad} ok / {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
