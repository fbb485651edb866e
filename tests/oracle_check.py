"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names (sorted) and the multiset of rows with
floats rounded to 6 significant digits.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from strata.sources.tables import TABLES  # noqa: E402


STRICT = os.environ.get("STRICT") == "1"


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.6g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.6g}")
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = ok_cols and ok_n and canon(scols, srows) == canon(dcols, drows)
    out = {"name": name, "ok": bool(ok_cols and ok_n and ok_v), "rows": len(srows),
           "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if not ok_cols:
        out["cols"] = (sorted(scols), sorted(dcols))
    elif not ok_v and ok_n:
        a, b = canon(scols, srows), canon(dcols, drows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out["diff"] = diff
    return out


def main():
    from __spark_entry__ import oracle_sql, queries
    from strata.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r["ok"] is False
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names or qs)}")


if __name__ == "__main__":
    main()
