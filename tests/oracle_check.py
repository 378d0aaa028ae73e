"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive multiset of rows.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from gtfsforge.plans.views import BASE_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    ts = time.time() - t0
    scols = sdf.columns
    if sql is None:
        return dict(name=name, rows=len(srows), ok=None, spark_s=round(ts, 2))
    t0 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    td = time.time() - t0
    res = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(ts, 2), duck_s=round(td, 2))
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns {scols} vs {dcols}")
        return res
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in drows)
    res["ok"] = sc == dc
    if not res["ok"]:
        res["only_spark"] = list((sc - dc).items())[:3]
        res["only_oracle"] = list((dc - sc).items())[:3]
    return res


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and os.path.isdir(args[0]):
        sf_dir, args = args[0], args[1:]
    import __spark_entry__ as e
    from gtfsforge.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, orc = e.queries(), e.oracle_sql()
    names = args or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], orc.get(n), sf_dir)
        except Exception as ex:  # report and continue
            r = dict(name=n, ok=False, why=repr(ex)[:600])
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad, "of", len(names))


if __name__ == "__main__":
    main()
