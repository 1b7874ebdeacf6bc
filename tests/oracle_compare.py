"""Run catalog queries on Spark and their DuckDB oracle SQL, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from noema.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = bool(int(__import__("os").environ.get("ORACLE_STRICT", "0")))


def norm_value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm_value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm_value(x)) for k, x in v.items()))
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm_value(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols, s_canon = canon(sdf.columns, s_rows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_cols, d_canon = canon(d_cols, d_rows)
    ok = s_cols == d_cols and s_canon == d_canon
    info = dict(name=name, ok=ok, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2))
    if not ok:
        info["cols"] = (s_cols, d_cols)
        sset, dset = set(s_canon), set(d_canon)
        info["only_spark"] = sorted(sset - dset, key=repr)[:5]
        info["only_oracle"] = sorted(dset - sset, key=repr)[:5]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry
    from noema.session import local_session
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            info = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # report and continue
            info = dict(name=name, ok=False, error=repr(e)[:2000])
        if info.get("ok") is False:
            bad += 1
        print(info, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
