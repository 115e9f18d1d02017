"""Differential check of the registered queries against their DuckDB SQL.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and types, and the sorted multiset of rows
(columns in name order).  Also importable by the test suite.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(v)
    return str(v)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
                 "BOOLEAN": "boolean", "FLOAT": "float"}


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), sorted(columns)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    s_recs = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_recs), "spark_s": round(t1 - t0, 2)}
    res = con.sql(sql)
    d_cols = res.columns
    d_types = {c: DUCK_TO_SPARK.get(str(t).split("(")[0], str(t)) for c, t in zip(res.columns, res.types)}
    d_recs = res.fetchall()
    t2 = time.time()
    s_rows, s_names = rows_of(s_cols, s_recs)
    d_rows, d_names = rows_of(d_cols, d_recs)
    ok = s_names == d_names and s_types == d_types and s_rows == d_rows
    out = {"name": name, "ok": ok, "rows": len(s_recs), "oracle_rows": len(d_recs),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if not ok:
        out["names"] = (s_names, d_names)
        out["types"] = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
        out["only_spark"], out["only_oracle"] = diff_s, diff_d
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    from basketmine import build_session
    import __spark_entry__ as e
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, fn, sql.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
