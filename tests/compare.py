"""Compare a registered Spark query with its DuckDB oracle the way the driver
does: row count, column names, and an order-insensitive multiset of values.

    python tests/compare.py [key ...]          # default sf0.01, all keys
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in BASE:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    rel = con.sql(sql)
    cols = [c.lower() for c in rel.columns]
    return cols, rel.fetchall(), [str(t) for t in rel.types]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 6)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return [cols[i] for i in order], out


def compare(spark, key: str, sf_dir: str, verbose: bool = True) -> bool:
    import __spark_entry__ as entry

    t0 = time.time()
    df = entry.queries()[key](spark, sf_dir)
    s_cols = [c.lower() for c in df.columns]
    s_rows = [tuple(r) for r in df.collect()]
    s_types = [f.dataType.simpleString() for f in df.schema.fields]
    t1 = time.time()
    sql = entry.oracle_sql().get(key)
    if sql is None:
        if verbose:
            print(f"{key}: spark rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s")
        return True
    d_cols, d_rows, d_types = duck(sql, sf_dir)
    t2 = time.time()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    ok = sc == dc and sr == dr
    if verbose:
        print(f"{key}: {'OK' if ok else 'MISMATCH'} spark={len(sr)} duck={len(dr)} "
              f"spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s")
        if sc != dc:
            print("  columns spark:", sc, "\n  columns duck: ", dc)
        elif sr != dr:
            ss, ds = set(sr), set(dr)
            print("  only spark:", list(ss - ds)[:3])
            print("  only duck: ", list(ds - ss)[:3])
        ints = {"int", "bigint", "smallint", "tinyint"}
        for c, a, b in zip(s_cols, s_types, [dict(zip(d_cols, d_types)).get(c) for c in s_cols]):
            if b is None:
                continue
            if (a in ints) != (b.lower() in ("integer", "bigint", "smallint", "tinyint", "hugeint")):
                print(f"  type note {c}: spark {a} vs duck {b}")
    return ok


if __name__ == "__main__":
    from lorry.session import local_session
    import __spark_entry__ as entry

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    keys = sys.argv[1:] or list(entry.queries())
    bad = [k for k in keys if not compare(spark, k, sf)]
    print("mismatches:", bad)
