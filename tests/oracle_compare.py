"""Run registered queries in Spark and their SQL in DuckDB, and compare like the driver does:
column names, row count and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return [cols[i] for i in order], len(rows), hashlib.sha256("\n".join(keyed).encode()).hexdigest(), keyed


def compare(spark, name, fn, sql, sf_dir, con=None, verbose=True):
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a = digest(scols, srows)
    b = digest(dcols, drows)
    ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
    if verbose and not ok:
        print(f"[{name}] MISMATCH cols {a[0]} vs {b[0]} rows {a[1]} vs {b[1]}")
        sa, sb = set(a[3]), set(b[3])
        for x in sorted(sa - sb)[:4]:
            print("   spark only:", x[:300])
        for x in sorted(sb - sa)[:4]:
            print("   duck  only:", x[:300])
    return ok, a[1]


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from mise.session import get_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = []
    for n in (names or list(qs)):
        if n not in sqls:
            rows = qs[n](spark, sf).count()
            print(f"[{n}] rows-only {rows}")
            continue
        try:
            ok, rows = compare(spark, n, qs[n], sqls[n], sf, con)
        except Exception as e:  # report and continue
            ok, rows = False, -1
            print(f"[{n}] ERROR {type(e).__name__}: {str(e)[:400]}")
        print(f"[{n}] {'ok' if ok else 'FAIL'} rows={rows}")
        if not ok:
            bad.append(n)
    print("FAILED:", bad)
