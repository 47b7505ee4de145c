"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row counts, column names and order-insensitive values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from playmart.sources.driver import DRIVER_TABLES  # noqa: E402


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def normalize(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: repr(r))
    return [cols[i] for i in order], out


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, name, query, sql, sf_dir, tol=0.0):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    stypes = dict(sdf.dtypes)
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    drows = res.fetchall()
    sc, sr = normalize(scols, srows)
    dc, dr = normalize(dcols, drows)
    problems = []
    for c in scols:
        if c in dtypes and SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]:
            problems.append(f"type of {c}: spark={stypes[c]} duck={dtypes[c]}")
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} duck={len(dr)}")
    elif sr != dr:
        bad = 0
        for a, b in zip(sr, dr):
            if a != b:
                if tol and all(
                    (x == y) or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= tol * max(1, abs(y)))
                    for x, y in zip(a, b)
                ):
                    continue
                bad += 1
                if bad <= 3:
                    problems.append(f"row differs: spark={a} duck={b}")
        if bad:
            problems.append(f"{bad} differing rows")
    return problems, len(sr), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from playmart.session import build_session

    import __spark_entry__ as entry

    spark = build_session()
    con = duck_connect(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    ok = True
    for name in names or sorted(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:45s} rows-only  rows={n}")
            continue
        try:
            problems, n, secs = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            problems, n, secs = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1, 0
        status = "OK " if not problems else "BAD"
        ok &= not problems
        print(f"{name:45s} {status} rows={n} spark={secs:.2f}s")
        for p in problems:
            print("    ", p)
    spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
