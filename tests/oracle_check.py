"""Run registered queries against their DuckDB oracle, like the driver does:
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb
import numpy as np

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float) or isinstance(v, np.floating):
        f = float(v)
        if math.isnan(f):
            return "∅"
        return repr(f)
    if isinstance(v, (np.integer,)):
        return str(int(v))
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "isoformat"):
        if hasattr(v, "to_pydatetime"):
            v = v.to_pydatetime()
        return v.isoformat()
    if isinstance(v, dt.timedelta):
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def spark_type_name(t):
    """The DuckDB name of a Spark type, for the schema comparison."""
    from pyspark.sql import types as T
    if isinstance(t, T.ArrayType):
        return spark_type_name(t.elementType) + "[]"
    if isinstance(t, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {spark_type_name(f.dataType)}" for f in t.fields) + ")"
    return {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
            T.FloatType: "FLOAT", T.StringType: "VARCHAR", T.TimestampNTZType: "TIMESTAMP",
            T.BooleanType: "BOOLEAN"}.get(type(t), str(t))


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r[c] for c in cols) for r in (x.asDict(recursive=True) for x in df.collect())]


def check(spark, sf_dir, keys=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sq = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            stypes = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
            cols, rows = spark_rows(sdf)
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK-ERROR", str(e)[:400])
            print(k, "SPARK-ERROR", str(e)[:400]) if verbose else None
            continue
        ts = time.time() - t0
        if k not in sq:
            results[k] = ("rows-only", len(rows))
            print(f"{k:28s} rows-only n={len(rows)} {ts:.1f}s") if verbose else None
            continue
        try:
            rel = con.sql(sq[k])
            dtypes = {n: str(t) for n, t in zip(rel.columns, rel.types)}
            cur = con.execute(sq[k])
            dcols = [c[0] for c in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("DUCK-ERROR", str(e)[:400])
            print(k, "DUCK-ERROR", str(e)[:400]) if verbose else None
            continue
        hs, ls = digest(cols, rows)
        hd, ld = digest(dcols, drows)
        ok = (sorted(cols) == sorted(dcols) and len(rows) == len(drows) and hs == hd
              and stypes == dtypes)
        results[k] = ("OK" if ok else "MISMATCH", len(rows), len(drows))
        if verbose:
            print(f"{k:28s} {'OK' if ok else 'MISMATCH'} spark={len(rows)} duck={len(drows)} {ts:.1f}s")
            if not ok:
                if sorted(cols) != sorted(dcols):
                    print("   cols", sorted(cols), sorted(dcols))
                if stypes != dtypes:
                    print("   types", {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
                                       if stypes.get(c) != dtypes.get(c)})
                a, b = set(ls), set(ld)
                for x in sorted(a - b)[:3]:
                    print("   spark-only", x[:300])
                for x in sorted(b - a)[:3]:
                    print("   duck-only ", x[:300])
    return results


if __name__ == "__main__":
    from recbrook.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    res = check(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("SUMMARY ok=%d rows-only=%d bad=%d %s" % (
        sum(v[0] == "OK" for v in res.values()), sum(v[0] == "rows-only" for v in res.values()),
        len(bad), bad))
