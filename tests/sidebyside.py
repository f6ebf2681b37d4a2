"""Run registered queries in Spark and their SQL twins in DuckDB and compare the values.

    python tests/sidebyside.py [name ...]      (SF=0.01 by default)
"""

import glob
import math
import os
import sys
import threading
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def duck(folder):
    con = duckdb.connect()
    con.execute("set threads to 8")
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def clean(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    return (1, str(v)) if not isinstance(v, (list, tuple)) else (1, str([clean(x) for x in v]))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(clean(r[k]) for k in order) for r in rows)


def compare(spark, con, folder, fn, sql):
    """None if equal, else a text that says what differs; plus row count."""
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return (None if got else "no rows"), len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    types = {d[0]: str(d[1]) for d in cur.description}
    mine = dict(df.dtypes)
    if sorted(mine) != sorted(names):
        return f"columns {sorted(mine)} != {sorted(names)}", len(got)
    for n, t in mine.items():
        if TYPES.get(t, t) != types[n]:
            return f"type of {n}: {t} != {types[n]}", len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}", len(got)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ in {sorted(names)}: {bad[0]}", len(got)
    return (None if a else "both empty"), len(got)


def give_up(name):
    print(f"FAIL {name}: over the time limit, stopping", flush=True)
    os._exit(1)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from seispark.session import local_session

    spark = local_session(8)
    sf = f"/root/testdata/sf{os.environ.get('SF', '0.01')}"
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    picked = sys.argv[1:] or list(qs)
    picked = [q for q in qs if any(q == p or (p.endswith("*") and q.startswith(p[:-1])) for p in picked)] if sys.argv[1:] else picked
    failed = []
    for name in picked:
        t = time.time()
        guard = threading.Timer(float(os.environ.get("LIMIT", "90")), give_up, [name])
        guard.start()
        try:
            verdict, n = compare(spark, con, sf, qs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            verdict, n = f"{type(e).__name__}: {str(e)[:1500]}", 0
        guard.cancel()
        mark = "ok  " if verdict is None else "FAIL"
        print(f"{mark} {name:26s} {n:7d} rows {time.time()-t:6.2f}s {'' if name in sqls else '(no sql) '}{verdict or ''}", flush=True)
        if verdict:
            failed.append(name)
    print(f"{len(picked) - len(failed)}/{len(picked)} ok; failed: {' '.join(failed)}")
