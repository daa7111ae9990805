"""Run queries against their SQL over one data directory: python tests/compare.py DIR [NAME...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canonical(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        x = float(v)
        return "nan" if math.isnan(x) else f"{x:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canonical(x) for x in v) + "]"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(canonical(r[i]) for i in order) for r in data])


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            path = f"{sf_dir}/{f}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{f}") else "")
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    ours = rows(df.columns, df.collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs = rows(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns differ: {sorted(df.columns)} {sorted(cols)}"
    if ours != theirs:
        extra, missing = [x for x in ours if x not in set(theirs)][:2], [x for x in theirs if x not in set(ours)][:2]
        return f"rows differ: {len(ours)} and {len(theirs)}; only ours {extra}; only SQL {missing}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as e
    from archivolt.session import build

    spark, sf_dir = build("local[8]", 8), sys.argv[1]
    names, sql, con = sys.argv[2:] or list(e.queries()), e.oracle_sql(), duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            if n in sql:
                said = compare(spark, con, sf_dir, n, e.queries()[n], sql[n]) or "same"
            else:
                said = f"{e.queries()[n](spark, sf_dir).count()} rows, no SQL"
        except Exception as x:
            said = "ERROR " + str(x)[:600]
        bad += said not in ("same",) and "no SQL" not in said
        print(f"{n}: {said} ({time.time() - t:.1f} s)", flush=True)
    print("bad", bad)
