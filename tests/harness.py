"""Run registered queries beside their SQL and compare sorted values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: repr(t))


def compare(df, con, sql):
    """None when equal, else a short account of the difference."""
    got = df.collect()
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if bad:
        loose = [p for p in bad if p[0] != p[1]]
        return f"{len(bad)} of {len(a)} rows differ ({len(loose)} by value), e.g. {bad[0]}"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from salescope.session import get_spark

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    sqls = oracle_sql()
    failed = []
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                why = compare(df, con, sqls[name])
            else:
                rows = df.collect()
                why = None if rows else "no rows"
                for r in rows[:40] if only else []:
                    print("   ", r)
        except Exception as e:  # report every query, then fail
            why = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if why is None else 'FAIL'} {name:28s} {'sql ' if name in sqls else 'rows'} {time.time() - t:6.1f}s  {why or ''}", flush=True)
        if why:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
