"""Compare registered queries with their oracle SQL: python tests/oracle_check.py [SF_DIR] [NAME...]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canonical(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or v != v:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(canonical(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canonical(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return canonical(v.asDict())
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, name, query, sql, sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = query(spark, sf_dir)
    ours = bag(df.columns, df.collect())
    cur = con.execute(sql)
    theirs = bag([x[0] for x in cur.description], cur.fetchall())
    assert ours[0] == theirs[0], f"{name}: columns {ours[0]} and {theirs[0]}"
    only, missing = ours[1] - theirs[1], theirs[1] - ours[1]
    assert not only and not missing, f"{name}: {sum(only.values())} only here, {sum(missing.values())} missing, e.g. {list(only)[:2]} / {list(missing)[:2]}"
    return sum(ours[1].values())


if __name__ == "__main__":
    import __spark_entry__ as entry
    from quillon.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    queries, oracles = entry.queries(), entry.oracle_sql()
    for n in sys.argv[2:] or list(queries):
        t = time.time()
        try:
            k = compare(spark, n, queries[n], oracles[n], sf_dir) if n in oracles else f"{queries[n](spark, sf_dir).count()} rows only:"
            print("ok  ", n, k, f"{time.time() - t:.1f}s", "EMPTY" if not k else "", flush=True)
        except Exception as e:  # noqa: BLE001
            print("FAIL", n, str(e)[:600], flush=True)
