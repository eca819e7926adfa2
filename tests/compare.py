"""Run registered queries next to their SQL and compare the rows. Usage: compare.py [sf] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(float(v)) else round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def oracle(sf):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, con, name, fn, sql, sf):
    """(ok, message) of one query."""
    t0 = time.time()
    df = fn(spark, sf)
    got = df.collect()
    t1 = time.time()
    if sql is None:
        return len(got) > 0, f"rows only: {len(got)} rows, {t1 - t0:.1f}s"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    times = f"{len(got)} rows, spark {t1 - t0:.1f}s, sql {t2 - t1:.1f}s"
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a != b:
        return False, f"{times}; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}"
    return True, times


def main():
    from __spark_entry__ import oracle_sql, queries
    from tendersift.session import build_session
    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sqls, bad = oracle(sf), queries(), oracle_sql(), []
    for name, fn in qs.items():
        if wanted and not any(name.startswith(w) or fn.__module__.endswith(w) for w in wanted):
            continue
        try:
            ok, msg = compare(spark, con, name, fn, sqls.get(name), sf)
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        print("ok  " if ok else "FAIL", name, msg, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
