"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the order-insensitive multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
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
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = rows_of([tuple(r) for r in spark_df.collect()], s_cols)
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = rows_of(res.fetchall(), d_cols)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} oracle={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} oracle={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from tidyspark.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                problems, n = compare(df, con, oracle[name])
            else:
                problems, n = [], df.count()
        except Exception as e:  # report and go on
            problems, n = [f"error {type(e).__name__}: {str(e)[:400]}"], -1
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        kind = "oracle" if name in oracle else "rows-only"
        print(f"{status} {name:32s} rows={n:7d} {kind:9s} {time.time() - t:6.1f}s "
              + "; ".join(problems), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
