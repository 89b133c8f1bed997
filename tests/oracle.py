"""Run registered queries and their SQL twins side by side.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        return "NaN" if math.isnan(v) else repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """None when equal, else a short text."""
    rows = spark_df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    other = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} / {sorted(names)}"
    a, b = canonical(spark_df.columns, rows), canonical(names, other)
    if len(a) != len(b):
        return f"rows differ: {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, e.g. {str(wrong[0][0])[:300]} / {str(wrong[0][1])[:300]}"
    if not a:
        return "no rows"
    return None


def main(argv):
    import __spark_entry__ as entry
    from fieldloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("oracle")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else (None if df.collect() else "no rows")
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}"
              + (f"  {problem}" if problem else ""), flush=True)
    print(f"{len(names) - bad} of {len(names)} good")


if __name__ == "__main__":
    main(sys.argv[1:])
