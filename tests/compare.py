"""Runs registered queries next to their SQL on DuckDB and compares the rows.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    return v


def kind(v):
    return "num" if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool) else type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def compare(spark, con, sf_dir, fn, sql):
    start = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = f"spark {time.time() - start:.2f}s "
    if sql is None:
        return True, spent + f"rows only: {sum(got.values())}"
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    for name, t in df.dtypes:
        if t in SPARK_TYPES and SPARK_TYPES[t] != want_types[name]:
            return False, f"type of {name}: {t} != {want_types[name]}"
    if got != want:
        only_got, only_want = list((got - want).items())[:3], list((want - got).items())[:3]
        return False, (f"rows {sum(got.values())} vs {sum(want.values())}, differ {sum((got - want).values())}"
                       f"\n   cols  {got_cols}\n   spark {only_got}\n   duck  {only_want}")
    return True, spent + f"{sum(got.values())} rows"


def main():
    import __spark_entry__ as entry
    from reviewloom.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", 8, spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, queries[name], oracles.get(name))
        except Exception as e:  # report and go on with the next query
            ok, note = False, "".join(traceback.format_exception_only(e))[:1500]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
