"""Run named queries on Spark and their SQL twins on DuckDB, compare the results.

    python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import logging
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if value is None:
        return "<null>"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> tuple[bool, str, int]:
    began = time.time()
    collected = [tuple(r) for r in df.collect()]
    print(f"     spark {time.time() - began:.1f}s", end=" ")
    got = rows_of(df.columns, collected)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}", len(got)
    want = rows_of(names, result.fetchall())
    alike = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    odd = [f"{n}: {t} vs {types[n]}" for n, t in df.dtypes if alike.get(t) != types[n]]
    if odd:
        return False, "types " + "; ".join(odd), len(got)
    if got != want:
        a, b = set(got), set(want)
        return False, (f"{len(got)} vs {len(want)} rows\n      only spark {sorted(a - b)[:3]}"
                       f"\n      only duck  {sorted(b - a)[:3]}"), len(got)
    return True, "", len(got)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--explain", action="store_true")
    args = parser.parse_args()
    from corpuscle.plans import all_queries
    from corpuscle.session import build_session
    spark = build_session(master="local[8]", conf={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    folder = f"/root/testdata/sf{args.sf}"
    con = duck(folder)
    picked = {n: q for n, q in all_queries().items()
              if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1]))
                                       for a in args.names)}
    failed = []
    for name, q in picked.items():
        began = time.time()
        try:
            df = q.run(spark, folder)
            if args.explain:
                df.explain("formatted")
            if q.sql:
                ok, why, n = compare(df, con, q.sql)
            else:
                n = len(df.collect())
                ok, why = True, "(rows only)"
        except Exception as error:  # report and go on with the next query
            ok, why, n = False, f"{type(error).__name__}: {str(error)[:500]}", -1
        print(f"{'ok  ' if ok else 'FAIL'} {name} rows={n} {time.time() - began:.1f}s {why}",
              flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(picked) - len(failed)}/{len(picked)} passed; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
