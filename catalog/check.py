"""Run registered queries beside their SQL twins and compare the results.

    python -m catalog.check [--sf DIR] [--only PREFIX ...] [--cpus N]
"""

from __future__ import annotations

import argparse
import math
import time
import traceback

import duckdb

from outcomelab.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def normal(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    return "NULL" if value is None else str(value)


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(frame, sql, connection):
    relation = connection.sql(sql)
    expected, expected_columns = relation.fetchall(), relation.columns
    got = [tuple(r) for r in frame.collect()]
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {frame.columns} != {expected_columns}", len(got)
    kinds = dict(zip(expected_columns, map(str, relation.types)))
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    wrong = [f"{c}: {t} != {kinds[c]}" for c, t in frame.dtypes
             if names.get(t, t.upper()) != kinds[c]]
    a, b = comparable(got, frame.columns), comparable(expected, expected_columns)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows", len(a)
    if a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(pairs)} rows differ, e.g. {pairs[0][0]} != {pairs[0][1]}", len(a)
    return ("types " + "; ".join(wrong)) if wrong else "", len(a)


def main() -> int:
    from . import oracle_sql, queries
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("--only", nargs="*", default=[])
    args.add_argument("--cpus", default="8")
    args = args.parse_args()
    spark = build_session("check", f"local[{args.cpus}]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    sql, bad = oracle_sql(), 0
    for name, query in queries().items():
        if args.only and not any(name.startswith(p) for p in args.only):
            continue
        start = time.time()
        try:
            frame = query(spark, args.sf)
            if name in sql:
                problem, n = compare(frame, sql[name], connection)
            else:
                rows = frame.collect()
                problem, n = ("" if rows else "no rows"), len(rows)
        except Exception as error:  # noqa: BLE001 - the report must go on
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", 0
            if not str(error):
                traceback.print_exc()
        bad += bool(problem)
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s "
              f"{n:8d} {name} {problem}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
