"""Run registered queries beside their SQL counterparts in DuckDB and report differences.

usage: python tools/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import catalog  # noqa: E402
from shelfline.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect()), {n: t for n, t in df.dtypes}


def duck_rows(con, text: str):
    result = con.execute(text)
    columns = [(c[0], str(c[1])) for c in result.description]
    order = sorted(range(len(columns)), key=lambda k: columns[k][0])
    rows = Counter(tuple(row[k] for k in order) for row in result.fetchall())
    return [columns[k][0] for k in order], rows, dict(columns)


def same_types(spark_types: dict, duck_types: dict) -> list:
    expected = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    return [(n, t, duck_types.get(n)) for n, t in spark_types.items() if not str(duck_types.get(n)).upper().startswith(expected.get(t, t.upper()))]


def main() -> int:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    con = connect(sf_dir)
    texts = catalog.oracle_sql()
    bad = 0
    for name, run in catalog.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            names, rows, types = spark_rows(run(spark, sf_dir))
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        took = time.time() - started
        if name not in texts:
            print(f"rows  {name}: {sum(rows.values())} rows, {took:.1f} s", flush=True)
            continue
        try:
            duck_names, duck, duck_types = duck_rows(con, texts[name])
        except Exception as error:
            print(f"SQL   {name}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        odd = same_types(types, duck_types)
        if names != duck_names or rows != duck:
            bad += 1
            print(f"DIFF  {name}: spark {sum(rows.values())} sql {sum(duck.values())} {names if names != duck_names else ''} {duck_names if names != duck_names else ''}")
            for row in list((rows - duck).items())[:3]:
                print("   spark", row)
            for row in list((duck - rows).items())[:3]:
                print("   sql  ", row)
        else:
            print(f"ok    {name}: {sum(rows.values())} rows, {took:.1f} s {'TYPES ' + str(odd) if odd else ''}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
