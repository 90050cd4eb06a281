"""Run registered queries against their SQL oracle: `python tests/compare.py [folder] [name ...]`."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem documents benchmark pages labels".split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def normalised(names, rows):
    """Columns sorted by name, values as text, rows sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return normalised(names, cursor.fetchall())


def main() -> int:
    import __spark_entry__ as contract
    from tallyhouse import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.oracle_sql())
    spark = build_session("compare", "local[8]", **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, queries, bad = duck(folder), contract.oracle_sql(), contract.queries(), 0
    for name in chosen:
        start = time.time()
        names, rows = spark_rows(queries[name](spark, folder))
        took = time.time() - start
        expected_names, expected = oracle_rows(con, sql[name])
        same = names == expected_names and rows == expected
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {len(rows)}/{len(expected)} {took:.2f}s", flush=True)
        if not same:
            print("   ", names, expected_names)
            print("   ", [r for r in rows if r not in set(expected)][:3], [r for r in expected if r not in set(rows)][:3])
    return bad


if __name__ == "__main__":
    sys.exit(main())
