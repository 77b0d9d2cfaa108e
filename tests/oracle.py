"""Compare registered queries with their SQL, and time them.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=0, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    found = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(found.columns):
        return f"columns {names} != {sorted(found.columns)}"
    types = dict(zip(found.columns, map(str, found.types)))
    for field in df.schema:
        expected = TYPES.get(field.dataType.simpleString())
        if types[field.name] != expected:
            return f"{field.name} is {expected}, not {types[field.name]}"
    left = sorted((tuple(row[n] for n in names) for row in df.collect()), key=_key)
    order = [found.columns.index(n) for n in names]
    right = sorted((tuple(row[i] for i in order) for row in found.fetchall()), key=_key)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{names}: {str(a)[:300]} != {str(b)[:300]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from recmill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problem = differences(df, con, oracles[name])
                note = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, note = None, f"{df.count()} rows, not compared"
        except Exception as error:
            problem = note = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
