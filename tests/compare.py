"""Run a registered query and its SQL twin side by side and report the differences."""

from __future__ import annotations

import math
import sys
import time

import duckdb

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when both engines agree, else what differs."""
    df = entry.queries()[name](spark, folder)
    left_names, left = ordered(df.columns, [tuple(row) for row in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if left else "no rows"
    relation = con.execute(sql)
    columns = [item[0] for item in relation.description]
    kinds = {item[0]: str(item[1]) for item in relation.description}
    right_names, right = ordered(columns, relation.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    spark_kinds = dict(df.dtypes)
    wanted = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    odd = {c: (spark_kinds[c], kinds[c]) for c in columns if wanted.get(spark_kinds[c]) not in (kinds[c], None)}
    if odd:
        return f"types {odd}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows, first {wrong[0]}" if wrong else None


def main() -> None:
    from tests.conftest import make_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con = make_session(), connect(folder)
    bad = 0
    for name in wanted:
        start = time.perf_counter()
        try:
            problem = difference(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:45s} {time.perf_counter() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(wanted)} queries, {bad} differ")


if __name__ == "__main__":
    main()
