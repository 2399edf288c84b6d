"""Run registered queries next to their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, bool):
        return value
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=lambda row: tuple((v is None, str(v)) for v in row))


def spark_rows(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    return canonical(columns, cursor.fetchall())


def difference(got, want):
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        kinds = {(type(x).__name__, type(y).__name__) for a, b in bad[:50] for x, y in zip(a, b) if x != y}
        return f"{len(bad)} rows differ {kinds}: {bad[0][0]} != {bad[0][1]}"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.session import local_session

    spark = local_session()
    connection = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            got = spark_rows(queries[name](spark, folder))
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name:28s} {took:6.2f}s {len(got[1])}", flush=True)
                continue
            problem = difference(got, oracle_rows(connection, oracles[name]))
        except Exception as error:  # report and go on with the next query
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
            got = ([], [])
        failed += problem is not None
        print(f"{'ok   ' if problem is None else 'FAIL '} {name:28s} {took:6.2f}s {len(got[1])} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
