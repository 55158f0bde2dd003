"""Compare every query with its SQL on one scale: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from surveyloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_by_name(columns, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """What differs between the query and its SQL, or None."""
    frame = QUERIES[name](spark, sf_dir)
    found = rows_by_name(frame.columns, frame.collect())
    cursor = connection.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    wanted = rows_by_name(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    if found != wanted:
        extra, absent = sorted(set(found) - set(wanted)), sorted(set(wanted) - set(found))
        return f"{len(found)} / {len(wanted)} rows; only here {extra[:2]}; only there {absent[:2]}"
    types = {n: t for n, t in frame.dtypes}
    numbers = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in zip(columns, cursor.description):
        expected = numbers.get(types[column])
        if expected and str(kind[1]).upper() not in (expected, "NUMBER", "STRING", "BOOL"):
            return f"type of {column}: {types[column]} / {kind[1]}"
    return None if found else "no rows"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    root = os.environ.get("TESTDATA", "/root/testdata")
    sf_dir = f"{root}/{sf}"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                result = difference(spark, connection, name, sf_dir)
            else:
                result = f"no SQL; {len(QUERIES[name](spark, sf_dir).collect())} rows"
        except Exception as error:  # report and go on to the next query
            result = f"{type(error).__name__}: {str(error)[:700]}"
        bad += result is not None
        print(f"{name:32s} {time.time() - start:6.1f}s {result or 'same'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
