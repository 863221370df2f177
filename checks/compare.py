"""Runs every registered query and its DuckDB twin and compares the results.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from farelane.session import get_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in ("lineitem", "orders"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """What differs, ignoring row order; exact on all values."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(set(actual.columns) ^ set(expected.columns))}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} / {len(expected)}"
    columns = sorted(actual.columns)
    # Whole numbers with nulls are doubles on one side.
    expected = expected.astype({c: "float64" for c in columns if str(expected[c].dtype) == "Int64" and actual[c].dtype == "float64"})
    types = [(c, str(actual[c].dtype), str(expected[c].dtype)) for c in columns if actual[c].dtype != expected[c].dtype]
    left, right = _sorted_rows(actual[columns]), _sorted_rows(expected[columns])
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} rows, first {bad[0]} types {types}"
    return f"types {types}" if types else None


def _sorted_rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    rows = frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(tuple(_cell(v) for v in row) for row in rows)


def _cell(value) -> str:
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = get_session("compare", {"spark.master": "local[8]", "spark.checkpoint.dir": "spark-warehouse/_compare", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    connection = connect(folder)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            actual = QUERIES[name](spark, folder).toPandas()
            seconds = time.time() - start
            found = difference(actual, connection.execute(ORACLE_SQL[name]).df()) if name in ORACLE_SQL else "no twin"
        except Exception as error:  # report and go on with the next query
            seconds, found, actual = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        failures += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name:28s} {len(actual):7d} rows {seconds:6.2f}s {found or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main(*sys.argv[1:])))
