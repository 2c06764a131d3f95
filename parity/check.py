"""Run every registered query beside its SQL: ``python -m parity.check [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from .queries import QUERIES
from .sql import SQL


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """The test tables as views of an in-process database."""
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _comparable(rows: list[tuple], columns: list[str]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if pd.isna(row[i]) else row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def _kind(name: str) -> str:
    """Type families that must agree between the engines."""
    name = name.lower()
    for prefix, kind in (
        ("bigint", "long"), ("int", "int"), ("hugeint", "hugeint"), ("double", "double"), ("decimal", "decimal"),
        ("varchar", "text"), ("string", "text"), ("date", "date"), ("timestamp", "time"), ("bool", "bool"),
    ):
        if name.startswith(prefix):
            return kind
    return name


def mismatch(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """Why a query and its SQL differ, or None."""
    df = QUERIES[name](spark, sf_dir)
    got = _comparable([tuple(r) for r in df.collect()], df.columns)
    relation = connection.sql(SQL[name])
    want = _comparable(relation.fetchall(), relation.columns)
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    got_types = {c: _kind(t) for c, t in df.dtypes}
    want_types = {c: _kind(str(t)) for c, t in zip(relation.columns, relation.types)}
    if got_types != want_types:
        return f"types {[(c, got_types[c], want_types[c]) for c in got_types if got_types[c] != want_types[c]]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(differing)} of {len(got[1])} rows, first {got[0]}: {differing[0]}" if differing else None


def main() -> int:
    from actionlens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(sf_dir)
    failed = 0
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        if name in SQL:
            why = mismatch(spark, connection, sf_dir, name)
            failed += why is not None
            result = f"DIFFERS: {why}" if why else "equal"
        else:
            result = f"rows only: {len(QUERIES[name](spark, sf_dir).collect())}"
        print(f"{name:32s} {time.time() - start:6.2f}s {result}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
