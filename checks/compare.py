"""Run queries beside their SQL and compare names, rows and values."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process SQL connection that sees the given tables as views."""
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(r[i] for i in order) for r in rows]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs first, None if nothing does. Doubles must be equal to the bit."""
    names, rows = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    answer = con.execute(sql)
    want_names, want = _sorted_rows([d[0] for d in answer.description], answer.fetchall())
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if len(rows) != len(want):
        return f"{len(rows)} rows instead of {len(want)}"
    wrong = [(a, b) for a, b in zip(rows, want) if a != b and not _same_nan(a, b)]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def _same_nan(a: tuple, b: tuple) -> bool:
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))
