"""Relational source and sink over JDBC, read in parallel ranges of event time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

# Rows per insert round trip and the staging table's name.
INSERT_BATCH = 1000
STAGING_TABLE = "stg.rides_stream"


def _literal(t: datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S.%f}'"


def range_predicates(
    t0: datetime,
    t1: datetime,
    parts: int = 24,
    column: str = "event_time",
    splits: Sequence[str] = (),
) -> list[str]:
    """SQL conditions that cover [t0, t1] exactly once, one per read task.

    All are half open but the last. A busy hour makes a busy range, so ``splits``
    may give conditions in the database's own SQL that cut each range further, such
    as a hash of the key; together they must be true exactly once for every row.
    """
    step = (t1 - t0) / parts
    cuts = [t0 + i * step for i in range(parts)]
    ranges = [f"{column} >= {_literal(a)} AND {column} < {_literal(b)}" for a, b in zip(cuts, cuts[1:])]
    ranges.append(f"{column} >= {_literal(cuts[-1])} AND {column} <= {_literal(t1)}")
    return [f"({r}) AND ({s})" for r in ranges for s in splits] if splits else ranges


def read_untreated_day(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    table: str = STAGING_TABLE,
    parts: int = 24,
    splits: Sequence[str] = (),
) -> DataFrame | None:
    """The untreated day of a staging table; None if every row is treated.

    The database finds the earliest untreated time (one row, as its own wall clock
    shows it). The day itself is read in ``parts`` ranges with literal bounds, which
    the database filters on.
    """
    earliest = f"(SELECT MIN(event_time) AS t0 FROM {table} WHERE treated = 'No') earliest"
    wall_clock = {**properties, "preferTimestampNTZ": "true"}
    t0 = spark.read.jdbc(url, earliest, properties=wall_clock).first()["t0"]
    if t0 is None:
        return None
    day = range_predicates(t0, t0 + timedelta(days=1), parts, splits=splits)
    return spark.read.jdbc(url, table, predicates=day, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "errorifexists") -> None:
    """Write from the executors. By default it is an error if the table exists."""
    df.write.mode(mode).option("batchsize", INSERT_BATCH).jdbc(url, table, properties=properties)
