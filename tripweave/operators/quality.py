"""Data tests: not-null, unique, range, business rules and freshness.

A test returns its failures, so an empty or all-zero result means it passed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import MICROS, instant, minutes_between, speed_kmh

# Our choice: a taxi above this average speed is a data error.
SPEED_LIMIT_KMH = 130.0


def _failures(df: DataFrame, checks: Mapping[str, Column], label: str) -> DataFrame:
    """Rows (label, failures), counted in one pass over the table."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
    return counted.unpivot([], list(checks), label, "failures")


def not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Missing values per column."""
    return _failures(df, {c: F.col(c).isNull() for c in columns}, "column_name")


def in_range(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values outside [low, high] per column; None leaves an end open, NULL values pass."""

    def outside(name: str, low: float | None, high: float | None) -> Column:
        c = F.col(name)
        ends = ([c < F.lit(low)] if low is not None else []) + ([c > F.lit(high)] if high is not None else [])
        return reduce(or_, ends, F.lit(False))

    return _failures(df, {n: outside(n, *ends) for n, ends in ranges.items()}, "column_name")


def not_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def trip_rules(speed_limit_kmh: float = SPEED_LIMIT_KMH) -> dict[str, Column]:
    """Each rule as the condition that breaks it."""
    minutes = minutes_between("event_time", "dropoff_time")
    return {
        "dropoff_before_pickup": F.col("dropoff_time") < F.col("event_time"),
        "over_speed": speed_kmh(F.col("distance_km"), minutes) > F.lit(speed_limit_kmh),
    }


def business_rules(trips: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row (ride_id, event_time, rule) per broken rule. Narrow: no shuffle.

    A filter in generated code finds the few rows that break any rule, and only
    those are taken apart by rule.
    """
    rules = trip_rules() if rules is None else rules
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    any_broken = reduce(or_, [F.coalesce(cond, F.lit(False)) for cond in rules.values()], F.lit(False))
    return trips.where(any_broken).select("ride_id", "event_time", F.explode(broken).alias("rule"))


def freshness(trips: DataFrame, as_of: datetime | Column, max_age_s: float) -> DataFrame:
    """One row: latest event time, its age in seconds, and whether that is fresh enough."""
    age = (F.unix_micros(instant(as_of)) - F.unix_micros("latest_event")).cast("double") / F.lit(float(MICROS))
    return (
        trips.agg(F.max("event_time").alias("latest_event"))
        .withColumn("age_s", age)
        .withColumn("is_fresh", F.coalesce(F.col("age_s") <= F.lit(float(max_age_s)), F.lit(False)))
    )
