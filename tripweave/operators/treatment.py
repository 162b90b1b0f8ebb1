"""The untreated day, marking it, and event-time ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import from_micros, instant

# Flag texts and the span of one batch.
TREATED = "Yes"
UNTREATED = "No"
BATCH_SPAN = "INTERVAL '1' DAY"

Bound = Column | datetime


def flag_untreated(trips: DataFrame) -> DataFrame:
    return trips.withColumn("treated", F.lit(UNTREATED))


def untreated_min(trips: DataFrame) -> DataFrame:
    """One row: the earliest event time not yet treated, NULL if there is none."""
    return trips.where(F.col("treated") == UNTREATED).agg(F.min("event_time").alias("t0"))


def untreated_window(trips: DataFrame) -> DataFrame:
    """One row: both ends of the next batch, ``t0`` and ``t1`` = one day later."""
    return untreated_min(trips).select("t0", (F.col("t0") + F.expr(BATCH_SPAN)).alias("t1"))


def untreated_bounds(trips: DataFrame) -> tuple[datetime, datetime] | None:
    """The ends of the next batch as values, None if all is treated. Reads one row."""
    row = untreated_window(trips).select(F.unix_micros("t0").alias("a"), F.unix_micros("t1").alias("b")).first()
    return None if row["a"] is None else (from_micros(row["a"]), from_micros(row["b"]))


def _lazy_bounds(trips: DataFrame) -> tuple[Column, Column]:
    # One subquery for both ends: two would be merged into a struct, which no scan filters on.
    t0 = untreated_min(trips).scalar()
    return t0, t0 + F.expr(BATCH_SPAN)


def within(trips: DataFrame, t0: Bound, t1: Bound) -> Column:
    """Event time in [t0, t1], both ends included; prunes event dates where the table has them."""
    t0, t1 = instant(t0), instant(t1)
    inside = F.col("event_time").between(t0, t1)
    if "event_date" in trips.columns:
        inside &= F.col("event_date").between(t0.cast("date"), t1.cast("date"))
    return inside


def untreated_day(trips: DataFrame, bounds: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Rows within one day from the earliest untreated event time, treated ones included.

    Without ``bounds`` the earliest time is a scalar subquery and the operator is
    one plan, in which the scan filters on the lower end. With them (see
    ``untreated_bounds``) both ends are literals that the scan filters on.
    """
    if bounds is not None:
        return trips.where(within(trips, *bounds))
    return trips.where(within(trips, *_lazy_bounds(trips)))


def mark_treated(trips: DataFrame, bounds: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Set the flag on the rows of ``untreated_day``, so that the next batch moves on."""
    inside = within(trips, *(bounds or _lazy_bounds(trips)))
    return trips.withColumn("treated", F.when(inside, F.lit(TREATED)).otherwise(F.col("treated")))


def backfill_range(trips: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with event time in [start, end); datetimes without a zone are UTC."""
    t0, t1 = instant(start), instant(end)
    inside = (F.col("event_time") >= t0) & (F.col("event_time") < t1)
    if "event_date" in trips.columns:
        inside &= F.col("event_date").between(t0.cast("date"), t1.cast("date"))
    return trips.where(inside)
