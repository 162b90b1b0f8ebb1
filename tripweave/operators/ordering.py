"""Event-time order: sort, first rows, gaps and replay schedules.

A window over the whole table would put it into one task, and a window per day
would put a hot day into one task. So the gap and schedule operators deal the
table to even slices of its total order (``tripweave.operators.slices``), compute
inside each slice, and join back one summary row per slice. The rows go through one
shuffle, which the summary reads too; nothing is written on the way.

The order is event time, then ride id. A last key, drawn at random, settles
nothing that shows, but it lets the cut run through many trips of one instant
and through many copies of one trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.columns import MICROS
from tripweave.operators.slices import SLICE, all_columns, in_order, sliced

# One simulated day per real minute, and no least delay.
SPEEDUP = 1440.0
MIN_DELAY_S = 0.0

ORDER = ["event_time", "ride_id"]

# Histograms that close in on an instant, coarsest first: days, seconds of a day, microseconds of a second.
_UNITS = ("DAY", "SECOND", "MICROSECOND")


def _tie(trips: DataFrame) -> Column:
    """A key that splits rows with one event time and ride id.

    Its high 48 bits hash the row, so that a retry sends it the same way; the low
    16 are drawn and split rows that are equal throughout.
    """
    low = 1 << 16
    drawn = (F.rand(0) * low).cast("long")
    return F.xxhash64(*trips.columns).bitwiseAND(F.lit(-low)).bitwiseOR(drawn)


def sort_by_event_time(trips: DataFrame) -> DataFrame:
    """Ascending event time, missing times last, ties by ride id."""
    return trips.orderBy(F.col("event_time").asc_nulls_last(), "ride_id", _tie(trips))


def range_cut(trips: DataFrame) -> DataFrame:
    """Partitions that hold even, consecutive stretches of the order, each sorted."""
    return trips.repartitionByRange(*ORDER, _tie(trips)).sortWithinPartitions(*ORDER)


def _start_of(unit: str) -> Column:
    return F.date_trunc(unit, "event_time") if unit != "MICROSECOND" else F.col("event_time")


def _instant_of_nth(trips: DataFrame, n: int) -> Column:
    """The event time of the n-th trip, the last one where there are fewer, as a scalar subquery.

    Each histogram counts the trips up to the end of the day or second that the one before has
    found, those before its start in one bucket; so a histogram has at most a million rows, or one per day.
    """
    found = None
    for unit, above in zip(_UNITS, (None, *_UNITS)):
        start, counted = _start_of(unit), trips
        if found is not None:
            counted = trips.where(F.col("event_time") < found + F.expr(f"INTERVAL 1 {above}"))
            start = F.greatest(start, found)
        counts = counted.groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("rows"))
        running = counts.withColumn("so_far", F.sum("rows").over(Window.orderBy("start")))
        holder = F.coalesce(F.min(F.when(F.col("so_far") >= n, F.col("start"))), F.max("start"))
        found = running.agg(holder.alias("found")).scalar()
    return found


def first_n(trips: DataFrame, n: int | None = None) -> DataFrame:
    """The first n rows with an event time, in event order; None or 0 means all.

    A plain top-n sends n rows of every partition to one task. Here histograms of event times find the instant of the
    n-th trip. All trips before it are wanted, and of those at it the first few by ride id, which are ranked in slices:
    a hot instant is no hot task, and nothing else is ranked. It is one plan for any n, and runs nothing before it is read.
    """
    valid = trips.where(F.col("event_time").isNotNull())
    if not n:
        return sort_by_event_time(valid)
    last = _instant_of_nth(valid.select("event_time"), n)
    earlier = valid.where(F.col("event_time") < last)
    missing = F.lit(n) - valid.select("event_time").where(F.col("event_time") < last).agg(F.count(F.lit(1))).scalar()
    # The row goes along as one value, as its columns may have any names.
    at_last = valid.where(F.col("event_time") == last).select("ride_id", F.struct(*trips.columns).alias("trip"))
    ranked = _numbered(sliced(at_last, ["ride_id"]), ["ride_id"])
    return sort_by_event_time(earlier.unionByName(ranked.where(F.col("number") <= missing).select("trip.*")))


def _numbered(cut: DataFrame, order: list[str]) -> DataFrame:
    """Sliced rows with ``number``, their place in the order, from 1."""
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(SLICE).agg(F.count_if(all_columns(cut)).alias("rows"))
    # One row per slice.
    starts = sizes.select(SLICE, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    placed = cut.withColumn("number", F.row_number().over(in_order(order))).join(F.broadcast(starts), SLICE, "left")
    return placed.withColumn("number", F.col("number") + F.col("start"))


def emit_offsets(trips: DataFrame, speedup: float = SPEEDUP) -> DataFrame:
    """Seconds from replay start to each trip when there is no least delay.

    The delays then telescope to the time since the first trip, so this needs one
    global minimum and neither a sort nor a shuffle of rows.
    """
    valid = trips.where(F.col("event_time").isNotNull())
    us = F.unix_micros("event_time")
    first = valid.agg(F.min(us)).scalar()
    return valid.withColumn("emit_offset_s", (us - first).cast("double") / F.lit(speedup * MICROS))


def _floored(gap_us: Column, floor_us: int) -> Column:
    """The gap, at least the floor; NULL where there is no gap."""
    return F.when(gap_us.isNotNull(), F.greatest(gap_us, F.lit(floor_us).cast("long")))


def replay_schedule(
    trips: DataFrame,
    *,
    speedup: float = SPEEDUP,
    min_delay_s: float = MIN_DELAY_S,
    slices: int | None = None,
) -> DataFrame:
    """Place every trip that has an event time in the replay.

    Adds ``seq`` (1 = first), ``gap_s`` to the trip before (0 for the first),
    ``delay_s`` = the gap over the speed-up, at least ``min_delay_s``, and
    ``emit_offset_s``, the running total of delays. Totals are kept as whole
    microseconds of event time, so they do not depend on the order of addition.

    ``slices`` defaults to the shuffle partition count; set it so that one slice
    fits a task. Pass only the columns you need: they are shuffled and sorted.
    """
    floor_us = round(min_delay_s * speedup * MICROS)
    # The trip goes along as one value, as its columns may have any names.
    rows = trips.where(F.col("event_time").isNotNull()).select(
        *ORDER, F.unix_micros("event_time").alias("us"), F.struct(*trips.columns).alias("trip")
    )
    cut = sliced(rows, ORDER, slices)
    here = in_order(ORDER)
    up_to_here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        cut.withColumn("gap_us", F.col("us") - F.lag("us").over(here))
        .withColumn("row", F.row_number().over(here))
        # The first row of a slice waits on the slice before it, so it adds nothing here.
        .withColumn("own_us", F.coalesce(_floored(F.col("gap_us"), floor_us), F.lit(0)))
        .withColumn("wait_us", F.sum("own_us").over(up_to_here))
    )
    by_slice = Window.orderBy(SLICE)
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, at most ``slices`` rows: small enough for one task and to broadcast.
    carry = (
        local.groupBy(SLICE)
        .agg(
            F.min("us").alias("first_us"),
            F.max("us").alias("last_us"),
            F.max("wait_us").alias("wait_us"),
            F.count_if(all_columns(cut)).alias("rows"),
        )
        .withColumn("entry_gap_us", F.coalesce(F.col("first_us") - F.lag("last_us").over(by_slice), F.lit(0)))
        .withColumn("entry_us", _floored(F.col("entry_gap_us"), floor_us))
        .withColumn("rows_before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .withColumn(
            "start_us",
            F.col("entry_us")
            + F.coalesce(F.sum((F.col("entry_us") + F.col("wait_us")).cast("decimal(28,0)")).over(before), F.lit(0)),
        )
        .select(SLICE, "entry_gap_us", "rows_before", "start_us")
    )
    gap_s = F.coalesce("gap_us", "entry_gap_us").cast("double") / F.lit(float(MICROS))
    placed = local.join(F.broadcast(carry), SLICE, "left").withColumn("gap_s", gap_s)
    added = [
        (F.col("rows_before") + F.col("row")).alias("seq"),
        F.col("gap_s"),
        F.greatest(F.col("gap_s") / F.lit(float(speedup)), F.lit(float(min_delay_s))).alias("delay_s"),
        ((F.col("start_us") + F.col("wait_us")).cast("double") / F.lit(speedup * MICROS)).alias("emit_offset_s"),
    ]
    return placed.select("trip.*", *added)


def inter_arrival_gaps(trips: DataFrame, **options: object) -> DataFrame:
    """The trips with ``gap_s``, seconds since the trip before."""
    return replay_schedule(trips, **options).select(*trips.columns, "gap_s")


def replay_delays(trips: DataFrame, **options: object) -> DataFrame:
    """The trips with ``delay_s``, the compressed gap."""
    return replay_schedule(trips, **options).select(*trips.columns, "delay_s")
