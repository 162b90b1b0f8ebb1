"""Replay a stored table as a stream in event order."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.columns import from_micros, instant
from tripweave.operators.ordering import range_cut
from tripweave.operators.treatment import backfill_range
from tripweave.sources.tables import read_table

SLICE = "slice"
_EPOCH = from_micros(0)


def event_span(trips: DataFrame) -> tuple[datetime, datetime] | None:
    """First and last event time, None for an empty table. Reads one row."""
    micros = F.unix_micros("event_time")
    row = trips.agg(F.min(micros).alias("a"), F.max(micros).alias("b")).first()
    return None if row["a"] is None else (from_micros(row["a"]), from_micros(row["b"]))


def event_slices(trips: DataFrame, step: timedelta = timedelta(days=1)) -> Iterator[tuple[datetime, DataFrame]]:
    """The table cut by event time, oldest part first: its start, and the part sorted over all executors.

    Parts are counted from the midnight before the first event, and only those that hold trips are
    given: one stray date costs one part, not one for each day between. Give a table partitioned by event
    date, so that a part reads its own dates alone.
    """
    span = event_span(trips)
    if span is None:
        return
    first = span[0].replace(hour=0, minute=0, second=0, microsecond=0)
    width = step // timedelta(microseconds=1)
    since = F.unix_micros("event_time") - F.unix_micros(instant(first))
    # One row for each part with trips.
    held = trips.where(F.col("event_time").isNotNull()).select(F.floor(since / F.lit(width)).alias("part")).distinct()
    for part in sorted(r.part for r in held.collect()):
        start = first + part * step
        yield start, range_cut(backfill_range(trips, start, start + step))


def land_in_event_order(trips: DataFrame, path: str, step: timedelta = timedelta(days=1)) -> int:
    """Write the table slice by slice, oldest first; gives the number of slices.

    A slice has a folder of its own, named by its start. A landing that died can be run again:
    slices before the last one written are left as they are, and that one, which may
    be in part, is written anew with those after it.

    A file stream takes files by age, so the slices are written one after another,
    each by a job of its own on all executors. Within a slice the files hold
    disjoint event-time ranges, but their ages may differ from that order: keep a
    watermark longer than a step.
    """
    before = read_table(trips.sparkSession, path)
    done = {r[SLICE] for r in before.select(SLICE).distinct().collect()} if before is not None else set()
    last = max(done, default=0)
    slices = 0
    for start, part in event_slices(trips, step):
        name = (start - _EPOCH) // timedelta(microseconds=1)
        if name not in done or name == last:
            part.write.mode("overwrite").parquet(f"{path}/{SLICE}={name}")
        slices += 1
    return slices


def replay_stream(spark: SparkSession, path: str, like: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """The landed table as a stream; ``files_per_batch`` sets the pace."""
    reader = spark.readStream.schema(like.schema.add(SLICE, "long")).option("basePath", path)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).drop(SLICE)
