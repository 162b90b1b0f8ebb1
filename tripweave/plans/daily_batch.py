"""One event day from staging to warehouse, and backfills."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.functions.columns import instant
from tripweave.operators.enrich import DEFAULT_CHAIN, Transform, enrich
from tripweave.operators.treatment import TREATED, backfill_range, mark_treated, untreated_bounds, untreated_day
from tripweave.sources import ledger
from tripweave.sources.scratch import materialise, remove, scratch_path
from tripweave.sources.notes import read_note, remove_note, write_note
from tripweave.sources.tables import EVENT_DATE, gathered, read_table, replace_partitions, upsert_table
from tripweave.streaming.jobs import BATCH_ID

Bounds = tuple[datetime, datetime]

# What partitions of a marked day are called, before the time at which it began.
TREATED_PART = "day-"
OPEN_PART = "open-"


def _warehouse_rows(trips: DataFrame, transforms: Iterable[Transform]) -> DataFrame:
    return enrich(trips.drop(BATCH_ID), transforms)


def mark_day(trips: DataFrame, staging: str, bounds: Bounds) -> None:
    """Rewrite the one or two event dates of the batch with the flag set, in few files.

    ``trips`` is the staging table as it was read for the batch. Its list of files was
    fixed then, so only rows that were enriched are marked: a micro-batch that lands
    later lies in partitions of its own, stays untreated, and is taken by a later run.

    The partitions of the micro-batches that were read give way to two per date, one of treated
    rows and one of the rest, so files do not grow with the number of batches, and the next open day
    is sought outside the treated ones. A journal names the change before it is made;
    a run that died in between is finished by the next. The micro-batches go into the table's ledger
    (``tripweave.sources.ledger``), so that one that runs again does not bring its rows back.
    """
    spark = trips.sparkSession
    t0, t1 = bounds
    dates = F.col(EVENT_DATE).between(instant(t0).cast("date"), instant(t1).cast("date"))
    day, by = trips.where(dates), [EVENT_DATE, BATCH_ID]
    batch = F.concat(F.when(F.col("treated") == TREATED, F.lit(TREATED_PART)).otherwise(F.lit(OPEN_PART)), F.unix_micros(instant(t0)).cast("string"))
    copy = scratch_path(spark, "marked-day")
    marked = materialise(gathered(mark_treated(day, bounds).withColumn(BATCH_ID, batch), by), copy)

    def parts(rows: DataFrame) -> set[tuple[str, str]]:
        """One for each date and micro-batch of a day or two."""
        return {tuple(r) for r in rows.select(*(F.col(c).cast("string") for c in by)).distinct().collect()}

    read = parts(day)
    gone = sorted(f"{EVENT_DATE}={d}/{BATCH_ID}={b}" for d, b in read - parts(marked))
    absorbed = sorted((b, d) for d, b in read if not b.startswith((TREATED_PART, OPEN_PART)))
    write_note(spark, staging, "journal", {"copy": copy, "gone": gone, "schema": marked.schema.jsonValue(), "absorbed": absorbed})
    finish_mark(spark, staging)


def finish_mark(spark: SparkSession, staging: str) -> None:
    """Put the marked rows that a journal names in place of the ones they were read from; may be repeated."""
    journal = read_note(spark, staging, "journal")
    if journal is None:
        return
    # A copy is written once, so its name tells marks apart.
    ledger.record(spark, staging, journal["copy"].rsplit("/", 1)[-1], journal["absorbed"])
    marked = spark.read.schema(StructType.fromJson(journal["schema"])).parquet(journal["copy"])
    replace_partitions(marked, staging, [EVENT_DATE, BATCH_ID])
    for part in journal["gone"]:
        remove(spark, f"{staging}/{part}")
    remove_note(spark, staging, "journal")
    remove(spark, journal["copy"])


def _open_rows(trips: DataFrame) -> DataFrame:
    """The table without the partitions that hold treated rows only."""
    return trips.where(~F.col(BATCH_ID).cast("string").startswith(TREATED_PART)) if BATCH_ID in trips.columns else trips


def run_day(
    spark: SparkSession,
    staging: str,
    warehouse: str,
    transforms: Iterable[Transform] = DEFAULT_CHAIN,
    keys_move: bool = True,
) -> Bounds | None:
    """Enrich the untreated day into the warehouse and mark it; None if nothing is left.

    Bounds and files are read once and used throughout. If a run dies before the mark,
    the next one takes the same day again and the upsert makes that harmless.
    The earliest untreated time is sought outside the partitions of treated rows.
    ``keys_move`` is that of ``upsert_table``.
    """
    finish_mark(spark, staging)
    trips = read_table(spark, staging)
    bounds = untreated_bounds(_open_rows(trips)) if trips is not None else None
    if bounds is None:
        return None
    upsert_table(_warehouse_rows(untreated_day(trips, bounds), transforms), warehouse, keys_move=keys_move)
    mark_day(trips, staging, bounds)
    return bounds


def backfill(
    spark: SparkSession,
    staging: str,
    warehouse: str,
    start: datetime,
    end: datetime,
    transforms: Iterable[Transform] = DEFAULT_CHAIN,
    keys_move: bool = True,
) -> None:
    """Enrich event times in [start, end) again, whatever their flag, in place of what the warehouse has of them.

    Rows of the range that staging no longer holds go from the warehouse too. A trip whose event time was
    corrected into the range or out of it leaves its old place if ``keys_move``, which is that of ``upsert_table``.
    """
    rows = _warehouse_rows(backfill_range(read_table(spark, staging), start, end), transforms)
    upsert_table(rows, warehouse, keys_move=keys_move, instead_of=(start, end))
