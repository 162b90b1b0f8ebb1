"""The streaming jobs: clean, stage, aggregate, de-duplicate."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tripweave.functions.columns import row_digest
from tripweave.operators.aggregates import daily_window, whole_windows, window_parts
from tripweave.operators.enrich import clean_trips
from tripweave.operators.messages import accepted, decode, decode_checked, quarantined
from tripweave.operators.treatment import flag_untreated
from tripweave.sources import ledger
from tripweave.sources.jdbc import STAGING_TABLE, write_jdbc
from tripweave.sources.notes import read_note, write_note
from tripweave.sources.scratch import staged
from tripweave.sources.tables import EVENT_DATE, on_dates, replace_partitions, table_exists, upsert_table, with_event_date

# Fixed value: the micro-batch interval.
BATCH_INTERVAL = "5 seconds"

BATCH_ID = "batch_id"
WINDOW = "window"
DAY = "window_day"
BatchSink = Callable[[DataFrame, int], None]


def clean_stream(messages: DataFrame) -> DataFrame:
    """Messages to cleaned trips: the same functions as in batch, no state, no shuffle."""
    return clean_trips(decode(messages))


def _triggered(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Start with a checkpoint; without an interval, take what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, interval: str | None = BATCH_INTERVAL
) -> StreamingQuery:
    """Append to Parquet files with the file sink's own commit log."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _triggered(writer, checkpoint, interval)


def foreach_batch(
    rows: DataFrame, sink: BatchSink, checkpoint: str, interval: str | None = BATCH_INTERVAL, mode: str = "append"
) -> StreamingQuery:
    """Hand each micro-batch and its id to ``sink``."""
    return _triggered(rows.writeStream.outputMode(mode).foreachBatch(sink), checkpoint, interval)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark gives a stream when its checkpoint is made, and keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _batch_name(checkpoint: str | None) -> Callable[[SparkSession, int], str]:
    """Names batches by stream and number, so that no other stream or checkpoint gives the same name."""
    known: list[str] = []

    def name(spark: SparkSession, batch_id: int) -> str:
        if checkpoint and not known:
            known.append(stream_id(spark, checkpoint) + "-")
        return f"{known[0] if known else ''}{batch_id}"

    return name


def staging_sink(path: str, checkpoint: str | None = None) -> BatchSink:
    """Append a batch, flagged untreated, to the staging table.

    The stream, known by its checkpoint, and the batch are a partition below the event date:
    a batch that runs again after a failure replaces its own files, and streams that share
    the table leave each other's alone. Where its rows have gone into a marked day, which the table's ledger tells, they
    are left out, so nothing is doubled or opened again. Without a checkpoint batches go by number alone. Tasks write where they are, so there is
    no shuffle and a busy date is no hot task. Small files grow with the number of
    batches: take a longer interval where seconds do not matter.
    """

    name = _batch_name(checkpoint)
    last = [-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Batches of one run come in order, so only the first of a run, or one out of order, may have been here before.
        repeated, last[0] = last[0] < 0 or batch_id <= last[0], max(last[0], batch_id)
        if batch.isEmpty():
            return
        rows = with_event_date(flag_untreated(batch)).withColumn(BATCH_ID, F.lit(name(spark, batch_id)))
        absorbed = ledger.absorbed_dates(spark, path, name(spark, batch_id)) if repeated else set()
        if absorbed:
            rows = rows.where(~on_dates(absorbed))
        replace_partitions(rows, path, [EVENT_DATE, BATCH_ID])

    return write


def checked_sink(path: str, quarantine: str, checkpoint: str | None = None) -> BatchSink:
    """Split a batch of ``decode_checked``: good trips to staging, the rest to ``quarantine``.

    Both tables repeat safely by stream and batch. The batch is kept while both are
    written, so that no message is fetched or parsed twice.
    """
    stage, name = staging_sink(path, checkpoint), _batch_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            stage(clean_trips(accepted(batch)), batch_id)
            rejected = quarantined(batch).withColumn(BATCH_ID, F.lit(name(batch.sparkSession, batch_id)))
            if not rejected.isEmpty():
                replace_partitions(rejected, quarantine, [BATCH_ID])
        finally:
            batch.unpersist()

    return write


def jdbc_sink(url: str, properties: dict[str, str], table: str = STAGING_TABLE) -> BatchSink:
    """Append a batch, flagged untreated, to a relational staging table.

    A failed write fails the batch, which then runs again: rows may arrive twice
    and the upsert into the warehouse keeps one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_jdbc(flag_untreated(batch), url, table, properties, mode="append")

    return write


def upsert_sink(path: str, keys_move: bool = True) -> BatchSink:
    """Merge a batch into a table by ride id: a trip sent again replaces its older version.

    A batch that runs again changes nothing. Each batch rewrites the dates it
    touches, so take a long interval.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            upsert_table(batch, path, keys_move=keys_move)

    return write


def stream_to_staging(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = BATCH_INTERVAL
) -> StreamingQuery:
    """Topic to staging table."""
    return foreach_batch(clean_stream(messages), staging_sink(path, checkpoint), checkpoint, interval)


def stream_with_quarantine(
    messages: DataFrame, path: str, quarantine: str, checkpoint: str, interval: str | None = BATCH_INTERVAL
) -> StreamingQuery:
    """Topic to staging table, with malformed and incomplete messages set aside."""
    return foreach_batch(decode_checked(messages), checked_sink(path, quarantine, checkpoint), checkpoint, interval)


def stream_daily_window(
    trips: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
    watermark: str | None = None,
) -> StreamingQuery:
    """Keep the daily windows of a stream up to date, late trips included.

    Update mode: a batch gives the windows it changed, and each replaces its own
    partition of the result. So the result has one row per window however long the stream runs, and a
    batch that runs again changes nothing. The state has one row per window too; with a ``watermark``
    those it has passed leave the state, and trips later than that are dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn(WINDOW, F.unix_micros("window_start")), path, [WINDOW])

    windows = daily_window(trips.withWatermark("event_time", watermark) if watermark else trips)
    return foreach_batch(windows, write, checkpoint, interval, mode="update")


def append_closed_windows(
    trips: DataFrame, path: str, checkpoint: str, interval: str | None = BATCH_INTERVAL, watermark: str = "1 hour"
) -> StreamingQuery:
    """Append each daily window once, when the watermark has passed its end; later trips of it are dropped.

    ``windows_with_amendments`` keeps them.
    """
    return append_stream(daily_window(trips.withWatermark("event_time", watermark)), path, checkpoint, interval)


def windows_with_amendments(
    trips: DataFrame, path: str, checkpoint: str, interval: str | None = BATCH_INTERVAL, watermark: timedelta = timedelta(hours=1)
) -> StreamingQuery:
    """Daily windows that are given out once, when the watermark has passed their end, and amended for trips that come later.

    Below ``path``: ``closed`` has the windows as they were closed, ``late`` the trips that came after that, ``amendments`` what these
    add to their windows, each by the batch that wrote it, and ``parts`` the sums of every batch by window, from
    which windows are closed. Nothing is dropped: ``amended_windows`` gives closed windows with all their trips.

    As in Spark's own windows the watermark of a batch is the latest event time of the batches before it less ``watermark``. It is
    noted by batch, so a batch that runs again sees the same and replaces what it wrote.
    There is no state in memory. A batch reads the parts of the windows that it closes.
    """
    delay = watermark // timedelta(microseconds=1)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = {int(k): v for k, v in (read_note(spark, path, "watermarks") or {}).items() if int(k) < batch_id}
        mark = marks.get(max(marks, default=-1))
        on_time = F.lit(True) if mark is None else F.window("event_time", "1 day").end > F.timestamp_micros(F.lit(mark))
        tagged = batch.where(F.col("event_time").isNotNull()).withColumn("_on_time", on_time)
        with staged(tagged, "late-trips") as rows:
            late = rows.where(~F.col("_on_time")).drop("_on_time")
            parts = window_parts(rows.where("_on_time")).withColumn(DAY, F.to_date("window_start"))
            for kind, part, by in (("late", late, []), ("amendments", window_parts(late), []), ("parts", parts, [DAY])):
                replace_partitions(part.withColumn(BATCH_ID, F.lit(batch_id)), f"{path}/{kind}", [*by, BATCH_ID])
            latest = rows.agg(F.max(F.unix_micros("event_time"))).first()[0]
        after = max((x for x in (mark, None if latest is None else latest - delay) if x is not None), default=None)
        if after is not None:
            done = _read_parts(spark, f"{path}/parts", [DAY])
            end = F.unix_micros("window_end")
            closing = (end <= after) if mark is None else (end > mark) & (end <= after) & (F.col(DAY) >= F.date_sub(F.timestamp_micros(F.lit(mark)).cast("date"), 1))
            closed = done.where((F.col(BATCH_ID) <= batch_id) & closing).drop(DAY, BATCH_ID)
            sums = [F.sum(c).alias(c) for c in closed.columns if c not in ("window_start", "window_end")]
            closed = closed.groupBy("window_start", "window_end").agg(*sums)
            replace_partitions(closed.withColumn(BATCH_ID, F.lit(batch_id)), f"{path}/closed", [BATCH_ID])
        # The batch before is all that one that runs again needs.
        write_note(spark, path, "watermarks", {k: v for k, v in (marks | {batch_id: after}).items() if k >= batch_id - 1})

    return foreach_batch(trips, write, checkpoint, interval)


def _read_parts(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """Sums of windows with the columns that part them; none where nothing was written."""
    nothing = spark.createDataFrame([], "event_time timestamp, fare_usd double, distance_km double")
    schema = window_parts(nothing).schema
    for column in by:
        schema = schema.add(column, "date")
    schema = schema.add(BATCH_ID, "long")
    return spark.read.schema(schema).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], schema)


def amended_windows(spark: SparkSession, path: str) -> DataFrame:
    """The closed windows of ``windows_with_amendments`` with the trips that came after, as rows of ``daily_window``."""
    closed, more = (_read_parts(spark, f"{path}/{kind}", []) for kind in ("closed", "amendments"))
    return whole_windows(closed.unionByName(more).drop(BATCH_ID))


def _fewer_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a batch with one ``_id``, the first and the first of the latest."""
    for batch in batches:
        ids = batch.column("_id").dictionary_encode().indices.to_numpy()
        first = np.unique(ids, return_index=True)[1]
        if len(first) < batch.num_rows:
            times = pc.fill_null(batch.column("event_time").cast(pa.int64()), -(1 << 63)).to_numpy()
            order = np.lexsort((-np.arange(len(ids)), times, ids))
            latest = order[np.append(ids[order][1:] != ids[order][:-1], True)]
            batch = batch.take(pa.array(np.union1d(first, latest)))
        yield batch


def dedup_stream(
    trips: DataFrame, key: str = "ride_id", watermark: str = "1 hour", salts: int = 64
) -> DataFrame:
    """One trip per key among those within the watermark of each other.

    Trips without a key count as copies only if they are equal throughout.

    A key re-sent very often would hit one state task with all its copies. So
    copies are first reduced where they are read, without state or shuffle: of each Arrow batch, some
    thousands of rows, two rows of a key go on at most. These are the first, which stays if it is in time, and the
    latest, which is in time if any is and moves the watermark as all would. There is one state, with one entry per key.
    ``salts=1`` skips the reduction; other numbers, which once set the tasks that shared a key, all mean the same.
    """
    identity = F.coalesce(F.col(key).cast("string"), row_digest(trips))
    named = trips.withColumn("_id", identity)
    if salts > 1:
        named = named.mapInArrow(_fewer_copies, named.schema)
    return named.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["_id"]).drop("_id")
