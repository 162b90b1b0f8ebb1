"""Raw files to a message topic."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.messages import encode
from tripweave.operators.ordering import first_n
from tripweave.operators.payload import PICKUP_FIELD, to_trips
from tripweave.sources.files import scan_trips
from tripweave.sources.notes import read_note, write_note
from tripweave.sources.scratch import remove, scratch_path
from tripweave.sources.tables import with_event_date, write_table
from tripweave.sources.topics import publish
from tripweave.streaming.replay import event_slices

JOURNAL = "replay"


def replay_messages(raw: DataFrame, max_messages: int | None = None, **mapping: object) -> DataFrame:
    """Raw trips as encoded messages in event order. Showing this is the dry run."""
    return encode(first_n(to_trips(raw, **mapping), max_messages))


def replay_to_topic(
    spark: SparkSession,
    path: str,
    fmt: str = "kafka",
    ts_field: str = PICKUP_FIELD,
    key_field: str | None = None,
    max_messages: int | None = None,
    step: timedelta = timedelta(days=1),
    out: str | None = None,
    progress: str | None = None,
    before_step: Callable[[datetime], None] | None = None,
    **options: str,
) -> None:
    """Publish all parts under a directory in event order, one ``step`` after another.

    ``max_messages`` sends the first so many only. The other ``options`` go to the sink. ``before_step`` is called with the
    start of each step before it is sent, to pace the replay.

    Tasks of one job send side by side, so order holds between steps and, by key,
    within a topic partition. The trips are first written by event date: each step
    then reads its own dates. Ingest time is when a step is sent.

    ``progress`` names a place for a journal of the steps that were sent, with their numbers of messages. A replay
    that died is taken up by the same call: steps in the journal are not sent again, and the trips are not
    mapped again. The step it died in is: a file sink keeps nothing of a write that failed, a broker may keep some,
    which have the keys they get again. A replay that is done sends nothing. Without ``progress`` there is no journal.
    """
    trips = to_trips(scan_trips(spark, path), ts_field=ts_field, key_field=key_field)
    if max_messages:
        publish(encode(first_n(trips, max_messages)), fmt, out, **options)
        return
    journal = read_note(spark, progress, JOURNAL) if progress else None
    if journal is None:
        journal = {"by_date": scratch_path(spark, "replay-by-date"), "sent": {}, "done": False}
        write_table(with_event_date(trips), journal["by_date"])
        if progress:
            write_note(spark, progress, JOURNAL, journal)
    if journal["done"]:
        return
    try:
        for start, part in event_slices(spark.read.parquet(journal["by_date"]), step):
            name = start.isoformat()
            if name in journal["sent"]:
                continue
            if before_step:
                before_step(start)
            sent = Observation()
            now = part.withColumn("ingest_time", F.current_timestamp()).observe(sent, F.count(F.lit(1)).alias("messages"))
            publish(encode(now), fmt, out, **options)
            journal["sent"][name] = sent.get["messages"]
            if progress:
                write_note(spark, progress, JOURNAL, journal)
        journal["done"] = True
        if progress:
            write_note(spark, progress, JOURNAL, journal)
    finally:
        if journal["done"] or not progress:
            remove(spark, journal["by_date"])
