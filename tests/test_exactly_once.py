"""Micro-batches that run again after their days were marked."""

from datetime import timedelta

import pytest
from helpers import T0, frame, rows_of, trip
from pyspark.sql import functions as F

from tripweave.plans import daily_batch
from tripweave.sources import ledger
from tripweave.sources.notes import write_note
from tripweave.streaming import jobs

DAY = timedelta(days=1)


def days(n, per_day=5, start=0):
    return [trip(f"r{start + d * per_day + i}", T0 + d * DAY + timedelta(hours=i)) for d in range(n) for i in range(per_day)]


def staged(spark, path):
    return rows_of(spark.read.parquet(path).select("ride_id", "treated"))


def test_a_batch_of_a_marked_day_changes_nothing(spark, tmp_path):
    path, warehouse = str(tmp_path / "staging"), str(tmp_path / "wh")
    rows = frame(spark, days(1, 20))
    sink = jobs.staging_sink(path)
    sink(rows, 0)
    daily_batch.run_day(spark, path, warehouse)
    before = staged(spark, path)
    assert len(before) == 20 and {t for _, t in before} == {"Yes"}
    for again in (sink, jobs.staging_sink(path)):
        again(rows, 0)
        assert staged(spark, path) == before
    assert daily_batch.run_day(spark, path, warehouse) is None


def test_only_the_dates_that_were_marked_are_left_out(spark, tmp_path):
    path, warehouse = str(tmp_path / "staging"), str(tmp_path / "wh")
    rows = frame(spark, days(4))
    jobs.staging_sink(path)(rows, 0)
    daily_batch.run_day(spark, path, warehouse)
    before = staged(spark, path)
    jobs.staging_sink(path)(rows, 0)
    assert staged(spark, path) == before
    marked = ledger.absorbed_dates(spark, path, "0")
    assert len(marked) == 2  # the batch reaches one day from 8 o'clock
    while daily_batch.run_day(spark, path, warehouse):
        jobs.staging_sink(path)(rows, 0)
    assert len(staged(spark, path)) == 20 and {t for _, t in staged(spark, path)} == {"Yes"}


def test_other_batches_and_other_streams_are_not_left_out(spark, tmp_path):
    path, warehouse = str(tmp_path / "staging"), str(tmp_path / "wh")
    jobs.staging_sink(path)(frame(spark, days(1)), 0)
    daily_batch.run_day(spark, path, warehouse)
    jobs.staging_sink(path)(frame(spark, days(1, start=100)), 1)
    assert len(staged(spark, path)) == 10
    assert ledger.absorbed_dates(spark, path, "1") == set()
    bounds = daily_batch.run_day(spark, path, warehouse)
    assert bounds is not None and {t for _, t in staged(spark, path)} == {"Yes"}


def test_a_batch_between_the_journal_and_its_end(spark, tmp_path, monkeypatch):
    """A run dies once its journal is written; the batch comes again; the next run finishes the mark."""
    path, warehouse = str(tmp_path / "staging"), str(tmp_path / "wh")
    rows = frame(spark, days(1))
    jobs.staging_sink(path)(rows, 0)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(daily_batch.ledger, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        daily_batch.run_day(spark, path, warehouse)
    jobs.staging_sink(path)(rows, 0)
    assert daily_batch.run_day(spark, path, warehouse) is None
    assert staged(spark, path) == [(f"r{i}", "Yes") for i in range(5)]
    jobs.staging_sink(path)(rows, 0)
    assert len(staged(spark, path)) == 5


def test_restarted_stream_repeats_its_last_batch(spark, tmp_path):
    """The stream fails after its sink wrote and before its commit, and a daily run comes between."""
    source, path, state, warehouse = (str(tmp_path / x) for x in ("in", "staging", "state", "wh"))
    rows = frame(spark, days(1, 20))
    rows.coalesce(2).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    write = jobs.staging_sink(path, state)

    def dies(batch, batch_id):
        write(batch, batch_id)
        daily_batch.run_day(spark, path, warehouse)
        raise RuntimeError("died before the commit")

    with pytest.raises(Exception, match="died"):
        jobs.foreach_batch(stream, dies, state, interval=None).awaitTermination()
    assert len(staged(spark, path)) == 20
    jobs.foreach_batch(stream, jobs.staging_sink(path, state), state, interval=None).awaitTermination()
    assert len(staged(spark, path)) == 20 and {t for _, t in staged(spark, path)} == {"Yes"}


def test_notes_replace_each_other(spark, tmp_path):
    from tripweave.sources.notes import read_note, remove_note

    table = str(tmp_path / "t")
    assert read_note(spark, table, "journal") is None
    for content in ({"a": [1, "é"]}, [], {"b": "x" * 100_000}):
        write_note(spark, table, "journal", content)
        assert read_note(spark, table, "journal") == content
    remove_note(spark, table, "journal")
    remove_note(spark, table, "journal")
    assert read_note(spark, table, "journal") is None
    assert F.lit(1) is not None and not list(tmp_path.glob("t.journal.*"))
