import re
from datetime import timedelta

import pyarrow as pa
import pytest
from helpers import T0, frame, plan_of, rows_of, trip
from pyspark.sql import functions as F

from tripweave.operators import aggregates, enrich, messages, treatment
from tripweave.plans import daily_batch
from tripweave.sources import tables, topics
from tripweave.streaming import jobs, replay

DAY = timedelta(days=1)


def some_trips(spark, n=60):
    rows = [trip(str(i), T0 + timedelta(hours=i), payment="Unknown" if i % 3 else "card", fare=float(i - 20)) for i in range(n)]
    return frame(spark, rows)


def topic(spark, tmp_path, trips, name="topic", files_per_batch="1"):
    path = str(tmp_path / name)
    topics.publish(messages.encode(trips).repartition(3), "parquet", path)
    return topics.read_topic(spark, "parquet", path, maxFilesPerTrigger=files_per_batch), path


def test_stream_equals_batch(spark, tmp_path):
    trips = some_trips(spark)
    stream, _ = topic(spark, tmp_path, trips)
    cleaned = jobs.clean_stream(stream)
    assert cleaned.isStreaming
    out = str(tmp_path / "out")
    jobs.append_stream(cleaned, out, str(tmp_path / "ck"), interval=None).awaitTermination()
    assert rows_of(spark.read.schema(cleaned.schema).parquet(out)) == rows_of(enrich.clean_trips(trips))


def test_a_restart_goes_on_where_it_stopped(spark, tmp_path):
    stream, path = topic(spark, tmp_path, some_trips(spark, 10))
    staging, state = str(tmp_path / "stg"), str(tmp_path / "ck")
    jobs.stream_to_staging(stream, staging, state, interval=None).awaitTermination()
    assert spark.read.parquet(staging).count() == 10
    more = frame(spark, [trip("new", T0)])
    topics.publish(messages.encode(more), "parquet", path)
    for _ in range(2):
        jobs.stream_to_staging(stream, staging, state, interval=None).awaitTermination()
    table = spark.read.parquet(staging)
    assert table.count() == 11 and {r.treated for r in table.select("treated").distinct().collect()} == {"No"}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "stg")
    write = jobs.staging_sink(path)
    write(some_trips(spark, 30), 0)
    write(some_trips(spark, 5), 1)
    write(some_trips(spark, 30), 0)
    write(some_trips(spark, 5).where(F.lit(False)), 2)
    table = spark.read.parquet(path)
    assert {r.batch_id: r["count"] for r in table.groupBy("batch_id").count().collect()} == {0: 30, 1: 5}


def test_quarantine_stream_splits_and_repeats(spark, tmp_path):
    staging, bad = str(tmp_path / "stg"), str(tmp_path / "bad")
    good = messages.encode(some_trips(spark, 10))
    junk = spark.createDataFrame([("x", "junk"), ("y", "{}")], "key string, value string").selectExpr("binary(key) key", "binary(value) value")
    path = str(tmp_path / "topic")
    topics.publish(good.unionByName(junk), "parquet", path)
    stream = topics.read_topic(spark, "parquet", path, maxFilesPerTrigger="2")
    jobs.stream_with_quarantine(stream, staging, bad, str(tmp_path / "ck"), interval=None).awaitTermination()
    assert spark.read.parquet(staging).count() == 10
    assert sorted(r.raw for r in spark.read.parquet(bad).collect()) == ["junk", "{}"]
    write = jobs.checked_sink(staging + "2", bad + "2")
    batch = messages.decode_checked(spark.read.parquet(path))
    for _ in range(2):
        write(batch, 7)
    assert spark.read.parquet(staging + "2").count() == 10 and spark.read.parquet(bad + "2").count() == 2


def test_jdbc_sink_skips_an_empty_batch(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, *a, **k: seen.append((df.columns[-1], a, k)))
    write = jobs.jdbc_sink("jdbc:x", {})
    write(some_trips(spark, 3).where(F.lit(False)), 0)
    write(some_trips(spark, 3), 1)
    assert seen == [("treated", ("jdbc:x", "stg.rides_stream", {}), {"mode": "append"})]


def test_interval_trigger_runs(spark, tmp_path):
    stream, _ = topic(spark, tmp_path, some_trips(spark, 6))
    staging = str(tmp_path / "stg")
    query = jobs.stream_to_staging(stream, staging, str(tmp_path / "ck"), interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(staging).count() == 6


def test_windows_keep_late_trips(spark, tmp_path):
    newer, older = some_trips(spark, 60), frame(spark, [trip("late", T0 - 5 * DAY)])
    stream, path = topic(spark, tmp_path, newer)
    out, state = str(tmp_path / "win"), str(tmp_path / "ck")
    jobs.stream_daily_window(jobs.clean_stream(stream), out, state, interval=None).awaitTermination()
    topics.publish(messages.encode(older), "parquet", path)
    jobs.stream_daily_window(jobs.clean_stream(stream), out, state, interval=None).awaitTermination()
    got = spark.read.parquet(out)
    assert rows_of(got.drop(jobs.WINDOW)) == rows_of(aggregates.daily_window(enrich.clean_trips(newer.unionByName(older))))
    assert len(got.inputFiles()) == got.count()  # older results are gone


def test_a_new_checkpoint_gives_the_newest_windows(spark, tmp_path):
    out, fares = str(tmp_path / "win"), {}
    for run, fare in enumerate((1.0, 2.0)):
        stream, _ = topic(spark, tmp_path, frame(spark, [trip("a", fare=fare), trip("b", fare=fare)]), f"topic{run}")
        jobs.stream_daily_window(jobs.clean_stream(stream), out, str(tmp_path / f"ck{run}"), interval=None).awaitTermination()
        fares[fare] = [r.revenue_usd for r in spark.read.parquet(out).collect()]
    assert fares == {1.0: [2.0], 2.0: [4.0]}


def test_streams_that_share_a_table_leave_each_other_alone(spark, tmp_path):
    staging, bad = str(tmp_path / "stg"), str(tmp_path / "bad")
    for run in "xy":
        stream, path = topic(spark, tmp_path, frame(spark, [trip(run)]), "topic" + run)
        junk = spark.createDataFrame([(run, "junk " + run)], "key string, value string").selectExpr("binary(key) key", "binary(value) value")
        topics.publish(junk, "parquet", path)
        jobs.stream_with_quarantine(stream, staging, bad, str(tmp_path / run), interval=None).awaitTermination()
    assert sorted(r.ride_id for r in spark.read.parquet(staging).collect()) == ["x", "y"]
    assert sorted(r.raw for r in spark.read.parquet(bad).collect()) == ["junk x", "junk y"]


def test_append_windows_close_behind_the_watermark(spark, tmp_path):
    landing = str(tmp_path / "landing")
    replay.land_in_event_order(some_trips(spark, 96), landing)
    stream = replay.replay_stream(spark, landing, some_trips(spark, 1), files_per_batch=1)
    windows = aggregates.daily_window(stream.withWatermark("event_time", "2 days"))
    out = str(tmp_path / "win")
    jobs.append_stream(windows, out, str(tmp_path / "ck"), interval=None).awaitTermination()
    closed = {tuple(r) for r in spark.read.schema(windows.schema).parquet(out).collect()}
    every = {tuple(r) for r in aggregates.daily_window(some_trips(spark, 96)).collect()}
    assert closed and closed < every


def test_replay_lands_whole_days_in_order(spark, tmp_path):
    by_date, landing = str(tmp_path / "by-date"), str(tmp_path / "landing")
    trips = some_trips(spark, 60)
    tables.write_table(tables.with_event_date(trips), by_date)
    assert replay.land_in_event_order(spark.read.parquet(by_date), landing) == 3
    stamped = spark.read.parquet(landing).select("ride_id", "event_time", "_metadata.file_modification_time")
    by_file = stamped.groupBy("file_modification_time").agg(F.min(F.to_date("event_time")).alias("a"), F.max(F.to_date("event_time")).alias("b"))
    days = [(r.a, r.b) for r in by_file.orderBy("file_modification_time").collect()]
    assert days == sorted(days) and all(a == b for a, b in days)
    assert rows_of(spark.read.parquet(landing).drop("event_date", replay.SLICE)) == rows_of(trips)


def test_a_landing_skips_empty_days_and_can_be_run_again(spark, tmp_path):
    landing = str(tmp_path / "landing")
    trips = some_trips(spark, 30).unionByName(frame(spark, [trip("stray", T0 - 8000 * DAY)]))
    assert replay.land_in_event_order(trips, landing) == 3
    files = set(spark.read.parquet(landing).inputFiles())
    assert replay.land_in_event_order(trips, landing) == 3
    again = spark.read.parquet(landing)
    assert rows_of(again.drop(replay.SLICE)) == rows_of(trips)
    assert len(files & set(again.inputFiles())) == len(files) - len([f for f in files if f"slice={again.agg(F.max(replay.SLICE)).first()[0]}" in f])
    assert replay.land_in_event_order(trips.where(F.lit(False)), str(tmp_path / "none")) == 0


def dedup(spark, tmp_path, trips, salts):
    landing = str(tmp_path / f"landing-{salts}")
    replay.land_in_event_order(trips, landing)
    stream = replay.replay_stream(spark, landing, trips, files_per_batch=2)
    kept, out = jobs.dedup_stream(stream, watermark="2 days", salts=salts), str(tmp_path / f"out-{salts}")
    jobs.append_stream(kept, out, str(tmp_path / f"ck-{salts}"), interval=None).awaitTermination()
    return rows_of(spark.read.schema(kept.schema).parquet(out))


def test_dedup_of_a_key_with_a_third_of_all_rows(spark, tmp_path):
    once = some_trips(spark, 40)
    hot = frame(spark, [trip("hot", T0)] * 40)
    trips = once.unionByName(once).unionByName(hot)
    want = rows_of(once.unionByName(hot.distinct()))
    assert dedup(spark, tmp_path, trips, 1) == want
    assert dedup(spark, tmp_path, trips, 8) == want


def test_dedup_holds_each_key_in_one_state(spark, tmp_path):
    trips = some_trips(spark, 40)
    landing = str(tmp_path / "landing")
    replay.land_in_event_order(trips.unionByName(trips), landing)
    kept = jobs.dedup_stream(replay.replay_stream(spark, landing, trips), watermark="2 days")
    query = jobs.append_stream(kept, str(tmp_path / "out"), str(tmp_path / "ck"), interval=None)
    query.awaitTermination()
    held = [sum(s.numRowsUpdated for s in p.stateOperators) for p in query.recentProgress]
    assert sum(held) == 40 and {len(p.stateOperators) for p in query.recentProgress} == {1}


def test_copies_in_a_batch_are_reduced_to_the_first_and_the_latest():
    rows = {"_id": ["a", "b", "a", "a", "a", "b", "c", "c"], "event_time": [2, None, 5, 1, 5, None, None, 3], "n": list(range(8))}
    batch = pa.RecordBatch.from_pydict({"_id": pa.array(rows["_id"]), "event_time": pa.array(rows["event_time"], pa.timestamp("us", "UTC")), "n": pa.array(rows["n"])})
    (got,) = jobs._fewer_copies(iter([batch]))
    assert got.column("n").to_pylist() == [0, 1, 2, 6, 7]
    (got,) = jobs._fewer_copies(iter([got.slice(1, 3)]))
    assert got.column("n").to_pylist() == [1, 2, 6]
    (got,) = jobs._fewer_copies(iter([batch.slice(0, 0)]))
    assert got.num_rows == 0


def test_dedup_keeps_different_trips_without_a_key(spark, tmp_path):
    trips = frame(spark, [trip(None, fare=1.0), trip(None, fare=2.0), trip(None, fare=2.0), trip("a"), trip("a", fare=3.0)])
    got = dedup(spark, tmp_path, trips, 8)
    assert sorted((r[0] or "", r[7]) for r in got if r[0] is None) == [("", 1.0), ("", 2.0)] and len(got) == 3


def test_upsert_sink_behind_a_stateful_stream(spark, tmp_path):
    first = some_trips(spark, 30)
    newer = first.withColumns({"fare_usd": F.lit(99.0), "ingest_time": F.col("ingest_time") + F.expr("INTERVAL 1 HOUR")})
    path, table = str(tmp_path / "topic"), str(tmp_path / "wh")
    for trips in (first, newer):
        topics.publish(messages.encode(trips), "parquet", path)
    source = topics.read_topic(spark, "parquet", path, maxFilesPerTrigger="8")
    version = F.concat_ws("@", "ride_id", F.col("ingest_time").cast("string"))
    stream = jobs.dedup_stream(messages.decode(source).withColumn("copy", version), "copy", "9 days")
    jobs.foreach_batch(stream.drop("copy"), jobs.upsert_sink(table), str(tmp_path / "ck"), interval=None).awaitTermination()
    assert rows_of(spark.read.parquet(table).drop("event_date")) == rows_of(newer)


def run_all(spark, staging, warehouse):
    days = []
    while (bounds := daily_batch.run_day(spark, staging, warehouse)) is not None:
        days.append(bounds)
    return days


def test_end_to_end_topic_to_warehouse(spark, tmp_path):
    trips = some_trips(spark, 60)
    stream, _ = topic(spark, tmp_path, trips)
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    assert daily_batch.run_day(spark, staging, warehouse) is None
    jobs.stream_to_staging(stream, staging, str(tmp_path / "ck"), interval=None).awaitTermination()
    # 0..24 h, 25..49 h, 50..59 h: both ends of a day belong to it.
    assert len(run_all(spark, staging, warehouse)) == 3
    stored = spark.read.parquet(warehouse)
    want = enrich.enrich(treatment.flag_untreated(enrich.clean_trips(trips)))
    assert rows_of(stored.select(want.columns)) == rows_of(want)
    assert spark.read.parquet(staging).where("treated = 'No'").isEmpty() and spark.read.parquet(staging).count() == 60


def test_a_run_that_dies_before_the_mark_can_be_repeated(spark, tmp_path, monkeypatch):
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    jobs.staging_sink(staging)(some_trips(spark, 60), 0)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily_batch, "mark_day", die)
        try:
            daily_batch.run_day(spark, staging, warehouse)
        except OSError:
            pass
    assert spark.read.parquet(warehouse).count() == 25
    run_all(spark, staging, warehouse)
    assert spark.read.parquet(warehouse).count() == 60


def test_marking_leaves_later_batches_alone(spark, tmp_path):
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    jobs.staging_sink(staging)(some_trips(spark, 24), 0)
    seen = spark.read.parquet(staging)
    bounds = treatment.untreated_bounds(seen)
    jobs.staging_sink(staging)(frame(spark, [trip("late", T0 + timedelta(minutes=1))]), 1)
    daily_batch.mark_day(seen, staging, bounds)
    table = spark.read.parquet(staging)
    assert table.count() == 25 and [r.ride_id for r in table.where("treated = 'No'").collect()] == ["late"]
    run_all(spark, staging, str(tmp_path / "wh"))
    assert "late" in {r.ride_id for r in spark.read.parquet(str(tmp_path / "wh")).collect()}


def test_files_of_a_marked_day_follow_its_size_and_not_its_batches(spark, tmp_path):
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    write = jobs.staging_sink(staging)
    for batch in range(20):
        write(frame(spark, [trip(f"{batch}-{k}", T0 + timedelta(minutes=batch)) for k in range(3)]).repartition(3), batch)
    before = len(spark.read.parquet(staging).inputFiles())
    assert daily_batch.run_day(spark, staging, warehouse) is not None
    table = spark.read.parquet(staging)
    assert before >= 20 and len(table.inputFiles()) <= 2 and table.count() == 60
    seen = daily_batch._open_rows(table)
    assert seen.count() == 0 and re.search(r"PartitionFilters: \[[^]]*NOT StartsWith\(batch_id", plan_of(seen))
    assert daily_batch.run_day(spark, staging, warehouse) is None


def test_a_mark_that_died_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    write = jobs.staging_sink(staging)
    write(some_trips(spark, 60), 0)
    write(some_trips(spark, 10).withColumn("ride_id", F.concat(F.lit("x"), "ride_id")), 1)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily_batch, "remove", die)
        with pytest.raises(OSError):
            daily_batch.run_day(spark, staging, warehouse)
    assert spark.read.parquet(staging).count() > 70  # old and new rows lie side by side
    run_all(spark, staging, warehouse)
    table = spark.read.parquet(staging)
    assert table.count() == 70 and table.where("treated = 'No'").isEmpty() and spark.read.parquet(warehouse).count() == 70


def test_a_trip_without_a_key_is_stored_once(spark, tmp_path):
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    jobs.staging_sink(staging)(frame(spark, [trip(None, fare=1.0), trip(None, fare=2.0), trip("a")]), 0)
    run_all(spark, staging, warehouse)
    daily_batch.backfill(spark, staging, warehouse, T0, T0 + DAY)
    stored = spark.read.parquet(warehouse)
    assert stored.count() == 3 and stored.where("treated = 'Yes'").count() == 3


def test_backfill_runs_a_range_again(spark, tmp_path):
    staging, warehouse = str(tmp_path / "stg"), str(tmp_path / "wh")
    jobs.staging_sink(staging)(some_trips(spark, 60), 0)
    for _ in range(2):
        daily_batch.backfill(spark, staging, warehouse, T0 + timedelta(hours=10), T0 + timedelta(hours=20))
    assert sorted(int(r.ride_id) for r in spark.read.parquet(warehouse).collect()) == list(range(10, 20))
