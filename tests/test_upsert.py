import os
import shutil
from datetime import timedelta

import pytest
from helpers import T0, frame, plan_of, rows_of, trip
from pyspark.sql import functions as F

from tripweave.operators.upsert import latest_per_key, upsert_latest
from tripweave.sources import tables

HOUR = timedelta(hours=1)


def test_latest_version_wins_and_ties_go_to_the_update(spark):
    target = frame(spark, [trip("a", ingest=T0, fare=1.0), trip("b", ingest=T0 + HOUR, fare=1.0), trip("c", ingest=T0, fare=9.0), trip("d", fare=1.0)])
    update = frame(spark, [trip("a", ingest=T0 + HOUR, fare=2.0), trip("b", ingest=T0, fare=2.0), trip("c", ingest=T0, fare=2.0), trip("e", fare=2.0)])
    got = {r.ride_id: r.fare_usd for r in upsert_latest(target, update).collect()}
    assert got == {"a": 2.0, "b": 1.0, "c": 2.0, "d": 1.0, "e": 2.0}


def test_rows_without_a_key_all_stay(spark):
    keyless = frame(spark, [trip(None, fare=1.0), trip(None, fare=2.0), trip(None, fare=2.0), trip("a")])
    once = upsert_latest(keyless, keyless)
    assert sorted((r.ride_id is None, r.fare_usd) for r in once.collect()) == [(False, 10.0), (True, 1.0), (True, 2.0)]
    assert rows_of(upsert_latest(once, keyless)) == rows_of(once)


def test_columns_keep_their_order_and_nulls(spark):
    df = frame(spark, [trip("a", ingest=T0, fare=None, payment=None), trip("a", ingest=T0 - HOUR, fare=3.0)])
    latest = latest_per_key(df)
    assert latest.columns == df.columns and latest.schema.names == df.schema.names
    assert latest.first().fare_usd is None


def test_a_key_with_a_third_of_all_rows_combines_before_the_shuffle(spark):
    rows = [trip("hot", ingest=T0 + timedelta(seconds=i), fare=float(i)) for i in range(300)] + [trip(f"k{i}") for i in range(600)]
    latest = latest_per_key(frame(spark, rows).repartition(4))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    got = {r.ride_id: r.fare_usd for r in latest.collect()}
    assert len(got) == 601 and got["hot"] == 299.0


def read(spark, path):
    return spark.read.parquet(path).drop("event_date")


def test_table_upsert_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "w")
    first = frame(spark, [trip("a", T0), trip("b", T0 + timedelta(days=1)), trip("c", T0 + timedelta(days=2))])
    tables.upsert_table(first, path)
    update = frame(spark, [trip("b", T0 + timedelta(days=1), ingest=T0 + timedelta(days=9), fare=5.0), trip("d", T0)])
    tables.upsert_table(update, path)
    once = rows_of(read(spark, path))
    tables.upsert_table(update, path)
    assert rows_of(read(spark, path)) == once == rows_of(upsert_latest(first, update))


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "w")
    tables.upsert_table(frame(spark, [trip("a", T0), trip("b", T0 + timedelta(days=1))]), path)
    files = sorted(os.listdir(f"{path}/event_date=2024-01-10"))
    tables.upsert_table(frame(spark, [trip("x", T0 + timedelta(days=1))]), path)
    assert sorted(os.listdir(f"{path}/event_date=2024-01-10")) == files
    assert read(spark, path).count() == 3


def test_a_key_that_changes_its_date_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "w")
    tables.upsert_table(frame(spark, [trip("a", T0), trip("b", T0 + timedelta(days=1))]), path)
    moved = frame(spark, [trip("a", T0 + timedelta(days=1), ingest=T0 + timedelta(days=9))])
    tables.upsert_table(moved, path)
    rows = {r.ride_id: str(r.event_date) for r in spark.read.parquet(path).collect()}
    assert rows == {"a": "2024-01-11", "b": "2024-01-11"} and read(spark, path).count() == 2


def test_rows_without_a_date_are_merged_too(spark, tmp_path):
    path = str(tmp_path / "w")

    def undated(fare, ingest):
        return frame(spark, [trip("a", ingest=ingest, fare=fare)]).withColumn("event_time", F.lit(None).cast("timestamp"))

    tables.upsert_table(undated(1.0, T0).unionByName(frame(spark, [trip("b")])), path)
    tables.upsert_table(undated(2.0, T0 + HOUR), path)
    assert {r.ride_id: r.fare_usd for r in read(spark, path).collect()} == {"a": 2.0, "b": 10.0}
    tables.upsert_table(frame(spark, [trip("a", ingest=T0 + 2 * HOUR, fare=3.0)]), path)
    assert {r.ride_id: r.fare_usd for r in read(spark, path).collect()} == {"a": 3.0, "b": 10.0}
    assert read(spark, path).count() == 2


def test_without_adaptive_execution_no_date_becomes_one_task(spark):
    dated = tables.with_event_date(frame(spark, [trip("a")]))
    assert "REBALANCE" in plan_of(tables.gathered(dated, ["event_date"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in plan_of(tables.gathered(dated, ["event_date"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_updates_change_nothing(spark, tmp_path):
    path = str(tmp_path / "w")
    tables.upsert_table(frame(spark, [trip("a", T0)]), path)
    tables.upsert_table(frame(spark, [trip("a", T0)]).where(F.lit(False)), path)
    assert read(spark, path).count() == 1


def test_a_swap_that_died_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "wh")
    days = [T0 + timedelta(days=d) for d in range(3)]
    tables.upsert_table(frame(spark, [trip(str(d), t) for d, t in enumerate(days)]), path)
    newer = frame(spark, [trip(str(d), t, ingest=t + timedelta(hours=1), fare=99.0) for d, t in enumerate(days)])
    replace = tables.replace_partitions

    def half(df, where, by):
        # One date is replaced and another deleted before the run dies.
        replace(df.where(F.col("event_date") == days[0].date()), where, by)
        shutil.rmtree(f"{where}/event_date={days[1].date()}")
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "replace_partitions", half)
        with pytest.raises(OSError):
            tables.upsert_table(newer, path)
    assert spark.read.parquet(path).count() == 2
    tables.upsert_table(newer, path)
    assert rows_of(spark.read.parquet(path).drop("event_date")) == rows_of(newer)


def test_columns_of_either_side_are_kept(spark, tmp_path):
    path = str(tmp_path / "wh")
    tables.upsert_table(frame(spark, [trip("a"), trip("b", T0 + timedelta(days=3))]), path)
    tables.upsert_table(frame(spark, [trip("c")]).withColumn("band", F.lit(7)), path)
    tables.upsert_table(frame(spark, [trip("d")]), path)
    got = {r.ride_id: r.band for r in tables.read_table(spark, path).collect()}
    assert got == {"a": None, "b": None, "c": 7, "d": None}
