import re
from datetime import timedelta

import pytest
from helpers import T0, frame, plan_of, trip
from pyspark.sql import functions as F

from tripweave.operators import ordering
from tripweave.operators.slices import SLICE, sliced


def expected(rows, speedup, floor):
    """The schedule one row at a time."""
    out, previous, clock = [], None, 0.0
    for n, (event, ride) in enumerate(sorted((r[1], r[0]) for r in rows if r[1] is not None), 1):
        gap = (event - previous).total_seconds() if previous else 0.0
        delay = max(gap / speedup, floor)
        clock += delay
        out.append((ride, n, gap, delay, clock))
        previous = event
    return out


def hot_rows():
    """A third of all rows in one instant, a third in one hour, a third spread over days."""
    rows = [trip(f"a{i:03d}", T0) for i in range(120)]
    rows += [trip(f"b{i:03d}", T0 + timedelta(seconds=7 * i + i * i % 5)) for i in range(120)]
    rows += [trip(f"c{i:03d}", T0 + timedelta(hours=i * 3, microseconds=i)) for i in range(120)]
    return rows


@pytest.mark.parametrize("slices", [1, 3, 8, 50])
@pytest.mark.parametrize("floor", [0.0, 0.05, 2.0])
def test_schedule_equals_the_loop(spark, slices, floor):
    rows = hot_rows()
    trips = frame(spark, rows).select("ride_id", "event_time")
    got = ordering.replay_schedule(trips, speedup=60.0, min_delay_s=floor, slices=slices).orderBy("seq").collect()
    want = expected(rows, 60.0, floor)
    assert [(r.ride_id, r.seq) for r in got] == [w[:2] for w in want]
    for r, w in zip(got, want):
        assert (r.gap_s, r.delay_s) == w[2:4]
        assert r.emit_offset_s == pytest.approx(w[4], abs=1e-6)


def test_one_instant_and_copies_of_one_trip_span_several_slices(spark):
    copies = [trip("same", T0 + timedelta(days=40))] * 200
    trips = frame(spark, hot_rows() + copies).select("ride_id", "event_time")
    table = sliced(trips, ordering.ORDER, 8).persist()
    for hot in (F.col("event_time") == F.lit(T0), F.col("ride_id") == "same"):
        assert table.where(hot).select(SLICE).distinct().count() > 1
    sizes = [r["count"] for r in table.groupBy(SLICE).count().collect()]
    table.unpersist()
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    got = ordering.replay_schedule(trips, speedup=60.0, min_delay_s=0.5, slices=8).orderBy("seq").collect()
    want = expected(hot_rows() + copies, 60.0, 0.5)
    assert [(r.ride_id, r.seq, r.gap_s, r.delay_s) for r in got] == [w[:4] for w in want]
    assert got[-1].emit_offset_s == pytest.approx(want[-1][4])


def test_sorting_spreads_copies_of_one_trip(spark):
    rows = frame(spark, [trip("same", T0)] * 400 + [trip(f"x{i}", T0 + timedelta(hours=i)) for i in range(400)])
    for out in (ordering.sort_by_event_time(rows), ordering.range_cut(rows)):
        assert out.columns == rows.columns and out.count() == 800
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (ordering.sort_by_event_time(rows), ordering.range_cut(rows)):
            parts = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
            assert max(r["count"] for r in parts) < 200
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_offsets_without_a_floor_telescope(spark):
    trips = frame(spark, hot_rows()).select("ride_id", "event_time")
    a = {r.ride_id: r.emit_offset_s for r in ordering.emit_offsets(trips).collect()}
    b = {r.ride_id: r.emit_offset_s for r in ordering.replay_schedule(trips).collect()}
    assert a == b


def test_rows_without_event_time_have_no_place(spark):
    rows = frame(spark, [trip("a"), trip("b")]).withColumn("event_time", F.when(F.col("ride_id") == "a", F.col("event_time")))
    assert [r.ride_id for r in ordering.replay_schedule(rows).collect()] == ["a"]
    assert [r.ride_id for r in ordering.first_n(rows).collect()] == ["a"]
    assert [r.ride_id for r in ordering.sort_by_event_time(rows).collect()] == ["a", "b"]


def test_empty_table(spark):
    empty = frame(spark, [])
    assert ordering.replay_schedule(empty).count() == 0
    assert ordering.emit_offsets(empty).count() == 0


def final_plan(df):
    """The plan as it ran, without the one that it began with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().executedPlan().toString()


def row_exchanges(plan):
    return [line for line in plan.splitlines() if "Exchange shufflepartitionid" in line and "ReusedExchange" not in line]


def test_schedule_shuffles_rows_once_and_writes_nothing(spark):
    trips = frame(spark, hot_rows()).select("ride_id", "event_time")
    for floor in (0.0, 0.05):
        before = spark.sparkContext.statusTracker().getJobIdsForGroup()
        schedule = ordering.replay_schedule(trips, min_delay_s=floor)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
        plan = final_plan(schedule)
        assert len(row_exchanges(plan)) == 1 and "ReusedExchange" in plan
        assert "rangepartitioning" not in plan and "hashpartitioning" not in plan


def test_first_n(spark):
    trips = frame(spark, hot_rows())
    order = [r[0] for r in expected(hot_rows(), 1.0, 0.0)]
    for n in (1, 119, 121, 150, 240, 359, 360, 500):
        got = ordering.first_n(trips, n)
        assert got.columns == trips.columns
        assert [r.ride_id for r in got.collect()] == order[:n]
    assert ordering.first_n(frame(spark, []), 3).count() == 0
    assert [r.ride_id for r in ordering.first_n(trips, 0).collect()] == order


def test_first_n_has_one_plan_and_runs_nothing_before_it_is_read(spark):
    trips = frame(spark, hot_rows())
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup()
    plans = [plan_of(ordering.first_n(trips, n)) for n in (1, 1000, 1001, 10**9)]
    shapes = {tuple(re.match(r"[ :+-]*(\w*)", line)[1] for line in plan.splitlines()) for plan in plans}
    assert len(shapes) == 1
    assert tracker.getJobIdsForGroup() == before


def test_first_n_of_copies_in_one_instant(spark):
    rows = [trip("same", T0)] * 500 + [trip(f"a{i:03d}", T0) for i in range(500)] + [trip("early", T0 - timedelta(microseconds=1))]
    trips = frame(spark, rows)
    for n in (1, 2, 400, 502, 700, 1001):
        got = [r.ride_id for r in ordering.first_n(trips, n).collect()]
        assert got == ["early", *sorted(r[0] for r in rows if r[0] != "early")][:n]


def test_a_very_long_floor_does_not_overflow(spark):
    trips = frame(spark, hot_rows()).select("ride_id", "event_time")
    last = ordering.replay_schedule(trips, speedup=1e6, min_delay_s=1e5, slices=8).orderBy(F.desc("seq")).first()
    assert last.emit_offset_s == pytest.approx(360 * 1e5)


def test_first_n_takes_columns_of_any_name(spark):
    rows = [trip(str(i), T0 + timedelta(seconds=i % 700)) for i in range(1500)]
    trips = frame(spark, rows).withColumn("seq", F.lit("mine")).withColumn("gap_s", F.lit(1))
    for n in (1000, 1001):
        got = ordering.first_n(trips, n)
        assert got.columns == trips.columns and got.count() == n
        assert {r.seq for r in got.select("seq").distinct().collect()} == {"mine"}
