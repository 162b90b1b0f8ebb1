"""Lag sketches, odd values, and windows that are amended for late trips."""

import math
import random
from datetime import timedelta

import pytest
from helpers import T0, frame, rows_of, trip
from pyspark.sql import functions as F

from tripweave.operators import aggregates, marts
from tripweave.plans.replay import replay_to_topic
from tripweave.sources import topics
from tripweave.operators import messages
from tripweave.streaming import jobs

DAY = timedelta(days=1)


def lagged(spark, lags, step=timedelta(minutes=7)):
    rows = [trip(f"r{i}", T0 + i * step, ingest=T0 + i * step + timedelta(microseconds=us)) for i, us in enumerate(lags)]
    return frame(spark, rows)


def test_buckets_hold_neighbours_only(spark):
    values = sorted({s * (2**k + d) for k in range(0, 55, 3) for d in (-1, 0, 1, 5) for s in (1, -1)} | set(range(-300, 300)))
    df = spark.createDataFrame([(v,) for v in values], "us long")
    got = {r.us: r.top for r in df.select("us", aggregates._bucket(F.col("us")).alias("top")).collect()}
    assert all(v <= got[v] <= v + max(abs(v) >> 7, 0) for v in values)
    assert [got[v] for v in values] == sorted(got[v] for v in values)
    assert all(got[v] == v for v in range(-255, 256))


def test_merged_sketches_are_those_of_the_longer_window(spark):
    rng = random.Random(1)
    trips = lagged(spark, [int(rng.lognormvariate(15, 3)) - 1000 for _ in range(2000)])
    hours = aggregates.lag_sketch(trips)
    for unit in ("DAY", "MONTH"):
        assert rows_of(aggregates.merge_sketches(hours, unit)) == rows_of(aggregates.lag_sketch(trips, unit))
    twice = aggregates.merge_sketches(aggregates.merge_sketches(hours, "DAY"), "MONTH")
    assert rows_of(twice) == rows_of(aggregates.lag_sketch(trips, "MONTH"))


def test_quantiles_are_near_the_exact_ones(spark):
    rng = random.Random(2)
    lags = [int(rng.lognormvariate(16, 2)) for _ in range(3000)]
    row = aggregates.sketch_quantiles(aggregates.lag_sketch(lagged(spark, lags, timedelta(seconds=1)), "YEAR"), [0.01, 0.5, 0.9, 1.0]).first()
    exact = sorted(lags)
    for share, got in ((0.01, row.lag_p1_s), (0.5, row.lag_p50_s), (0.9, row.lag_p90_s), (1.0, row.lag_p100_s)):
        want = exact[math.ceil(share * len(exact)) - 1] / 1e6
        assert want <= got <= want * (1 + 2**-7)
    assert row.trips == 3000


def test_no_lag_no_sketch(spark):
    none = frame(spark, [trip("a")]).withColumn("ingest_time", F.lit(None).cast("timestamp"))
    assert aggregates.lag_sketch(none).count() == 0
    assert aggregates.sketch_quantiles(aggregates.lag_sketch(none), [0.5]).count() == 0


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), -math.inf, 1e19])
def test_values_without_a_decimal_form_are_counted_and_not_averaged(spark, odd):
    rows = frame(spark, [trip("a", fare=10.0), trip("b", fare=odd), trip("c", fare=None)])
    row = aggregates.daily_window(rows, report_odd=True).first()
    assert (row.trips, row.revenue_usd, row.avg_fare_usd, row.odd_fares, row.odd_distances) == (3, 10.0, 10.0, 1, 0)
    assert aggregates.hourly_zone_kpi(rows).first().avg_fare_usd == 10.0
    only = aggregates.daily_window(rows.where("ride_id = 'b'")).first()
    assert (only.trips, only.revenue_usd, only.avg_fare_usd) == (1, None, None)
    facts = rows.withColumns({"event_date": F.lit("2024-01-10"), "pickup_borough": F.lit("x"), "fare_per_km": F.col("fare_usd"), "avg_speed_kmh": F.col("fare_usd")})
    assert marts.kpi_daily(facts).first().avg_fare_per_km == 10.0


def stream_of(spark, folder, batches):
    """A stream that takes one batch after another."""
    for i, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/b={i}")
    schema = frame(spark, []).schema.add("b", "integer")
    return spark.readStream.schema(schema).option("basePath", folder).option("maxFilesPerTrigger", 1).parquet(folder).drop("b")


def late_batches():
    """Days 0 to 3, then trips of days 0 and 2, then day 4 and one more of day 0."""
    day = [[trip(f"d{d}-{i}", T0 + d * DAY + timedelta(minutes=i), fare=float(d + i)) for i in range(5)] for d in range(5)]
    late = [trip("late0", T0, fare=100.0), trip("late2", T0 + 2 * DAY, fare=200.0), trip("late3", T0 + 3 * DAY, fare=1.0)]
    return [day[0] + day[1], day[2] + day[3], late, [*day[4], trip("late0b", T0 + timedelta(hours=2), fare=None)]]


def test_closed_windows_and_amendments_are_the_whole_windows(spark, tmp_path):
    batches, path = late_batches(), str(tmp_path / "out")
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    jobs.windows_with_amendments(stream, path, str(tmp_path / "state"), interval=None).awaitTermination()
    whole = aggregates.daily_window(frame(spark, [r for b in batches for r in b]))
    closed = whole.where(F.col("window_end") <= F.lit(T0 + 4 * DAY - timedelta(hours=1)))
    assert rows_of(jobs.amended_windows(spark, path)) == rows_of(closed)
    assert closed.count() == 4
    assert sorted(r.ride_id for r in spark.read.parquet(f"{path}/late").collect()) == ["late0", "late0b", "late2"]
    given = spark.read.parquet(f"{path}/closed")
    assert given.count() == given.select("window_start").distinct().count() == 4


def test_a_batch_that_runs_again_replaces_what_it_wrote(spark, tmp_path):
    batches, path, state = late_batches(), str(tmp_path / "out"), str(tmp_path / "state")
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    real = jobs.write_note

    def dies(spark, table, kind, content):
        if kind == "watermarks" and 2 in content and not (tmp_path / "died").exists():
            (tmp_path / "died").touch()
            raise RuntimeError("died at the end of batch 2")
        real(spark, table, kind, content)

    jobs.write_note = dies
    try:
        with pytest.raises(Exception, match="died at"):
            jobs.windows_with_amendments(stream, path, state, interval=None).awaitTermination()
        jobs.windows_with_amendments(stream, path, state, interval=None).awaitTermination()
    finally:
        jobs.write_note = real
    closed = aggregates.daily_window(frame(spark, [r for b in batches for r in b])).where(F.col("window_end") <= F.lit(T0 + 4 * DAY - timedelta(hours=1)))
    assert rows_of(jobs.amended_windows(spark, path)) == rows_of(closed)


def raw_of(spark, path, days=4, per_day=6):
    rows = [trip(f"r{d}-{i}", T0 + d * DAY + timedelta(minutes=i)) for d in range(days) for i in range(per_day)]
    table = frame(spark, rows).select("ride_id", F.col("event_time").alias("tpep_pickup_datetime"), F.col("dropoff_time").alias("tpep_dropoff_datetime"))
    table.write.parquet(path)
    return sorted(r[0] for r in rows)


def test_a_replay_is_taken_up_where_it_died(spark, tmp_path):
    source, topic, progress = (str(tmp_path / x) for x in ("raw", "topic", "progress"))
    rides, begun = raw_of(spark, source), []

    def pace(start):
        begun.append(start.date().day)
        if len(begun) == 3:
            raise RuntimeError("died in step 3")

    def sent():
        return sorted(bytes(r.key).decode() for r in spark.read.parquet(topic).collect())

    options = {"key_field": "ride_id", "out": topic, "progress": progress}
    with pytest.raises(RuntimeError):
        replay_to_topic(spark, source, "parquet", before_step=pace, **options)
    assert len(sent()) == 12
    first = {r.ride_id: r.ingest_time for r in messages.decode(spark.read.parquet(topic)).collect()}
    replay_to_topic(spark, source, "parquet", before_step=lambda start: begun.append(start.date().day), **options)
    assert sent() == rides and begun == [10, 11, 12, 12, 13]
    times = {r.ride_id: r.ingest_time for r in messages.decode(spark.read.parquet(topic)).collect()}
    assert all(times[r] == t for r, t in first.items())
    assert times["r0-0"] < times["r1-0"] < times["r2-0"] < times["r3-0"]
    replay_to_topic(spark, source, "parquet", **options)
    assert sent() == rides


def test_a_replay_leaves_no_copy(spark, tmp_path, monkeypatch):
    from tripweave.plans import replay as plan

    source, copy = str(tmp_path / "raw"), tmp_path / "by-date"
    raw_of(spark, source, 2)
    monkeypatch.setattr(plan, "scratch_path", lambda *a: str(copy))
    replay_to_topic(spark, source, "parquet", key_field="ride_id", out=str(tmp_path / "topic"))
    assert not copy.exists() and topics.read_topic(spark, "parquet", str(tmp_path / "topic")).isStreaming
