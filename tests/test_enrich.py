from datetime import datetime

import pytest
from helpers import T0, frame, plan_of, trip
from pyspark.sql import functions as F

from tripweave.operators import enrich, payload, sampling
from tripweave.operators.quality import business_rules, freshness, in_range, not_null, not_unique


def enriched(spark, **values):
    return enrich.enrich(enrich.clean_trips(frame(spark, [trip(**values)]))).first()


def test_distance_edge_cases(spark):
    assert enriched(spark, distance=0.0).fare_per_km is None
    assert enriched(spark, distance=None).fare_per_km is None
    small = enriched(spark, distance=0.004)
    assert small.distance_km == 0.0 and small.fare_per_km is None
    assert enriched(spark, distance=2.005, fare=1.0).distance_km == 2.01


def test_duration_edge_cases(spark):
    for minutes in (0, -5, None):
        row = enriched(spark, minutes=minutes)
        assert row.fare_per_min is None and row.avg_speed_kmh is None
        assert row.duration == minutes
    row = enriched(spark, minutes=30, distance=15.0, fare=45.0)
    assert (row.duration, row.fare_per_km, row.fare_per_min, row.avg_speed_kmh) == (30.0, 3.0, 1.5, 30.0)


def test_duration_counts_whole_seconds(spark):
    start, end = datetime(2024, 1, 1, 0, 0, 0, 999999), datetime(2024, 1, 1, 0, 1, 0, 1)
    row = spark.createDataFrame([(start, end)], "event_time timestamp, dropoff_time timestamp")
    assert enrich.with_duration(row).first().duration == 1.0


def test_fare_edge_cases(spark):
    assert enriched(spark, fare=0.0).fare_per_km == 0.0
    assert enriched(spark, fare=-4.0).fare_usd == 4.0
    row = enriched(spark, fare=None)
    assert row.fare_usd is None and row.fare_per_km is None and row.fare_per_min is None


def test_payment_sentinel(spark):
    cleaned = enrich.clean_trips(frame(spark, [trip(payment=p) for p in ("unknown", "UNKNOWN", " unknown", "cash", None)]))
    assert [r.payment_type for r in cleaned.collect()] == [None, None, " unknown", "cash", None]


def test_base_transform_must_be_overridden(spark):
    with pytest.raises(NotImplementedError):
        enrich.enrich(frame(spark, [trip()]), [enrich.TripTransform()])


def test_chain_runs_in_order(spark):
    steps = [lambda d: d.withColumn("a", F.lit(1)), lambda d: d.withColumn("b", F.col("a") + 1)]
    assert enrich.chain(frame(spark, [trip()]), steps).first().b == 2


def test_enrichment_has_no_shuffle_and_no_python(spark):
    plan = plan_of(enrich.enrich(enrich.clean_trips(frame(spark, [trip()]))))
    assert "Exchange" not in plan and "Python" not in plan


RAW_DDL = "id {}, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, trip_distance double"


def raw(spark, keys, dtype):
    return spark.createDataFrame([(k, T0, T0, 1.0 + i) for i, k in enumerate(keys)], RAW_DDL.format(dtype))


def test_empty_keys_fall_back_to_a_stable_digest(spark):
    for keys, dtype in (([None, 0, 7], "long"), ([None, "", "7"], "string")):
        trips = payload.to_trips(raw(spark, keys, dtype), key_field="id")
        first = [r.ride_id for r in trips.orderBy("distance_km").collect()]
        again = [r.ride_id for r in trips.orderBy("distance_km").collect()]
        assert first == again and first[2] == "7" and len(set(first)) == 3 and len(first[0]) == 32
    assert payload.to_trips(raw(spark, ["0"], "string"), key_field="id").first().ride_id == "0"


def test_digest_tells_null_from_text(spark):
    rows = spark.createDataFrame([(T0, T0, None, "~"), (T0, T0, "~", None), (T0, T0, "", None)], "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, a string, b string")
    assert payload.to_trips(rows).select("ride_id").distinct().count() == 3


def test_missing_columns_take_defaults(spark):
    only_times = spark.createDataFrame([(T0, T0)], "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp")
    row = payload.to_trips(only_times).first()
    assert (row.distance_km, row.fare_usd, row.pickup_zone, row.dropoff_zone, row.payment_type) == (0.0, 0.0, "", "", "unknown")


def test_nan_counts_as_missing(spark):
    rows = spark.createDataFrame([(T0, T0, float("nan"))], "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, trip_distance double")
    assert payload.to_trips(rows).first().distance_km is None


def test_event_time_as_text_or_nanoseconds(spark):
    text = spark.createDataFrame([("2024-01-10 08:00:00", T0), ("no time", T0), (None, T0)], "tpep_pickup_datetime string, tpep_dropoff_datetime timestamp")
    assert [r.event_time for r in payload.to_trips(text).collect()] == [T0]
    nanos = spark.createDataFrame([(1704873600000000123, T0)], "tpep_pickup_datetime long, tpep_dropoff_datetime timestamp")
    assert payload.to_trips(nanos).first().event_time == T0


def test_null_event_time_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, ["a"], "string").write.parquet(path)
    assert "PushedFilters: [IsNotNull(tpep_pickup_datetime)]" in plan_of(payload.to_trips(spark.read.parquet(path)))


def test_samples_of_small_tables(spark):
    empty, few = frame(spark, []), frame(spark, [trip(str(i)) for i in range(5)])
    for sample in (sampling.sample_to_target, sampling.sample_by_hash, lambda d: sampling.sample_by_hash(d, "ride_id")):
        assert sample(empty).count() == 0
        assert sample(few).count() == 5


def test_quality_checks_on_hand_made_rows(spark):
    df = frame(spark, [trip("a", fare=-1.0), trip("a", fare=None, minutes=-1), trip("b", fare=5.0, distance=100.0, minutes=1)])
    assert {r.column_name: r.failures for r in not_null(df, ["fare_usd", "ride_id"]).collect()} == {"fare_usd": 1, "ride_id": 0}
    assert {r.column_name: r.failures for r in in_range(df, {"fare_usd": (0, 4), "distance_km": (None, None)}).collect()} == {"fare_usd": 2, "distance_km": 0}
    assert [tuple(r) for r in not_unique(df, ["ride_id"]).collect()] == [("a", 2)]
    assert sorted((r.ride_id, r.rule) for r in business_rules(df).collect()) == [("a", "dropoff_before_pickup"), ("b", "over_speed")]


def test_freshness_of_empty_table_is_false(spark):
    row = freshness(frame(spark, []), datetime(2024, 1, 1), 60).first()
    assert row.latest_event is None and row.is_fresh is False
