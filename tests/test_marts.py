from contextlib import contextmanager
from datetime import timedelta

import pytest
from helpers import T0, frame, rows_of, trip

from tripweave.operators import enrich, marts


@contextmanager
def settings(spark, **values):
    for key, value in values.items():
        spark.conf.set(key.replace("__", "."), value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key.replace("__", "."))


@pytest.fixture
def zones(spark):
    lookup = spark.createDataFrame([(i, f"zone {i}", i % 3) for i in range(50)], "zone_id int, zone_name string, borough_id int")
    boroughs = spark.createDataFrame([(0, "north"), (1, "south")], "borough_id int, borough string")
    return marts.dim_zone(lookup, boroughs)


def test_unknown_members(spark, zones):
    assert {r.borough for r in zones.collect()} == {"north", "south", "Unknown"}
    trips = enrich.enrich(frame(spark, [trip("a", pickup="1", dropoff="99"), trip("b", pickup=None, dropoff="2")]))
    facts = {r.ride_id: r for r in marts.fact_trips(trips, zones).collect()}
    assert (facts["a"].pickup_zone_name, facts["a"].dropoff_zone_name, facts["a"].dropoff_borough) == ("zone 1", "Unknown", "Unknown")
    assert (facts["b"].pickup_zone_name, facts["b"].dropoff_zone_name) == ("Unknown", "zone 2")


def test_a_hot_zone_is_split_when_zones_are_too_many_to_broadcast(spark, zones, tmp_path):
    rows = [trip(str(i), T0 + timedelta(minutes=i % 900), pickup="7" if i % 3 == 0 else str(i % 50)) for i in range(6000)]
    path, stored = str(tmp_path / "trips"), str(tmp_path / "zones")
    zones.write.parquet(stored)
    zones = spark.read.parquet(stored)
    frame(spark, rows).repartition(8).write.parquet(path)
    trips = enrich.enrich(spark.read.parquet(path))
    want = rows_of(marts.fact_trips(trips, zones, ["pickup"]))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        facts = marts.fact_trips(trips, zones, ["pickup"])
        assert rows_of(facts) == want
        plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_a_zone_listed_twice_does_not_multiply_trips(spark):
    lookup = spark.createDataFrame([(1, "b", 0), (1, "a", 1), (1, "a", 1)], "zone_id int, zone_name string, borough_id int")
    boroughs = spark.createDataFrame([(0, "north"), (1, "south")], "borough_id int, borough string")
    facts = marts.fact_trips(enrich.enrich(frame(spark, [trip("x", pickup="1", dropoff="1")])), marts.dim_zone(lookup, boroughs)).collect()
    assert [(r.pickup_zone_name, r.pickup_borough) for r in facts] == [("a", "south")]


def test_kpis_of_one_day(spark, zones):
    rows = [trip("a", minutes=30, distance=10.0, fare=20.0, pickup="0"), trip("b", minutes=0, distance=0.0, fare=None, pickup="3")]
    kpi = marts.kpi_daily(marts.fact_trips(enrich.enrich(frame(spark, rows)), zones)).collect()
    assert len(kpi) == 1
    row = kpi[0]
    assert (row.pickup_borough, row.trips, row.trips_without_fare, row.revenue_usd) == ("north", 2, 1, 20.0)
    assert (row.avg_distance_km, row.avg_fare_per_km, row.avg_speed_kmh) == (5.0, 2.0, 20.0)
