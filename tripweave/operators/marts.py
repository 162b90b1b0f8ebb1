"""Layered models: dim_zone, fact_trips, kpi_daily."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.aggregates import mean, total

UNKNOWN_ZONE = "Unknown"


def dim_zone(zones: DataFrame, boroughs: DataFrame) -> DataFrame:
    """One row per zone id with its name and borough, so that a lookup cannot multiply facts.

    ``zones`` has zone_id, zone_name, borough_id; ``boroughs`` has borough_id, borough. Of several rows
    with one id the first by name and borough counts. Facts are looked up in the stored mart: a join with the
    aggregate itself could not split a hot zone.
    """
    named = zones.join(boroughs, "borough_id", "left").select(
        F.col("zone_id").cast("string").alias("zone_id"),
        F.struct("zone_name", F.coalesce("borough", F.lit(UNKNOWN_ZONE)).alias("borough")).alias("zone"),
    )
    return named.groupBy("zone_id").agg(F.min("zone").alias("zone")).select("zone_id", "zone.zone_name", "zone.borough")


def _with_zone(trips: DataFrame, zones: DataFrame, side: str) -> DataFrame:
    named = zones.select(
        F.col("zone_id").alias(f"{side}_zone"),
        F.col("zone_name").alias(f"{side}_zone_name"),
        F.col("borough").alias(f"{side}_borough"),
    )
    return trips.join(named, f"{side}_zone", "left").fillna(UNKNOWN_ZONE, [f"{side}_zone_name", f"{side}_borough"])


def fact_trips(enriched: DataFrame, zones: DataFrame, sides: Sequence[str] = ("pickup", "dropoff")) -> DataFrame:
    """Enriched trips with event date and zones looked up on the given sides; none is lost.

    No broadcast is forced. Spark broadcasts the zones if they are below its size
    limit at run time, and otherwise splits hot zones in a sort-merge join.
    """
    facts = enriched.withColumn("event_date", F.to_date("event_time"))
    return reduce(lambda trips, side: _with_zone(trips, zones, side), sides, facts)


def kpi_daily(facts: DataFrame) -> DataFrame:
    """Daily figures per pick-up borough."""
    return facts.groupBy("event_date", "pickup_borough").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("fare_usd").isNull()).alias("trips_without_fare"),
        total("fare_usd").alias("revenue_usd"),
        mean("distance_km").alias("avg_distance_km"),
        mean("fare_per_km").alias("avg_fare_per_km"),
        mean("avg_speed_kmh").alias("avg_speed_kmh"),
    )
