"""Raw trip rows to trip events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import columns as c

# Default names of the raw time columns.
PICKUP_FIELD = "tpep_pickup_datetime"
DROPOFF_FIELD = "tpep_dropoff_datetime"


def drop_null_event_time(raw: DataFrame, ts_field: str = PICKUP_FIELD) -> DataFrame:
    """Rows that have an event time. Where it needs no parsing this reaches the scan."""
    return raw.where(c.as_timestamp(raw, ts_field).isNotNull())


def to_trips(
    raw: DataFrame,
    *,
    ts_field: str = PICKUP_FIELD,
    dropoff_field: str = DROPOFF_FIELD,
    key_field: str | None = None,
    ingest_time: Column | None = None,
) -> DataFrame:
    """Map raw trips to the nine trip-event columns in one projection.

    Columns the table lacks take their default: 0.0 for distance and fare, "" for
    zones, "unknown" for the payment type. A NULL or NaN value stays missing.
    ``ingest_time`` defaults to the current time.
    """
    distance = c.nan_to_null(c.column_or(raw, "trip_distance", 0.0).cast("double"))
    fare = c.nan_to_null(c.column_or(raw, "fare_amount", 0.0).cast("double"))
    return drop_null_event_time(raw, ts_field).select(
        c.ride_key(raw, key_field).alias("ride_id"),
        c.as_timestamp(raw, ts_field).alias("event_time"),
        (F.current_timestamp() if ingest_time is None else ingest_time).alias("ingest_time"),
        c.as_timestamp(raw, dropoff_field).alias("dropoff_time"),
        c.column_or(raw, "PULocationID", "").cast("string").alias("pickup_zone"),
        c.column_or(raw, "DOLocationID", "").cast("string").alias("dropoff_zone"),
        c.miles_to_km(distance).alias("distance_km"),
        fare.alias("fare_usd"),
        c.column_or(raw, "payment_type", c.UNKNOWN_PAYMENT).cast("string").alias("payment_type"),
    )


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All rows of the parts; a column missing from one part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
