"""Relations the engine works on."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and nullability of the raw trip files, of one
# trip event, and of a keyed message.
_RAW_TRIP_COLUMNS = """
    VendorId int
    tpep_pickup_datetime timestamp
    tpep_dropoff_datetime timestamp
    passenger_count bigint
    trip_distance double
    RatecodeId bigint
    store_and_fwd_flag string
    PULocationID bigint
    DOLocationID bigint
    fare_amount double
    extra double
    mta_tax double
    tip_amount double
    tolls_amount double
    improvement_surcharge double
    total_amount double
    congestion_surcharge double
    airport_fee double
    cbd_congestion_fee double
"""
_TRIP_COLUMNS = """
    ride_id string
    event_time timestamp
    ingest_time timestamp
    dropoff_time timestamp
    pickup_zone string
    dropoff_zone string
    distance_km double
    fare_usd double
    payment_type string
"""
REQUIRED_TRIP_COLUMNS = ["ride_id", "event_time", "ingest_time", "dropoff_time"]

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str, required: list[str] | None = None) -> T.StructType:
    pairs = [line.split() for line in columns.strip().splitlines()]
    return T.StructType([T.StructField(n, _TYPES[t], required is not None and n not in required) for n, t in pairs])


RAW_TRIP = _struct(_RAW_TRIP_COLUMNS)
TRIP = _struct(_TRIP_COLUMNS, REQUIRED_TRIP_COLUMNS)
MESSAGE = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])
