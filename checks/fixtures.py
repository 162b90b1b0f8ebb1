"""Trip tables derived from the given tables, in Spark and, equally, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.schemas import RAW_TRIP


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the time as an instant and ``k``, the integer in props."""
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def _later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds * 1_000_000)


def _fare() -> Column:
    # Adding zero turns -0.0 into 0.0.
    return F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value")) + F.lit(0.0)


def _payment() -> Column:
    return F.when(F.col("event_type") == "error", "Unknown").otherwise(F.col("event_type"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event, uncleaned, with the treated flag."""
    return _events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.col("ts").alias("event_time"),
        _later(F.col("ts"), F.col("user_id")).alias("ingest_time"),
        _later(F.col("ts"), (F.col("k") - 10) * 60).alias("dropoff_time"),
        (F.col("user_id") % 20).cast("string").alias("pickup_zone"),
        F.col("k").cast("string").alias("dropoff_zone"),
        (F.col("value") * 1.60934).alias("distance_km"),
        _fare().alias("fare_usd"),
        _payment().alias("payment_type"),
        F.when((F.col("ts") < F.lit("2024-01-10").cast("timestamp")) | (F.col("event_id") % 7 == 0), "Yes").otherwise("No").alias("treated"),
    )


TRIPS_SQL = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
trips AS (
  SELECT CAST(event_id AS VARCHAR) AS ride_id,
         ts AS event_time,
         ts + to_seconds(user_id) AS ingest_time,
         ts + to_minutes(k - 10) AS dropoff_time,
         CAST(user_id % 20 AS VARCHAR) AS pickup_zone,
         CAST(k AS VARCHAR) AS dropoff_zone,
         value * 1.60934::DOUBLE AS distance_km,
         CASE WHEN event_type = 'error' THEN -value ELSE value END + 0.0::DOUBLE AS fare_usd,
         CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS payment_type,
         CASE WHEN ts < TIMESTAMP '2024-01-10' OR event_id % 7 = 0 THEN 'Yes' ELSE 'No' END AS treated
  FROM ev
)"""


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events under the raw column names; some have no pick-up time."""
    return _events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("tpep_pickup_datetime"),
        _later(F.col("ts"), (F.col("k") - 10) * 60).alias("tpep_dropoff_datetime"),
        F.col("value").alias("trip_distance"),
        _fare().alias("fare_amount"),
        (F.col("user_id") % 20).alias("PULocationID"),
        F.col("k").alias("DOLocationID"),
        _payment().alias("payment_type"),
    )


RAW_TRIPS_SQL = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
raw_trips AS (
  SELECT event_id,
         CASE WHEN event_id % 50 <> 0 THEN ts END AS tpep_pickup_datetime,
         ts + to_minutes(k - 10) AS tpep_dropoff_datetime,
         value AS trip_distance,
         CASE WHEN event_type = 'error' THEN -value ELSE value END + 0.0::DOUBLE AS fare_amount,
         user_id % 20 AS PULocationID,
         k AS DOLocationID,
         CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS payment_type
  FROM ev
)"""


def full_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the 19-column raw file layout."""
    values = {
        "VendorId": F.col("user_id") % 3,
        "tpep_pickup_datetime": F.col("ts"),
        "tpep_dropoff_datetime": _later(F.col("ts"), (F.col("k") - 10) * 60),
        "passenger_count": F.col("k") % 6,
        "trip_distance": F.col("value"),
        "RatecodeId": F.col("k") % 7,
        "store_and_fwd_flag": F.when(F.col("event_type") == "error", "Y").otherwise("N"),
        "PULocationID": F.col("user_id") % 20,
        "DOLocationID": F.col("k"),
        "fare_amount": _fare(),
        "total_amount": F.col("value") + 1,
    }
    return _events(spark, sf_dir).select(
        *[values.get(f.name, F.lit(0.5)).cast(f.dataType).alias(f.name) for f in RAW_TRIP.fields]
    )


FULL_RAW_SQL = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
full_raw AS (
  SELECT CAST(user_id % 3 AS INTEGER) AS VendorId,
         ts AS tpep_pickup_datetime,
         ts + to_minutes(k - 10) AS tpep_dropoff_datetime,
         k % 6 AS passenger_count,
         value AS trip_distance,
         k % 7 AS RatecodeId,
         CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         user_id % 20 AS PULocationID,
         k AS DOLocationID,
         CASE WHEN event_type = 'error' THEN -value ELSE value END + 0.0::DOUBLE AS fare_amount,
         0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax, 0.5::DOUBLE AS tip_amount,
         0.5::DOUBLE AS tolls_amount, 0.5::DOUBLE AS improvement_surcharge,
         value + 1 AS total_amount,
         0.5::DOUBLE AS congestion_surcharge, 0.5::DOUBLE AS airport_fee,
         0.5::DOUBLE AS cbd_congestion_fee
  FROM ev
)"""


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large trip table: one trip per line item, placed at its order's date."""
    items = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = F.col("l_shipdate").cast("timestamp")
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.unix_timestamp(shipped)).alias("ride_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        shipped.alias("dropoff_time"),
        (F.col("l_quantity") * 1.60934).alias("distance_km"),
        F.col("l_extendedprice").alias("fare_usd"),
        F.col("o_orderpriority").alias("payment_type"),
    )


LINEITEM_TRIPS_SQL = """
trips AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(l_shipdate) // 1000000) AS ride_id,
         o_orderdate AS event_time,
         l_shipdate AS dropoff_time,
         l_quantity * 1.60934::DOUBLE AS distance_km,
         l_extendedprice AS fare_usd,
         o_orderpriority AS payment_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone_name"), F.col("n_regionkey").alias("borough_id")
    )


def boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("borough_id"), F.col("r_name").alias("borough"))


DIM_ZONE_SQL = """
dim_zone AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS zone_id, n_name AS zone_name, coalesce(r_name, 'Unknown') AS borough
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def spoilt_messages(messages: DataFrame) -> DataFrame:
    """Messages of which some are spoilt, each kind chosen by the digits of its key."""
    text = F.col("value").cast("string")
    kind = F.col("key").cast("string").cast("long") % 10
    spoilt = (
        F.when(kind == 0, F.lit("no json at all"))
        .when(kind == 1, F.substring(text, 1, 40))
        .when(kind == 2, F.lit("{}"))
        .when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, F.regexp_replace(text, '"event_time":"[^"]*"', '"event_time":"NaT"'))
        .when(kind == 5, F.regexp_replace(text, '"ingest_time":"[^"]*"', '"ingest_time":null'))
        .when(kind == 6, F.concat(F.lit('{"extra":1,'), F.substr(text, F.lit(2))))
        .otherwise(text)
    )
    return messages.select("key", spoilt.cast("binary").alias("value"))


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corrected version of every trip: newer, older or equally old by turns of k."""
    shift = F.col("dropoff_zone").cast("long") - 50
    return trips(spark, sf_dir).withColumns({"ingest_time": _later(F.col("ingest_time"), shift * 60), "fare_usd": F.col("fare_usd") + 1})


def odd_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of which some have fares or distances that no total can hold, by the last digit of the drop-off zone."""
    kind = F.col("dropoff_zone").cast("long") % 10
    fares = {0: float("nan"), 1: 1e19, 2: None, 3: float("-inf")}
    distances = {3: float("inf"), 4: float("nan"), 5: -1e300}

    def spoilt(name: str, values: dict[int, float | None]) -> Column:
        out = F.col(name)
        for digit, value in values.items():
            out = F.when(kind == digit, F.lit(value).cast("double")).otherwise(out)
        return out

    return trips(spark, sf_dir).withColumns({"fare_usd": spoilt("fare_usd", fares), "distance_km": spoilt("distance_km", distances)})


def moved_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer versions of every fifth trip, some days later or earlier by turns of k, and some trips that are new."""
    days = F.col("dropoff_zone").cast("long") % 7 - 3
    fifth = updates(spark, sf_dir).where(F.col("ride_id").cast("long") % 5 == 0)
    moved = fifth.withColumns({"event_time": _later(F.col("event_time"), days * 86400), "ingest_time": _later(F.col("ingest_time"), F.lit(864000).cast("long"))})
    new = fifth.where(F.col("ride_id").cast("long") % 10 == 0).withColumn("ride_id", F.concat(F.lit("new-"), "ride_id"))
    return moved.unionByName(new)


MOVED_SQL = """
updates AS (
  SELECT * REPLACE (ingest_time + to_minutes(CAST(dropoff_zone AS BIGINT) - 50) AS ingest_time, fare_usd + 1 AS fare_usd) FROM trips
),
fifth AS (SELECT * FROM updates WHERE CAST(ride_id AS BIGINT) % 5 = 0),
moved AS (
  SELECT * REPLACE (event_time + to_days(CAST(CAST(dropoff_zone AS BIGINT) % 7 - 3 AS INTEGER)) AS event_time, ingest_time + to_days(10) AS ingest_time) FROM fifth
  UNION ALL
  SELECT * REPLACE ('new-' || ride_id AS ride_id) FROM fifth WHERE CAST(ride_id AS BIGINT) % 10 = 0
)"""
