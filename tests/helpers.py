"""Small hand-made trip tables."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

T0 = datetime(2024, 1, 10, 8, 0, 0)
COLUMNS = "ride_id event_time ingest_time dropoff_time pickup_zone dropoff_zone distance_km fare_usd payment_type".split()
DDL = (
    "ride_id string, event_time timestamp, ingest_time timestamp, dropoff_time timestamp, pickup_zone string, "
    "dropoff_zone string, distance_km double, fare_usd double, payment_type string"
)


def trip(ride_id="r", event=T0, minutes=10.0, ingest=None, distance=2.0, fare=10.0, payment="card", pickup="1", dropoff="2"):
    drop = None if minutes is None else event + timedelta(minutes=minutes)
    return (ride_id, event, ingest or event + timedelta(seconds=1), drop, pickup, dropoff, distance, fare, payment)


def frame(spark, rows, treated=None):
    df = spark.createDataFrame(rows, DDL)
    return df if treated is None else df.withColumn("treated", F.lit(treated))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
