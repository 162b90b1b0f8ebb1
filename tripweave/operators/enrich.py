"""Cleaning, metrics, and the chain of user transforms. Batch and streaming alike."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions import columns as c

Transform = Callable[[DataFrame], DataFrame]


class TripTransform:
    """Base for transforms written as classes; plain functions do as well."""

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError(f"{type(self).__name__} must define apply")

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.apply(df)


def chain(df: DataFrame, transforms: Iterable[Transform]) -> DataFrame:
    """Apply the transforms in order. Catalyst collapses them into one projection."""
    return reduce(lambda acc, t: acc.transform(t), transforms, df)


def clean_trips(trips: DataFrame) -> DataFrame:
    """Round the distance, make refunds positive, blank the payment sentinel."""
    return trips.withColumns(
        {
            "distance_km": F.round("distance_km", c.DISTANCE_DIGITS),
            "fare_usd": F.abs("fare_usd"),
            "payment_type": c.blank_unknown(F.col("payment_type")),
        }
    )


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("duration", c.minutes_between("event_time", "dropoff_time"))


def fare_metrics(trips: DataFrame) -> DataFrame:
    """Add duration (minutes), fare per km and fare per minute."""
    fare = F.col("fare_usd")
    return with_duration(trips).withColumns(
        {
            "fare_per_km": c.per_positive(fare, F.col("distance_km"), c.FARE_RATE_DIGITS),
            "fare_per_min": c.per_positive(fare, F.col("duration"), c.FARE_RATE_DIGITS),
        }
    )


def speed_metrics(trips: DataFrame) -> DataFrame:
    """Add duration (minutes) and average speed."""
    return with_duration(trips).withColumn("avg_speed_kmh", c.speed_kmh(F.col("distance_km"), F.col("duration")))


def time_features(trips: DataFrame) -> DataFrame:
    """Add calendar features of the event time; weekdays count from 1 = Sunday."""
    t = F.col("event_time")
    return trips.withColumns(
        {
            "event_hour": F.hour(t),
            "event_weekday": F.dayofweek(t),
            "is_weekend": F.dayofweek(t).isin(1, 7),
            "event_day_start": F.date_trunc("day", t),
        }
    )


# The default order: fares first, then speed.
DEFAULT_CHAIN: tuple[Transform, ...] = (fare_metrics, speed_metrics)


def enrich(trips: DataFrame, transforms: Iterable[Transform] = DEFAULT_CHAIN) -> DataFrame:
    """The batch enrichment of cleaned trips."""
    return chain(trips, transforms)
