"""Event-time aggregates. They combine before the shuffle, so a hot zone or day is no hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.columns import MICROS


# Digits after the point that a value adds to a sum.
EXACT_DIGITS = 10


def _exact(name: str) -> Column:
    """A double as a decimal, so that the order of addition cannot show; null for NaN, infinities and values from 1e18 on."""
    return F.col(name).try_cast(f"decimal(28,{EXACT_DIGITS})")


def total(name: str, digits: int = 2) -> Column:
    """The exact sum of the values that have a decimal form; ``odd_values`` counts the others."""
    return F.round(F.sum(_exact(name)), digits).cast("double")


def mean(name: str, digits: int = 6) -> Column:
    """The exact total over the number of values in it, rounded half up; NULL where there are none."""
    values = F.count(_exact(name))
    return F.when(values > 0, F.round(F.sum(_exact(name)) / values, digits)).cast("double")


def odd_values(name: str) -> Column:
    """How many values are there but in no total or mean: NaN, infinities, values from 1e18 on."""
    return F.count_if(F.col(name).isNotNull() & _exact(name).isNull())


def _trip_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trips"),
        total("fare_usd").alias("revenue_usd"),
        total("distance_km").alias("distance_km"),
        mean("fare_usd").alias("avg_fare_usd"),
    ]


def _windows(trips: DataFrame, span: str, measures: list[Column]) -> DataFrame:
    grouped = trips.groupBy(F.window("event_time", span).alias("w")).agg(*measures)
    ends = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return grouped.select(*ends, *[c for c in grouped.columns if c != "w"])


def daily_window(trips: DataFrame, span: str = "1 day", report_odd: bool = False) -> DataFrame:
    """Trips, revenue and distance per tumbling event-time window.

    On a stream, put a watermark on the event time first. With ``report_odd`` two more columns
    count the fares and distances that no total can hold.
    """
    odd = [odd_values("fare_usd").alias("odd_fares"), odd_values("distance_km").alias("odd_distances")] if report_odd else []
    return _windows(trips, span, [*_trip_measures(), *odd])


def window_parts(trips: DataFrame, span: str = "1 day") -> DataFrame:
    """What ``daily_window`` is made of, as sums and counts: parts of one window can be added up (``whole_windows``)."""
    fare, distance = _exact("fare_usd"), _exact("distance_km")
    parts = [F.count(F.lit(1)).alias("trips"), F.sum(fare).alias("fares"), F.count(fare).alias("n_fares"), F.sum(distance).alias("distances")]
    return _windows(trips, span, parts)


def whole_windows(parts: DataFrame) -> DataFrame:
    """Parts of windows, added up to the rows of ``daily_window``."""
    grouped = parts.groupBy("window_start", "window_end").agg(
        F.sum("trips").alias("trips"),
        F.round(F.sum("fares"), 2).cast("double").alias("revenue_usd"),
        F.round(F.sum("distances"), 2).cast("double").alias("distance_km"),
        F.when(F.sum("n_fares") > 0, F.round(F.sum("fares") / F.sum("n_fares"), 6)).cast("double").alias("avg_fare_usd"),
    )
    return grouped


def hourly_zone_kpi(trips: DataFrame) -> DataFrame:
    """Trips, revenue and distance per event hour and pick-up zone."""
    return trips.groupBy(F.date_trunc("hour", "event_time").alias("event_hour"), "pickup_zone").agg(*_trip_measures())


def ingest_lag(trips: DataFrame, span: str = "1 day") -> DataFrame:
    """Seconds from event to ingest per event-time window, for monitoring."""
    lag_s = (F.unix_micros("ingest_time") - F.unix_micros("event_time")).cast("double") / F.lit(float(MICROS))
    grouped = (
        trips.withColumn("lag_s", lag_s)
        .groupBy(F.window("event_time", span).alias("w"))
        .agg(
            F.count("lag_s").alias("trips"),
            F.min("lag_s").alias("min_lag_s"),
            F.max("lag_s").alias("max_lag_s"),
            mean("lag_s").alias("avg_lag_s"),
        )
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), "trips", "min_lag_s", "max_lag_s", "avg_lag_s"
    )


# Bits of a lag that a sketch keeps: a bucket is at most 2^-KEPT_BITS of its values wide.
KEPT_BITS = 7


def _bucket(us: Column) -> Column:
    """The highest value of the bucket of a lag in microseconds: small ones are alone, large ones share their leading bits."""
    size = F.abs(us)
    spare = F.greatest(F.length(F.bin(size)) - (KEPT_BITS + 1), F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, spare), spare)
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), spare)
    return F.when(us < 0, -low).otherwise(low + width - 1)


def lag_sketch(trips: DataFrame, unit: str = "HOUR") -> DataFrame:
    """(window_start, bucket_us, trips): a histogram of the lag from event to ingest in every hour, or another unit of ``date_trunc``.

    Buckets are the same in all windows, so sketches of windows add up to the sketch of a longer one, and
    nothing is lost by it. A window has some thousands of buckets at most, however many trips.
    """
    lag = F.unix_micros("ingest_time") - F.unix_micros("event_time")
    rows = trips.select(F.date_trunc(unit, "event_time").alias("window_start"), _bucket(lag).alias("bucket_us")).where("bucket_us IS NOT NULL")
    return rows.groupBy("window_start", "bucket_us").agg(F.count(F.lit(1)).alias("trips"))


def merge_sketches(sketch: DataFrame, unit: str) -> DataFrame:
    """Sketches of windows as those of longer ones: of days, months, years. Reads no trip."""
    longer = sketch.withColumn("window_start", F.date_trunc(unit, "window_start"))
    return longer.groupBy("window_start", "bucket_us").agg(F.sum("trips").alias("trips"))


def sketch_quantiles(sketch: DataFrame, shares: list[float]) -> DataFrame:
    """(window_start, trips, lag_p50_s, ...): the lag that at least such a share of a window's trips do not exceed.

    It is the top of the bucket that holds the trip of that rank, so the rank is exact and the lag at most
    2^-KEPT_BITS (0.8 %) above that trip's. The windows' running totals are over buckets, not trips.
    """
    up_to = Window.partitionBy("window_start").orderBy("bucket_us").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.withColumns({"rank": F.sum("trips").over(up_to), "all": F.sum("trips").over(Window.partitionBy("window_start"))})

    def quantile(share: float) -> Column:
        reached = F.col("rank") >= F.ceil(F.col("all") * F.lit(share))
        return (F.min(F.when(reached, F.col("bucket_us"))).cast("double") / F.lit(float(MICROS))).alias(f"lag_p{share * 100:g}_s".replace(".", "_"))

    return ranked.groupBy("window_start").agg(F.sum("trips").alias("trips"), *[quantile(s) for s in shares])
