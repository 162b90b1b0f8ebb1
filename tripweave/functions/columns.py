"""Scalar expressions over trip columns: Column in, Column out."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Conversion factor, text sentinels and rounding digits.
KM_PER_MILE = 1.60934
UNKNOWN_PAYMENT = "unknown"
DISTANCE_DIGITS = 2
FARE_RATE_DIGITS = 3
SPEED_DIGITS = 2

MICROS = 1_000_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(value: Column | datetime) -> Column:
    """A point in time as a Column; a datetime without a zone is UTC, wherever the driver runs."""
    if isinstance(value, Column):
        return value
    return F.lit(value if value.tzinfo else value.replace(tzinfo=timezone.utc))


def from_micros(micros: int) -> datetime:
    """The UTC datetime of epoch microseconds, exactly."""
    return _EPOCH + timedelta(microseconds=micros)


def column_or(df: DataFrame, name: str, default: object) -> Column:
    """The named column, or a literal where the table does not have it."""
    return F.col(name) if name in df.columns else F.lit(default)


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The named column as an instant.

    Text is parsed and integers are nanoseconds since the epoch. Text that is no
    timestamp becomes NULL rather than failing a job that reads many files.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.col(name))
    if isinstance(dtype, T.IntegralType):
        nanos = F.col(name).cast("long")
        return F.timestamp_micros(F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000)))
    return F.col(name).cast("timestamp")


def nan_to_null(c: Column) -> Column:
    """NaN counts as missing: in Spark NaN > 0 holds, so it would reach the metrics."""
    return F.when(~F.isnan(c), c)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; six fraction digits, or none when the second is whole."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts) % MICROS == 0, whole).otherwise(exact)


def miles_to_km(miles: Column) -> Column:
    return miles * F.lit(KM_PER_MILE)


def blank_unknown(payment: Column) -> Column:
    """NULL for the sentinel in any case. Surrounding blanks are significant."""
    return F.when(F.lower(payment) == UNKNOWN_PAYMENT, F.lit(None)).otherwise(payment)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes between two instants, counted in whole seconds; may be negative."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def per_positive(numerator: Column, base: Column, digits: int) -> Column:
    """``numerator / base`` rounded half up, NULL unless the base is positive."""
    return F.when(base > 0, F.round(numerator / base, digits))


def speed_kmh(distance_km: Column, minutes: Column) -> Column:
    return F.when(minutes > 0, F.round(distance_km / minutes * 60, SPEED_DIGITS))


def row_digest(df: DataFrame) -> Column:
    """Hash of a whole row, the same on every task retry.

    Columns are taken by name, instants as epoch microseconds, and NULL differs
    from every text.
    """

    def text(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))

    return F.md5(F.concat_ws("\u001f", *[text(f) for f in sorted(df.schema, key=lambda f: f.name)]))


def ride_key(df: DataFrame, key_field: str | None) -> Column:
    """The configured key as text; a row digest where it is missing, zero or empty."""
    if not key_field or key_field not in df.columns:
        return row_digest(df)
    key, dtype = F.col(key_field), df.schema[key_field].dataType
    absent = key.isNull()
    if isinstance(dtype, T.StringType):
        absent = absent | (key == "")
    elif isinstance(dtype, T.NumericType):
        absent = absent | (key == 0)
    return F.when(absent, row_digest(df)).otherwise(key.cast("string"))


HASH_SPAN = 1 << 60


def key_hash(key: Column) -> Column:
    """A fixed whole number below HASH_SPAN for each key, from its MD5. NULL counts as ""."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
