"""Trip events as keyed JSON messages, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tripweave.functions import columns as c
from tripweave.schemas import REQUIRED_TRIP_COLUMNS, TRIP

CORRUPT = "_corrupt_record"


def encode(trips: DataFrame) -> DataFrame:
    """Key (ride id) and value (JSON of all trip columns), both as UTF-8 bytes.

    Instants are ISO text, so no precision is lost to the JSON writer's default
    milliseconds. NULL fields are written out: every message has every field.
    """
    fields = [
        c.iso_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in TRIP.fields
    ]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return trips.select(
        F.col("ride_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
    )


def decode(messages: DataFrame, schema: StructType = TRIP) -> DataFrame:
    """Messages to flat columns; message metadata is dropped.

    A message that is no JSON object gives a row of NULLs, and a bad field gives a
    NULL in that field; ``decode_checked`` tells them apart. Works on batch and
    streaming frames.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(parsed.alias("data")).select("data.*")


def decode_checked(messages: DataFrame, schema: StructType = TRIP, required: list[str] | None = None) -> DataFrame:
    """Decode with two more columns: ``raw`` text and ``reject_reason``.

    The reason is NULL for a good message, so the good and the rejected rows are
    plain filters on the result. The parse goes through a one-element explode:
    otherwise such a filter is pushed below it and parses every message again for
    each column it looks at.
    """
    required = REQUIRED_TRIP_COLUMNS if required is None else required
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    once = messages.select(text.alias("raw"), F.explode(F.array(parsed)).alias("data"))
    rows = once.select("raw", "data.*", F.col("data").isNull().alias("_no_object"))
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in required]))
    reason = (
        F.when(F.col("_no_object"), F.lit("empty"))
        .when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ",")))
    )
    return rows.withColumn("reject_reason", reason).drop("_no_object", CORRUPT)


def accepted(checked: DataFrame) -> DataFrame:
    """The good rows of ``decode_checked``."""
    return checked.where(F.col("reject_reason").isNull()).drop("raw", "reject_reason")


def quarantined(checked: DataFrame) -> DataFrame:
    """The rejected messages of ``decode_checked``, with the reason."""
    return checked.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")
