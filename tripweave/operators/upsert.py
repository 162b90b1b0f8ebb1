"""Latest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import row_digest
from tripweave.schemas import TRIP

_SOURCE = "_source"


def latest_per_key(
    rows: DataFrame, key: str = "ride_id", version: str = "ingest_time", prefer: str | None = None
) -> DataFrame:
    """One row per key: the highest version, then the highest ``prefer`` column.

    Rows equal in both are settled by the remaining columns, so a re-run gives the
    same row. Rows without a key are no versions of each other: all that differ stay,
    for trips all that differ in a trip column, whatever was computed or flagged since.

    A maximum of structs combines before the shuffle, so a key with very many
    versions sends one row per task and never meets in one task as a whole.
    """
    rank = [version] + ([prefer] if prefer else [])
    rest = [c for c in rows.columns if c not in (key, *rank)]
    own = TRIP.names if set(TRIP.names) <= set(rows.columns) else [c for c in rows.columns if c != prefer]
    keyless = F.when(F.col(key).isNull(), row_digest(rows.select(*own))).alias("_keyless")
    newest = rows.groupBy(key, keyless).agg(F.max(F.struct(*rank, *rest)).alias("_row"))
    return newest.select(*[c if c == key else F.col("_row")[c].alias(c) for c in rows.columns])


def upsert_latest(
    target: DataFrame, updates: DataFrame, key: str = "ride_id", version: str = "ingest_time"
) -> DataFrame:
    """The target with the updates merged in; on equal versions the update wins.

    A column that only one side has is null in rows of the other.
    """
    both = target.withColumn(_SOURCE, F.lit(0)).unionByName(updates.withColumn(_SOURCE, F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, key, version, prefer=_SOURCE).drop(_SOURCE)
