"""Which parts of a staging table came from micro-batches that have since gone into marked days.

Marking a day puts the partitions of its micro-batches together, so a batch that runs again after that no longer finds
files of its own to replace. The ledger, a folder beside the table, keeps the batch and the event date of every
partition so absorbed, and a sink leaves out the rows of those dates when it is handed the batch again.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_SHAPE = "batch string, event_date date"


def _path(table: str) -> str:
    return f"{table.rstrip('/')}.absorbed"


def record(spark: SparkSession, table: str, mark: str, absorbed: list[tuple[str, str | None]]) -> None:
    """Note (batch, ISO date) of the partitions that one mark put together; noting a mark again changes nothing."""
    rows = [(batch, day and date.fromisoformat(day)) for batch, day in absorbed]
    spark.createDataFrame(rows, _SHAPE).coalesce(1).write.mode("overwrite").parquet(f"{_path(table)}/mark={mark}")


def absorbed_dates(spark: SparkSession, table: str, batch: str) -> set[date | None]:
    """The event dates at which rows of the batch lie in marked days; at most the dates of one batch."""
    try:
        noted = spark.read.schema(_SHAPE).parquet(_path(table))
        return {r.event_date for r in noted.where(F.col("batch") == batch).select("event_date").distinct().collect()}
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return set()
        raise
