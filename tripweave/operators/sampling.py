"""Samples of about a target number of rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import HASH_SPAN, key_hash, row_digest

# Fixed value: default sample size.
SAMPLE_ROWS = 1000


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def sample_to_target(df: DataFrame, target: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """Bernoulli sample without replacement of about ``target`` rows.

    Takes a count job first. An empty table gives an empty sample.
    """
    total = df.count()
    return df.sample(withReplacement=False, fraction=min(1.0, target / total) if total else 1.0, seed=seed)


def sample_by_hash(df: DataFrame, key: Column | str | None = None, target: int = SAMPLE_ROWS) -> DataFrame:
    """About ``target`` rows chosen by a hash of the key, so a re-run keeps the same rows.

    Rows with one key are kept or left together. So the key should tell rows apart;
    without one the whole row is hashed. Where many rows are copies of each other,
    ``sample_to_target`` draws them one by one.

    The count is a scalar subquery: one plan, no separate job, no shuffle of rows.
    """
    if key is None:
        key = row_digest(df)
    elif isinstance(key, str):
        key = F.col(key)
    rows = df.agg(F.count(F.lit(1)).cast("decimal(18,0)").alias("rows")).scalar()
    # Whole numbers throughout: a ratio of doubles is too coarse for very large tables.
    return df.where(key_hash(key).cast("decimal(19,0)") * rows < F.lit(Decimal(target * HASH_SPAN)))
