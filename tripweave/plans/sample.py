"""A small sample of a raw trip file, written for trials."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripweave.operators.sampling import SAMPLE_ROWS, sample_to_target
from tripweave.schemas import RAW_TRIP
from tripweave.sources.files import scan_trips, write_parquet


def write_sample(
    spark: SparkSession,
    source: str,
    out: str,
    target: int = SAMPLE_ROWS,
    seed: int = 0,
    glob: str = "*.parquet",
) -> None:
    """Sample about ``target`` rows of the raw files into ``out``, replacing it."""
    write_parquet(sample_to_target(scan_trips(spark, source, RAW_TRIP, glob), target, seed), out)
