"""File sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripweave.sources.widening import MERGE_ERRORS, read_widened, types_differ

# Fixed value: file name pattern of trip parts.
PART_GLOB = "part*.parquet"


def scan_trips(
    spark: SparkSession, path: str | None, schema: StructType | None = None, glob: str = PART_GLOB
) -> DataFrame:
    """All Parquet parts under a directory as one table, with the columns of all parts.

    A part without a column gives nulls for it. Where parts hold a column in types of different width, as
    int, long and double, all are read as the widest. Raises ValueError without a path and FileNotFoundError if no file matches.
    """
    if not path:
        raise ValueError("no input path given")
    reader = spark.read.option("pathGlobFilter", glob)
    # Only the listing is used, as no file content is selected.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    try:
        if schema is None:
            try:
                return reader.option("mergeSchema", True).parquet(path)
            except MERGE_ERRORS as e:
                if not types_differ(e):
                    raise
            return read_widened(spark, path, [r.path for r in listing.load(path).select("path").collect()])
        # With a schema Spark does not open a file, so look for one.
        found = not listing.load(path).select("path").isEmpty()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no {glob} under {path}") from e
        raise
    if not found:
        raise FileNotFoundError(f"no {glob} under {path}")
    return reader.schema(schema).parquet(path)


def scan_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, read by a given schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; instants keep their microseconds."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    df.write.mode("overwrite").option("header", True).option("timestampFormat", micros).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a table, replacing what is there."""
    df.write.mode("overwrite").parquet(path)
