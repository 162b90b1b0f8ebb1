"""Intermediate tables, in a folder every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder named by ``spark.checkpoint.dir``, or in the warehouse folder where that is unset.

    Executors share both. Paths are grouped by application, so what a finished
    application left can be cleared as a whole.
    """
    root = spark.conf.get(_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tripweave/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """A written copy: it cuts the lineage and outlives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A written copy for the length of a block.

    It is removed when the block succeeds and kept when it fails, since it may
    then hold the only whole copy of partitions that were being replaced.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    yield materialise(df, path)
    remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
