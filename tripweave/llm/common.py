"""What the operators share: text identity, written intermediate tables, reading the given tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.sources.scratch import materialise, scratch_path

#: White space that separates words; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes that a Python worker is handed at once; texts can be long, and a batch has thousands of them by default.
BATCH_BYTES = 2 << 20


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, with batches for Python workers bounded by bytes in its session from now on."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def filled(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def digests(value: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes, which together name a value."""
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)


def _written(df: DataFrame, path: str) -> DataFrame:
    out = materialise(df, path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def kept(df: DataFrame, label: str) -> DataFrame:
    """A written copy in the shared folder, so that lost executors cost no earlier step.

    Shuffle files of the steps before are only removed when the driver collects
    its garbage; asking for that here keeps executors' disks from filling.
    """
    return _written(df, scratch_path(df.sparkSession, label))


class Steps:
    """Written tables that only the steps of one run need, removed once its result is written."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[str] = []

    def kept(self, df: DataFrame, label: str) -> DataFrame:
        self._paths.append(scratch_path(self._spark, label))
        return _written(df, self._paths[-1])

    def clear(self) -> None:
        for path in self._paths:
            folder = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        self._paths = []
