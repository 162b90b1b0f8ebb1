"""Where the keys of a dated table lie, so that an upsert need not look for them in all dates.

Beside the table stand *runs*: Parquet folders of (hash of the key, its dates), parted by buckets of the hash, of about
BUCKET_KEYS keys each. Every swap adds a run with the keys that it merged. Runs are put together
when they come near the size of the one before, so there are as many as the size has digits, and a key is written
again as often. A lookup reads the buckets of the keys asked for, a hash and a date for each key in
them. It may name a date that a key has left, never miss one where it lies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.sources.notes import read_note, write_note
from tripweave.sources.scratch import remove

BUCKET_KEYS = 1_000_000
MOST_BUCKETS = 1 << 16
#: Runs are put together while the earlier is at most so many times as large.
GROWTH = 4

_ENTRY = "h bigint, dates array<string>, bucket int"


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`").cast("string"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("h"), F.lit(buckets)).cast("int")


def _folder(path: str, run: str) -> str:
    return f"{path.rstrip('/')}.keys/run-{run}"


def _kind(key: str) -> str:
    return f"key-runs-{key}"


def entries(rows: DataFrame, key: str, date_text: Column) -> DataFrame:
    """(h, dates) of every key of the rows; rows without a key have none."""
    found = rows.where(F.col(f"`{key}`").isNotNull()).select(_hash(key).alias("h"), date_text.alias("date"))
    return found.groupBy("h").agg(F.collect_set("date").alias("dates"))


def write_run(entry_rows: DataFrame, path: str, at_most: int) -> dict:
    """Write a run of ``at_most`` keys and describe it. It counts once it is listed (``add_run``)."""
    name = uuid.uuid4().hex
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * BUCKET_KEYS < at_most:
        buckets *= 2
    dealt = entry_rows.withColumn("bucket", _bucket(buckets))
    if buckets > 1:
        dealt = dealt.repartition("bucket")
    dealt.write.partitionBy("bucket").parquet(_folder(path, name))
    return {"run": name, "keys": at_most, "buckets": buckets}


def _read(spark: SparkSession, path: str, run: dict) -> DataFrame:
    return spark.read.schema(_ENTRY).parquet(_folder(path, run["run"]))


def _listed(spark: SparkSession, path: str, key: str) -> list[dict] | None:
    return read_note(spark, path, _kind(key))


def exists(spark: SparkSession, path: str, key: str) -> bool:
    return _listed(spark, path, key) is not None


def start(spark: SparkSession, path: str, key: str, run: dict) -> None:
    """Begin the index of a table that was just written or has none, with a run of all its keys."""
    write_note(spark, path, _kind(key), [run])


def add_run(spark: SparkSession, path: str, key: str, run: dict) -> None:
    """List a run, as the latest; listing it again changes nothing. Puts runs of like size together."""
    runs = _listed(spark, path, key) or []
    if run["run"] not in {r["run"] for r in runs}:
        runs = [*runs, run]
        write_note(spark, path, _kind(key), runs)
    first, size = len(runs) - 1, runs[-1]["keys"]
    while first and runs[first - 1]["keys"] <= GROWTH * size:
        first -= 1
        size += runs[first]["keys"]
    if first < len(runs) - 1:
        parts = [_read(spark, path, r).select("h", "dates", F.lit(i).alias("age")) for i, r in enumerate(runs[first:])]
        both = parts[0]
        for part in parts[1:]:
            both = both.unionByName(part)
        latest = both.groupBy("h").agg(F.max_by("dates", "age").alias("dates"))
        write_note(spark, path, _kind(key), [*runs[:first], write_run(latest, path, size)])
        for old in runs[first:]:
            remove(spark, _folder(path, old["run"]))


def dates_of(keys: DataFrame, path: str, key: str) -> DataFrame:
    """(date), as text, of all places where a key of ``keys`` may lie. Reads the buckets of these keys alone."""
    spark = keys.sparkSession
    runs = _listed(spark, path, key) or []
    asked = keys.where(F.col(f"`{key}`").isNotNull()).select(_hash(key).alias("h")).distinct()
    most = max((r["buckets"] for r in runs), default=1)
    # At most MOST_BUCKETS numbers.
    touched = {r.bucket for r in asked.select(_bucket(most).alias("bucket")).distinct().collect()} if most > 1 else {0}
    found = spark.createDataFrame([], "date string")
    for run in runs:
        wanted = sorted({b % run["buckets"] for b in touched})
        held = _read(spark, path, run)
        if len(wanted) < run["buckets"]:
            held = held.where(F.col("bucket").isin(wanted))
        found = found.unionByName(held.join(asked, "h", "left_semi").select(F.explode("dates").alias("date")))
    return found.distinct()
