"""Parquet tables partitioned by event date: staging and warehouse."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.functions.columns import instant
from tripweave.operators.upsert import latest_per_key, upsert_latest
from tripweave.sources import key_index
from tripweave.sources.notes import read_note, remove_note, write_note
from tripweave.sources.scratch import materialise, remove, scratch_path, staged

EVENT_DATE = "event_date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for rows without a date


def with_event_date(trips: DataFrame) -> DataFrame:
    return trips.withColumn(EVENT_DATE, F.to_date("event_time"))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing has been written yet.

    An upserted table has its schema noted beside it, so that a column which only some
    dates have is read without looking into every file.
    """
    schema = read_note(spark, path, "schema")
    try:
        return (spark.read.schema(StructType.fromJson(schema)) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """Bring each partition of a table to be written into few files.

    Adaptive execution splits a hot partition and puts small ones together. Where
    it is off, as in streams with state, rows are left where they are: more files,
    but no hot task.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return df.hint("rebalance", *by) if adaptive else df


def write_table(df: DataFrame, path: str) -> None:
    """Write the whole table, replacing what is there."""
    writer = gathered(df, [EVENT_DATE]).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(EVENT_DATE).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace just the partitions that occur in ``df``; running it again changes nothing.

    ``df`` must not read from ``path``: give a staged copy.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _dates(df: DataFrame) -> set[date | None]:
    """The event dates of a table: as many as there are days, whatever its size."""
    return {r[EVENT_DATE] for r in df.select(EVENT_DATE).distinct().collect()}


def on_dates(dates: set[date | None]) -> Column:
    """Whether a row's event date is one of these."""
    known = F.col(EVENT_DATE).isin(sorted(d for d in dates if d is not None))
    return known | F.col(EVENT_DATE).isNull() if None in dates else known


def _date_text() -> Column:
    return F.coalesce(F.col(EVENT_DATE).cast("string"), F.lit(NO_DATE))


def _start_index(rows: DataFrame, path: str, key: str) -> None:
    run = key_index.write_run(key_index.entries(rows, key, _date_text()), path, rows.count())
    key_index.start(rows.sparkSession, path, key, run)


def _dates_of_keys(keys: DataFrame, path: str, key: str) -> set[date | None]:
    """The event dates where a key may lie, by the index of the table."""
    return {None if r.date == NO_DATE else date.fromisoformat(r.date) for r in key_index.dates_of(keys, path, key).collect()}


def upsert_table(
    updates: DataFrame,
    path: str,
    key: str = "ride_id",
    version: str = "ingest_time",
    keys_move: bool = True,
    instead_of: tuple[datetime, datetime] | None = None,
) -> None:
    """Merge updates into a table by event date; running it again changes nothing.

    Only dates that can change are read and rewritten: those of the
    updates, and those where an updated key now lies. An index of the keys beside the table finds the latter; it is made
    when it is first needed, and kept up by every merge that moves keys. ``keys_move=False`` does without it where a key never
    changes its date.

    With ``instead_of`` = (start, end) the updates are all there is of the event times in [start, end): the
    table's other rows of them are removed, and a date that has no rows left is emptied.

    Columns that only one side has are kept, null where missing. The merged dates are written
    apart and a journal names them before they replace the old ones; a run that died in
    between is finished by the next.
    """
    spark = updates.sparkSession
    finish_swap(spark, path)
    with staged(latest_per_key(with_event_date(updates), key, version), "upsert-updates") as newest:
        target = read_table(spark, path)
        if target is None:
            write_table(newest, path)
            write_note(spark, path, "schema", newest.schema.jsonValue())
            if keys_move:
                _start_index(newest, path, key)
            return
        dates = _dates(newest)
        replaced = F.lit(False)
        if instead_of:
            start, end = map(instant, instead_of)
            replaced = F.coalesce((F.col("event_time") >= start) & (F.col("event_time") < end), F.lit(False))
            dates |= _dates(target.where(F.col(EVENT_DATE).between(start.cast("date"), end.cast("date"))))
        if not dates:
            return
        if keys_move:
            if not key_index.exists(spark, path, key):
                _start_index(target, path, key)
            dates |= _dates_of_keys(newest, path, key)
        kept = target.where(on_dates(dates) & ~replaced)
        rows = gathered(upsert_latest(kept, newest, key, version), [EVENT_DATE])
        copy = scratch_path(spark, "upsert-merged")
        merged = materialise(rows, copy)
        emptied = [d.isoformat() if d else NO_DATE for d in dates - _dates(merged)]
        journal = {"copy": copy, "emptied": emptied, "schema": merged.schema.jsonValue()}
        if key_index.exists(spark, path, key):
            placed = merged.join(newest.select(key).distinct(), key, "left_semi")
            journal |= {"key": key, "run": key_index.write_run(key_index.entries(placed, key, _date_text()), path, newest.count())}
        write_note(spark, path, "journal", journal)
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Put the dates that a journal names in place of the old ones, if there is one; may be repeated."""
    journal = read_note(spark, path, "journal")
    if journal is None:
        return
    schema = StructType.fromJson(journal["schema"])
    merged = spark.read.schema(schema).parquet(journal["copy"])
    replace_partitions(merged, path, [EVENT_DATE])
    for emptied in journal["emptied"]:
        nothing = merged.where(F.lit(False)).drop(EVENT_DATE)
        nothing.write.mode("overwrite").parquet(f"{path}/{EVENT_DATE}={emptied}")
    write_note(spark, path, "schema", journal["schema"])
    if "run" in journal:
        key_index.add_run(spark, path, journal["key"], journal["run"])
    remove_note(spark, path, "journal")
    remove(spark, journal["copy"])
