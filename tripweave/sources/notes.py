"""Small texts beside a table: its schema, the journal of a change, the runs of its key index.

They are written and read by the driver alone, as one file that takes the place of the one before in one step.
"""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _path(spark: SparkSession, table: str, kind: str) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}.{kind}")


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_note(spark: SparkSession, table: str, kind: str, content: object) -> None:
    """Write a note or replace it; a reader sees the old one or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = _path(spark, table, kind)
    files = _files(spark, path)
    path = files.makeQualified(path)
    fresh = path.suffix(f".{uuid.uuid4().hex}")
    out = files.create(fresh)
    out.write(json.dumps(content).encode())
    out.close()
    renames = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(renames, 1)
    options[0] = renames.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(fresh, path, options)


def read_note(spark: SparkSession, table: str, kind: str) -> object | None:
    """What the note says, None if there is none."""
    path = _path(spark, table, kind)
    files = _files(spark, path)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def remove_note(spark: SparkSession, table: str, kind: str) -> None:
    path = _path(spark, table, kind)
    _files(spark, path).delete(path, True)
