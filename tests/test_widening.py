import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.sources import files, widening

BYTE, SHORT, INT, LONG, FLOAT, DOUBLE, TEXT = (
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(),
)


def test_types_meet_in_the_least_that_holds_both():
    order = [BYTE, SHORT, INT, LONG, DOUBLE]
    for i, a in enumerate(order):
        for j, b in enumerate(order):
            assert widening.wider(a, b) == order[max(i, j)]
    assert widening.wider(FLOAT, DOUBLE) == widening.wider(INT, FLOAT) == DOUBLE
    assert widening.wider(T.NullType(), TEXT) == widening.wider(TEXT, T.NullType()) == TEXT
    assert widening.wider(TEXT, INT) is None and widening.wider(T.TimestampType(), LONG) is None


def part(spark, path, n, **columns):
    spark.range(n).select(*[c.alias(k) for k, c in columns.items()]).write.mode("append").parquet(path)


def test_parts_of_int_long_double_and_without_the_column(spark, tmp_path):
    path, n = str(tmp_path / "trips"), F.col("id")
    part(spark, path, 3, a=n.cast("int"), b=F.lit("x"))
    part(spark, path, 3, a=n + 2**40)
    part(spark, path, 2, a=n + 0.5, c=n.cast("int"))
    part(spark, path, 1, b=F.lit("y"), C=n)
    table = files.scan_trips(spark, path)
    assert {f.name.lower(): f.dataType for f in table.schema.fields} == {"a": DOUBLE, "b": TEXT, "c": LONG}
    want = [(float(i), "x", None) for i in range(3)] + [(float(2**40 + i), None, None) for i in range(3)]
    want += [(0.5, None, 0), (1.5, None, 1), (None, "y", 0)]
    assert rows_of(table.select("a", "b", "c")) == sorted(want, key=repr)


def test_filters_and_columns_reach_each_scan(spark, tmp_path):
    path, n = str(tmp_path / "trips"), F.col("id")
    part(spark, path, 3, a=n.cast("int"), b=F.lit("x"), c=n)
    part(spark, path, 3, a=n, b=F.lit("y"), c=n)
    plan = plan_of(files.scan_trips(spark, path).where(F.col("c") > 1).select("a"))
    assert plan.count("FileScan parquet") == 2 and plan.count("GreaterThan(c,1)") == 2
    assert "ReadSchema: struct<a:int,c:bigint>" in plan and "b:string" not in plan


def test_few_jobs_and_one_scan_for_each_set_of_types(spark, tmp_path):
    path, n = str(tmp_path / "trips"), F.col("id")
    for i in range(6):
        (spark.range(2).select(n.cast("int" if i < 3 else "long").alias("a")).coalesce(1).write.parquet(f"{path}/m{i}"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    paths = [r.path for r in found.select("path").collect()]
    assert len(widening._groups(spark, path, sorted(paths))) <= 3
    assert plan_of(widening.read_widened(spark, path, paths)).count("FileScan parquet") == 2


def test_types_that_do_not_meet_are_told(spark, tmp_path):
    path, n = str(tmp_path / "trips"), F.col("id")
    part(spark, path, 3, a=n)
    part(spark, path, 3, a=n.cast("string"))
    with pytest.raises(widening.TypesDoNotMeet, match="column a"):
        files.scan_trips(spark, path)


def test_dated_folders_keep_their_column(spark, tmp_path):
    path, n = str(tmp_path / "trips"), F.col("id")
    spark.range(2).select(n.cast("int").alias("a"), F.lit("2024-01-01").alias("day")).write.partitionBy("day").parquet(path)
    spark.range(2).select(n.alias("a"), F.lit("2024-01-02").alias("day")).write.mode("append").partitionBy("day").parquet(path)
    table = files.scan_trips(spark, path)
    assert rows_of(table.select("a", F.col("day").cast("string"))) == [(i, d) for i in range(2) for d in ("2024-01-01", "2024-01-02")]
