"""Reading Parquet parts whose columns have types of different width.

Trip files change over the months: a column of whole numbers becomes one of longs or doubles, or is
missing. The types of a column are joined in the order byte < short < int < long < double, float < double,
so every value is kept, but for longs beyond 2^53 that meet doubles.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FRACTIONS = [T.FloatType(), T.DoubleType()]


class TypesDoNotMeet(TypeError):
    """A column has types in different parts that no wider type joins."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both, None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if all(t in _WHOLE or t in _FRACTIONS for t in (a, b)):
        return T.DoubleType()
    return None


def union_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of first appearance, each with the type that joins its types.

    Columns are the same if their names are, whatever the case, as in all of Spark.
    """
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            known = fields.get(field.name.lower())
            kind = field.dataType if known is None else wider(known.dataType, field.dataType)
            if kind is None:
                raise TypesDoNotMeet(f"column {field.name}: {known.dataType.simpleString()} and {field.dataType.simpleString()}")
            fields[field.name.lower()] = T.StructField(known.name if known else field.name, kind, True)
    return T.StructType(list(fields.values()))


#: What Spark raises where footers do not merge; of the second kind it tells Python nothing but the text.
MERGE_ERRORS = (PySparkException, Py4JJavaError)


@dataclass
class _Group:
    """Files that Spark reads with one schema."""

    files: list[str]
    schema: T.StructType

    def agrees(self, other: _Group) -> bool:
        mine = {f.name.lower(): f.dataType for f in self.schema.fields}
        return all(mine.get(f.name.lower(), f.dataType) == f.dataType for f in other.schema.fields)

    def take(self, other: _Group) -> None:
        self.files += other.files
        self.schema = union_schema([self.schema, other.schema])


def _reader(spark: SparkSession, base: str):
    return spark.read.option("basePath", base)


def types_differ(e: Exception) -> bool:
    """Whether Spark gave up merging schemas for the types of a column."""
    seen = str(e)
    return any(x in seen for x in ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "CANNOT_MERGE_DECIMAL"))


def _groups(spark: SparkSession, base: str, files: list[str]) -> list[_Group]:
    """Files in stretches of one schema: Spark merges the footers of all in one job, and where types differ, of each half.

    Types change seldom along the file names, which carry the month, so this takes few jobs for each change.
    """
    try:
        return [_Group(files, _reader(spark, base).option("mergeSchema", True).parquet(*files).schema)]
    except MERGE_ERRORS as e:
        if not types_differ(e):
            raise
    if len(files) == 1:
        raise TypesDoNotMeet(f"{files[0]} has columns that differ only in case")
    middle = len(files) // 2
    return _groups(spark, base, files[:middle]) + _groups(spark, base, files[middle:])


def read_widened(spark: SparkSession, base: str, files: list[str]) -> DataFrame:
    """The files as one table with the columns of all and types that hold the values of all; null where a file lacks a column.

    There is one scan for each set of types that occurs, so filters and columns are pushed to the files as written.
    """
    kinds: list[_Group] = []
    for group in _groups(spark, base, sorted(files)):
        same = next((k for k in kinds if k.agrees(group)), None)
        if same:
            same.take(group)
        else:
            kinds.append(group)
    target = union_schema([k.schema for k in kinds])
    tables = []
    for kind in kinds:
        held = {f.name.lower() for f in kind.schema.fields}
        rows = _reader(spark, base).schema(kind.schema).parquet(*kind.files)
        columns = [F.col(f"`{f.name}`") if f.name.lower() in held else F.lit(None) for f in target.fields]
        tables.append(rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, target.fields)]))
    out = tables[0]
    for table in tables[1:]:
        out = out.union(table)
    return out
