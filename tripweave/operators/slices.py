"""Even slices of a total order: one shuffle, one slice per task.

A window over a whole table is one task, and a window per key is one task for a hot key. Here
rows are dealt to consecutive stretches of their order instead, whose ends are quantiles of a
sample, as in Spark's own range partitioning. The slice of a row is a column, so windows and
aggregates that partition by it run where the rows are, without another exchange.

The last key of the order is drawn at random. It settles nothing that shows, but lets a cut run through
many rows that are equal in all other keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"
DRAW = "__draw"

# Rows sampled per slice; Spark's range partitioning takes as many.
SAMPLES = 100


def _cuts(df: DataFrame, key: Column, slices: int) -> Column:
    """The least keys of all slices but the first, as a scalar subquery: as many as there are slices, whatever the table's size."""
    total = df.agg(F.count(F.lit(1))).scalar()
    sample = df.where(F.rand(7) * total < float(SAMPLES * slices)).agg(F.array_sort(F.collect_list(key)).alias("keys"))
    place = f"get(keys, int(floor(double(i) * size(keys) / {slices})))"
    return sample.select(F.expr(f"transform(sequence(1, {slices - 1}), i -> {place})").alias("cuts")).scalar()


def _slice_of(key: str, cuts: str, slices: int) -> Column:
    """How many cuts are not above the key, by bisection: some ten comparisons a row."""
    middle = "(s.lo + s.hi) div 2"
    step = (
        f"if(s.lo >= s.hi, s, if(get({cuts}, int({middle})) <= {key},"
        f" named_struct('lo', int({middle} + 1), 'hi', s.hi), named_struct('lo', s.lo, 'hi', int({middle}))))"
    )
    start = f"named_struct('lo', 0, 'hi', {slices - 1})"
    found = F.expr(f"aggregate(sequence(1, {(slices - 1).bit_length()}), {start}, (s, i) -> {step}, s -> s.lo)")
    return F.coalesce(found, F.lit(0))  # never null, so that no reader of the slices adds a test for it


def sliced(df: DataFrame, order: list[str], slices: int | None = None) -> DataFrame:
    """``df`` dealt to even slices of its order, ascending with nulls first; adds ``SLICE`` and ``DRAW``.

    ``slices`` defaults to the shuffle partition count. All rows of a slice come before those of the next;
    inside a slice rows have no order yet.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = df.withColumn(DRAW, F.rand(0))
    if slices == 1:
        return drawn.withColumn(SLICE, F.lit(0)).repartitionById(1, F.col(SLICE))
    key = F.struct(*[F.col(f"`{c}`") for c in order], DRAW)
    dealt = drawn.withColumns({"__key": key, "__cuts": _cuts(drawn, key, slices)})
    dealt = dealt.withColumn(SLICE, _slice_of("__key", "__cuts", slices)).drop("__key", "__cuts")
    return dealt.repartitionById(slices, F.col(SLICE))


def in_order(order: list[str], *within: str) -> Window:
    """The window of a slice's rows in their order, for each value of ``within``."""
    return Window.partitionBy(SLICE, *within).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order], DRAW)


def all_columns(df: DataFrame) -> Column:
    """True in every row, read from every column.

    Spark shares one exchange between two readers only where both need the same columns of it.
    Counting this in a summary of the slices keeps the columns there.
    """
    # Spark would not compute a hash only to see that it is no null.
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) % 2 < 2
