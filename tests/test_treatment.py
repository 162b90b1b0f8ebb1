from datetime import datetime, timedelta, timezone

from helpers import T0, frame, plan_of, trip
from pyspark.sql import functions as F

from tripweave.operators import treatment
from tripweave.sources import tables

DAY = timedelta(days=1)
MICRO = timedelta(microseconds=1)


def staged(spark):
    rows = [
        trip("before", T0 - MICRO),
        trip("start", T0),
        trip("inside", T0 + timedelta(hours=3)),
        trip("end", T0 + DAY),
        trip("after", T0 + DAY + MICRO),
    ]
    flag = F.when(F.col("ride_id").isin("before", "inside"), "Yes").otherwise("No")
    return frame(spark, rows).withColumn("treated", flag)


def ids(df):
    return sorted(r.ride_id for r in df.collect())


def test_day_includes_both_ends_and_treated_rows(spark):
    df = staged(spark)
    bounds = treatment.untreated_bounds(df)
    assert bounds == (T0.replace(tzinfo=timezone.utc), (T0 + DAY).replace(tzinfo=timezone.utc))
    assert ids(treatment.untreated_day(df)) == ids(treatment.untreated_day(df, bounds)) == ["end", "inside", "start"]


def test_marking_moves_the_day_on(spark):
    marked = treatment.mark_treated(staged(spark))
    assert {r.ride_id: r.treated for r in marked.collect()} == {"before": "Yes", "start": "Yes", "inside": "Yes", "end": "Yes", "after": "No"}
    assert ids(treatment.untreated_day(marked)) == ["after"]
    done = treatment.mark_treated(marked)
    assert treatment.untreated_bounds(done) is None
    assert ids(treatment.untreated_day(done)) == []
    assert {r.treated for r in treatment.mark_treated(done).collect()} == {"Yes"}


def test_backfill_is_half_open_and_in_utc(spark):
    df = staged(spark)
    assert ids(treatment.backfill_range(df, T0, T0 + DAY)) == ["inside", "start"]
    later = datetime(2024, 1, 10, 10, tzinfo=timezone(timedelta(hours=2)))
    assert ids(treatment.backfill_range(df, later, later + DAY)) == ["inside", "start"]


def test_filters_reach_a_dated_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(tables.with_event_date(staged(spark)), path)
    table = spark.read.parquet(path)
    literal = plan_of(treatment.untreated_day(table, treatment.untreated_bounds(table)))
    assert "GreaterThanOrEqual(event_time" in literal and "LessThanOrEqual(event_time" in literal
    assert "event_date" in literal.split("PartitionFilters: [")[1].split("]")[0]
    lazy = plan_of(treatment.untreated_day(table))
    assert "GreaterThanOrEqual(event_time,ScalarSubquery" in lazy
    assert ids(treatment.untreated_day(table)) == ["end", "inside", "start"]
