from datetime import datetime, timedelta

import pytest
from helpers import T0, frame, rows_of, trip
from pyspark.sql import functions as F

from tripweave.operators import payload
from tripweave.plans.replay import replay_messages, replay_to_topic
from tripweave.schemas import RAW_TRIP, TRIP
from tripweave.sources import files, jdbc, scratch, topics

DAY = timedelta(days=1)


def test_scan_needs_a_path_and_a_match(spark, tmp_path):
    with pytest.raises(ValueError):
        files.scan_trips(spark, None)
    (tmp_path / "empty").mkdir()
    for path in (tmp_path / "nowhere", tmp_path / "empty"):
        for schema in (None, RAW_TRIP):
            with pytest.raises(FileNotFoundError):
                files.scan_trips(spark, str(path), schema)


def test_scan_takes_part_files_only(spark, tmp_path):
    import pandas as pd

    path = str(tmp_path / "in")
    frame(spark, [trip("a"), trip("b")]).repartition(2).write.parquet(path)
    pd.DataFrame({"ride_id": ["decoy"]}).to_parquet(f"{path}/sample.parquet")
    assert sorted(r.ride_id for r in files.scan_trips(spark, path).collect()) == ["a", "b"]
    assert files.scan_trips(spark, path, TRIP).count() == 2


def test_scan_by_schema_reads_only_what_is_selected(spark, tmp_path):
    from helpers import plan_of

    path = str(tmp_path / "in")
    frame(spark, [trip("a")]).write.parquet(path)
    scan = files.scan_trips(spark, path, TRIP).select("ride_id", "fare_usd").where("fare_usd > 1")
    plan = plan_of(scan)
    assert "ReadSchema: struct<ride_id:string,fare_usd:double>" in plan and "GreaterThan(fare_usd,1.0)" in plan


def test_csv_in_other_time_formats(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("ride_id,event_time,distance_km\na,2024-01-10 08:00:00,1.5\nb,2024-01-10T08:00:00.000007,\n")
    schema = "ride_id string, event_time timestamp, distance_km double"
    rows = files.scan_csv(spark, str(path), schema).orderBy("ride_id").collect()
    assert [tuple(r) for r in rows] == [("a", T0, 1.5), ("b", T0 + timedelta(microseconds=7), None)]


def test_union_of_parts_with_different_columns(spark):
    a = frame(spark, [trip("a")])
    b = frame(spark, [trip("b")]).drop("payment_type")
    rows = {r.ride_id: r.payment_type for r in payload.union_parts([a, b]).collect()}
    assert rows == {"a": "card", "b": None}


def test_scratch_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert one.startswith(root) and one != two


class _Context:
    applicationId = "app"


class _Session:
    """Just the settings that decide on a scratch folder."""

    def __init__(self, **conf):
        self.sparkContext = _Context()
        self.conf = {"spark.sql.warehouse.dir": "store://warehouse"} | conf


def test_without_a_folder_for_checkpoints_scratch_lies_in_the_warehouse():
    assert scratch.scratch_path(_Session(), "x").startswith("store://warehouse/tripweave/app/x-")
    named = _Session(**{"spark.checkpoint.dir": "store://shared/"})
    assert scratch.scratch_path(named, "x").startswith("store://shared/tripweave/app/x-")


def test_a_staged_copy_goes_when_its_block_succeeds(spark):
    import os

    with scratch.staged(frame(spark, [trip("a")]), "x") as copy:
        folder = os.path.dirname(copy.inputFiles()[0].removeprefix("file://"))
        assert copy.count() == 1 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    try:
        with scratch.staged(frame(spark, [trip("a")]), "x") as copy:
            folder = os.path.dirname(copy.inputFiles()[0].removeprefix("file://"))
            raise OSError
    except OSError:
        assert os.path.isdir(folder)


# JDBC: no database is started; ranges run as Spark filters and calls are recorded.


def test_ranges_cover_the_day_exactly_once(spark):
    moments = [T0, T0 + timedelta(hours=1), T0 + timedelta(hours=1) - timedelta(microseconds=1), T0 + DAY, T0 + timedelta(hours=23, minutes=59)]
    outside = [T0 - timedelta(microseconds=1), T0 + DAY + timedelta(microseconds=1)]
    df = frame(spark, [trip(str(i), t) for i, t in enumerate(moments + outside)])
    for parts in (1, 7, 24):
        for splits in ((), ("ride_id < '2'", "ride_id >= '2'")):
            ranges = jdbc.range_predicates(T0, T0 + DAY, parts, splits=splits)
            assert len(ranges) == parts * max(1, len(splits))
            hits = df.select("ride_id", F.explode(F.array(*[F.expr(r) for r in ranges])).alias("hit")).where("hit").collect()
            assert sorted(h.ride_id for h in hits) == ["0", "1", "2", "3", "4"]


class _Recorder:
    """Records the calls a JDBC reader or writer would get."""

    def __init__(self, first=None):
        self.calls, self._first = [], first

    def jdbc(self, url, table, **kw):
        self.calls.append((url, table, kw))
        return self

    def mode(self, value):
        self.calls.append(("mode", value))
        return self

    def option(self, key, value):
        self.calls.append((key, value))
        return self

    def first(self):
        return {"t0": self._first}


class _Holder:
    def __init__(self, recorder):
        self.read = self.write = recorder


def test_untreated_day_is_read_in_ranges():
    rec = _Recorder(first=T0)
    jdbc.read_untreated_day(_Holder(rec), "jdbc:x", {"user": "u"})
    (_, earliest, _), (url, table, kw) = rec.calls
    assert "MIN(event_time)" in earliest and "treated = 'No'" in earliest
    assert (url, table) == ("jdbc:x", "stg.rides_stream") and kw["properties"] == {"user": "u"}
    assert kw["predicates"] == jdbc.range_predicates(T0, T0 + DAY, 24)
    assert jdbc.read_untreated_day(_Holder(_Recorder()), "jdbc:x", {}) is None


def test_write_fails_on_an_existing_table_by_default():
    rec = _Recorder()
    jdbc.write_jdbc(_Holder(rec), "jdbc:x", "warehouse", {"user": "u"})
    assert rec.calls[:2] == [("mode", "errorifexists"), ("batchsize", 1000)]


# Topics


def test_kafka_options_name_the_start():
    assert topics.kafka_options("host:1", "rides", "earliest") == {"kafka.bootstrap.servers": "host:1", "subscribe": "rides", "startingOffsets": "earliest"}


def test_replay_messages_come_in_event_order(spark, tmp_path):
    raw = frame(spark, [trip(str(i), T0 + timedelta(minutes=(i * 7) % 20)) for i in range(20)]).select(
        "ride_id", F.col("event_time").alias("tpep_pickup_datetime"), F.col("dropoff_time").alias("tpep_dropoff_datetime")
    )
    keys = [bytes(r.key).decode() for r in replay_messages(raw, key_field="ride_id").collect()]
    assert keys == sorted(map(str, range(20)), key=lambda k: int(k) * 7 % 20)
    assert [bytes(r.key).decode() for r in replay_messages(raw, 5, key_field="ride_id").collect()] == keys[:5]



def test_topic_is_filled_step_by_step(spark, tmp_path, monkeypatch):
    from tripweave.operators import messages
    from tripweave.plans import replay as plan

    raw = frame(spark, [trip(str(i), T0 + timedelta(hours=(i * 7) % 60)) for i in range(60)]).select(
        F.col("event_time").alias("tpep_pickup_datetime"), F.col("dropoff_time").alias("tpep_dropoff_datetime")
    )
    source, out = str(tmp_path / "raw"), str(tmp_path / "topic")
    raw.write.parquet(source)
    sent = []

    def record(part, fmt, path, **options):
        sent.append([r.event_time for r in messages.decode(part).collect()])
        topics.publish(part, fmt, path, **options)

    monkeypatch.setattr(plan, "publish", record)
    replay_to_topic(spark, source, "parquet", out=out)
    assert [len(s) for s in sent] == [16, 24, 20]
    moments = [t for s in sent for t in s]
    assert moments == sorted(moments)
    assert messages.decode(spark.read.parquet(out)).where("event_time is not null").count() == 60
    replay_to_topic(spark, source, "parquet", max_messages=5, out=str(tmp_path / "few"))
    assert sent[-1] == moments[:5]


def test_parquet_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([trip("a"), trip("b")], [trip("c")]):
        files.write_parquet(frame(spark, rows), path)
    assert rows_of(spark.read.parquet(path)) == [trip("c")]


def test_event_times_before_the_epoch(spark):
    old = frame(spark, [trip("a", datetime(1969, 12, 31, 23, 59, 59, 5))])
    from tripweave.operators import messages

    assert rows_of(messages.decode(messages.encode(old))) == rows_of(old)


def test_sample_plan_writes_a_typed_subset(spark, tmp_path):
    from checks import fixtures
    from tripweave.plans.sample import write_sample

    source, out = str(tmp_path / "raw"), str(tmp_path / "sample")
    fixtures.full_raw_trips(spark, "/root/testdata/sf0.001").write.parquet(source)
    for _ in range(2):
        write_sample(spark, source, out, target=200, seed=1)
    sample = spark.read.parquet(out)
    assert sample.columns == RAW_TRIP.names and 130 < sample.count() < 270
    assert sample.exceptAll(spark.read.parquet(source)).isEmpty()


def test_kafka_stream_plan_passes_its_options(spark, monkeypatch):
    from tripweave.plans import stream

    seen = {}
    monkeypatch.setattr(stream, "read_topic", lambda s, fmt, **o: seen.update(fmt=fmt, **o))
    monkeypatch.setattr(stream, "stream_to_staging", lambda m, *a: seen.update(args=a))
    stream.start_staging(spark, "host:1", "/stg", "/ck", maxOffsetsPerTrigger="10")
    assert seen == {
        "fmt": "kafka", "kafka.bootstrap.servers": "host:1", "subscribe": "rides_raw", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10", "args": ("/stg", "/ck", "5 seconds"),
    }
