"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from tripweave.functions.columns import instant
from tripweave.operators import aggregates, enrich, marts, messages, ordering, payload, quality, sampling, treatment, upsert
from tripweave.plans import daily_batch
from tripweave.plans import replay as replay_plan
from tripweave.schemas import RAW_TRIP
from tripweave.sources import files, jdbc, tables, topics
from tripweave.sources.scratch import scratch_path
from tripweave.streaming import jobs, replay

Query = Callable[[SparkSession, str], DataFrame]

INGEST = datetime(2024, 2, 1)
LANDING_STEP = timedelta(days=5)


def portable(df: DataFrame) -> DataFrame:
    """The result with types that read the same from any engine and any client zone."""

    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.BinaryType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trips(spark, sf_dir).drop("treated")


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.clean_trips(fx.trips(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(_cleaned(spark, sf_dir))


# Sources and sinks


def scan_trips_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-trips")
    files.write_parquet(fx.raw_trips(spark, sf_dir), path)
    return files.scan_trips(spark, path)


def scan_trips_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-trips")
    files.write_parquet(fx.full_raw_trips(spark, sf_dir), path)
    return files.scan_trips(spark, path, RAW_TRIP)


def scan_trips_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with different columns: even events lack the distance and odd ones the payment type."""
    path, raw = scratch_path(spark, "raw-trips"), fx.raw_trips(spark, sf_dir)
    for left, missing in ((0, "trip_distance"), (1, "payment_type")):
        raw.where(F.col("event_id") % 2 == left).drop(missing).write.mode("append").parquet(path)
    return files.scan_trips(spark, path)


def scan_trips_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts where one zone is int, long or double, the other long, missing or int, and the distance double, double or int."""
    path, raw = scratch_path(spark, "raw-trips"), fx.raw_trips(spark, sf_dir)
    pickup, dropoff = F.col("PULocationID"), F.col("DOLocationID")
    kinds = (
        {"PULocationID": pickup.cast("int")},
        {"PULocationID": pickup.cast("double"), "DOLocationID": None},
        {"DOLocationID": dropoff.cast("int"), "trip_distance": F.floor("trip_distance").cast("int")},
    )
    for left, kind in enumerate(kinds):
        part = raw.where(F.col("event_id") % 3 == left).drop(*[c for c, value in kind.items() if value is None])
        part.withColumns({c: value for c, value in kind.items() if value is not None}).write.mode("append").parquet(path)
    return files.scan_trips(spark, path)


def parquet_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwritten")
    files.write_parquet(fx.updates(spark, sf_dir), path)
    files.write_parquet(fx.trips(spark, sf_dir), path)
    return spark.read.parquet(path)


def csv_source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    trips = fx.trips(spark, sf_dir)
    files.write_csv(trips, path)
    return files.scan_csv(spark, path, trips.schema)


def jdbc_read_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each parallel range of a database read would fetch."""
    trips = fx.trips(spark, sf_dir)
    bounds = treatment.untreated_bounds(trips)
    if bounds is None:
        return spark.createDataFrame([], "range_no INT, trips BIGINT")
    ranges = jdbc.range_predicates(*bounds)
    hits = F.array_compact(F.array(*[F.when(F.expr(r), F.lit(i)) for i, r in enumerate(ranges)]))
    return trips.select(F.explode(hits).alias("range_no")).groupBy("range_no").agg(F.count(F.lit(1)).alias("trips"))


# Projections and filters


def payload_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.to_trips(fx.raw_trips(spark, sf_dir), key_field="event_id", ingest_time=instant(INGEST))


def payload_map_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as whole nanoseconds and drop-off times as text."""
    raw = fx.raw_trips(spark, sf_dir)
    nanos = F.unix_micros("tpep_pickup_datetime") * 1000 + F.col("event_id") % 1000
    text = F.date_format("tpep_dropoff_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    told = raw.withColumns({"tpep_pickup_datetime": nanos, "tpep_dropoff_datetime": text})
    return payload.to_trips(told, key_field="event_id").select("ride_id", "event_time", "dropoff_time")


def payload_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with times and a key only, where some keys are missing, empty or given."""
    kind = F.col("event_id") % 4
    key = F.when(kind == 1, "").when(kind > 1, F.concat(F.lit("k"), F.col("event_id").cast("string")))
    raw = fx.raw_trips(spark, sf_dir).select("event_id", key.alias("key"), "tpep_pickup_datetime", "tpep_dropoff_datetime")
    return payload.to_trips(raw, key_field="key", ingest_time=instant(INGEST))


def key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.to_trips(fx.raw_trips(spark, sf_dir)).select("ride_id", "event_time")


def drop_null_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.drop_null_event_time(fx.raw_trips(spark, sf_dir))


def encode_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode(fx.trips(spark, sf_dir))


def decode_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode(messages.encode(fx.trips(spark, sf_dir)))


def parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = messages.decode_checked(fx.spoilt_messages(messages.encode(fx.trips(spark, sf_dir))))
    return _outcomes(checked.select(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")))


def quarantined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.quarantined(messages.decode_checked(fx.spoilt_messages(messages.encode(fx.trips(spark, sf_dir)))))


def _outcomes(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


def accepted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.accepted(messages.decode_checked(fx.spoilt_messages(messages.encode(fx.trips(spark, sf_dir)))))


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir)


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_duration(_cleaned(spark, sf_dir)).select("ride_id", "duration")


def fare_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.fare_metrics(_cleaned(spark, sf_dir)).select("ride_id", "duration", "fare_per_km", "fare_per_min")


def avg_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.speed_metrics(_cleaned(spark, sf_dir)).select("ride_id", "duration", "avg_speed_kmh")


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.time_features(_trips(spark, sf_dir)).select("ride_id", "event_hour", "event_weekday", "is_weekend", "event_day_start")


def enrich_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


def enrich_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(enrich.clean_trips(fx.lineitem_trips(spark, sf_dir)))


class FareBand(enrich.TripTransform):
    """A transform as a user would write it."""

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn("fare_band", F.floor(F.col("fare_usd") / 10).cast("long"))


def custom_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [*enrich.DEFAULT_CHAIN, FareBand()]
    return enrich.enrich(_cleaned(spark, sf_dir), steps).select("ride_id", "fare_per_min", "avg_speed_kmh", "fare_band")


# The untreated day


def untreated_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatment.untreated_min(fx.trips(spark, sf_dir))


def untreated_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatment.untreated_day(fx.trips(spark, sf_dir))


def mark_treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatment.mark_treated(fx.trips(spark, sf_dir)).select("ride_id", "event_time", "treated")


def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatment.backfill_range(fx.trips(spark, sf_dir), datetime(2024, 1, 5), datetime(2024, 1, 8))


def _staged(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "staging")
    staged = tables.with_event_date(_cleaned(spark, sf_dir)).withColumn(jobs.BATCH_ID, F.lit(0).cast("long"))
    by = [tables.EVENT_DATE, jobs.BATCH_ID]
    tables.replace_partitions(tables.gathered(staged, by), path, by)
    return path


def daily_batch_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse after two days were run, the second of them twice."""
    staging, warehouse = _staged(spark, sf_dir), scratch_path(spark, "warehouse")
    daily_batch.run_day(spark, staging, warehouse)
    bounds = daily_batch.run_day(spark, staging, warehouse)
    if bounds:
        daily_batch.backfill(spark, staging, warehouse, bounds[0], bounds[1] + timedelta(microseconds=1))
    return spark.read.parquet(warehouse).drop("treated")


def daily_batch_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse after one day was run and then the whole range again."""
    staging, warehouse = _staged(spark, sf_dir), scratch_path(spark, "warehouse")
    daily_batch.run_day(spark, staging, warehouse)
    daily_batch.backfill(spark, staging, warehouse, datetime(1900, 1, 1), datetime(2200, 1, 1))
    return spark.read.parquet(warehouse).drop("treated")


def daily_batch_with_late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse after two runs, where a fifth of the untreated trips lands while the first one works."""
    staging, warehouse = scratch_path(spark, "staging"), scratch_path(spark, "warehouse")
    trips = tables.with_event_date(_cleaned(spark, sf_dir))
    late = (F.col("treated") == treatment.UNTREATED) & (F.col("ride_id").cast("long") % 5 == 0)

    def land(rows: DataFrame, batch: int) -> None:
        by = [tables.EVENT_DATE, jobs.BATCH_ID]
        tables.replace_partitions(tables.gathered(rows.withColumn(jobs.BATCH_ID, F.lit(batch)), by), staging, by)

    def land_late(enriched: DataFrame) -> DataFrame:
        land(trips.where(late), 1)
        return enriched

    land(trips.where(~late), 0)
    daily_batch.run_day(spark, staging, warehouse, [*enrich.DEFAULT_CHAIN, land_late])
    daily_batch.run_day(spark, staging, warehouse)
    return spark.read.parquet(warehouse).drop("treated")


def daily_batch_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging flags after one day was run."""
    staging = _staged(spark, sf_dir)
    daily_batch.run_day(spark, staging, scratch_path(spark, "warehouse"))
    return spark.read.parquet(staging).select("ride_id", "event_time", "treated")


def backfill_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse after all was loaded, every other trip was taken out of staging, and ten days were run again."""
    warehouse, everything = scratch_path(spark, "warehouse"), (datetime(1900, 1, 1), datetime(2200, 1, 1))
    daily_batch.backfill(spark, _staged(spark, sf_dir), warehouse, *everything)
    corrected = scratch_path(spark, "staging")
    left = tables.with_event_date(_cleaned(spark, sf_dir)).where(F.col("ride_id").cast("long") % 2 == 0)
    tables.write_table(left.withColumn(jobs.BATCH_ID, F.lit("0")), corrected)
    daily_batch.backfill(spark, corrected, warehouse, datetime(2024, 1, 5, 12), datetime(2024, 1, 15))
    return tables.read_table(spark, warehouse).drop("treated")


# Order, samples, counts


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.row_count(fx.trips(spark, sf_dir))


def sort_by_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.sort_by_event_time(fx.trips(spark, sf_dir))


def sort_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sorted table that come before their predecessor: none."""
    order = F.struct("event_time", "ride_id")
    placed = ordering.sort_by_event_time(fx.trips(spark, sf_dir)).select(
        order.alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    path = scratch_path(spark, "sorted")
    files.write_parquet(placed, path)
    written = spark.read.parquet(path)
    inside = written.withColumn("before", F.lag("key").over(Window.partitionBy("part").orderBy("place")))
    parts = inside.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") > F.col("key")).alias("wrong"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # One row for each part of the sorted table.
    between = parts.withColumn("border", F.lag("high").over(Window.orderBy("part")) > F.col("low"))
    return between.agg(F.sum("rows").alias("rows"), F.sum(F.col("wrong") + F.coalesce(F.col("border").cast("long"), F.lit(0))).alias("out_of_order"))


def first_n_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.first_n(fx.trips(spark, sf_dir), 1000)


def first_half_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than a ranked limit takes; many share an event time."""
    trips = fx.lineitem_trips(spark, sf_dir)
    return ordering.first_n(trips, trips.count() // 2).select("ride_id", "event_time", "fare_usd")


def sample_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of a random sample: all of it in the table, none twice, its size near the target of 1000."""
    trips = fx.trips(spark, sf_dir)
    sample = sampling.sample_to_target(trips, seed=42).select("ride_id").withColumn("sampled", F.lit(1))
    both = trips.select("ride_id").withColumn("held", F.lit(1)).unionByName(sample, allowMissingColumns=True)
    each = both.groupBy("ride_id").agg(F.count("held").alias("held"), F.count("sampled").alias("sampled"))
    rows, taken = F.sum("held"), F.sum("sampled")
    near = F.abs(taken - F.least(rows, F.lit(sampling.SAMPLE_ROWS))) <= 200
    outside, twice = F.count_if((F.col("sampled") > 0) & (F.col("held") == 0)), F.count_if(F.col("sampled") > F.greatest("held", F.lit(1)))
    return each.agg(rows.alias("table_rows"), outside.alias("outside"), twice.alias("twice"), near.alias("near_target"))


def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_by_hash(fx.trips(spark, sf_dir), "ride_id")


def union_trip_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fx.trips(spark, sf_dir)
    halves = [trips.where(F.col("treated") == flag) for flag in (treatment.TREATED, treatment.UNTREATED)]
    return payload.union_parts(halves)


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trips(spark, sf_dir).select("ride_id", "event_time")


def inter_arrival_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.inter_arrival_gaps(_times(spark, sf_dir))


def replay_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.replay_delays(_times(spark, sf_dir), min_delay_s=0.05)


def replay_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.replay_schedule(_times(spark, sf_dir), min_delay_s=0.05)


def replay_schedule_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many trips share each event time here."""
    return ordering.replay_schedule(fx.lineitem_trips(spark, sf_dir).select("ride_id", "event_time"), min_delay_s=0.05)


def emit_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.emit_offsets(_times(spark, sf_dir))


# Streams


def _topic(spark: SparkSession, trips: DataFrame) -> DataFrame:
    """A stream of the trips as messages, taken in several batches."""
    path = scratch_path(spark, "topic")
    topics.publish(_dealt(messages.encode(trips)), "parquet", path)
    return topics.read_topic(spark, "parquet", path, maxFilesPerTrigger=_files(spark, 2))


def _dealt(rows: DataFrame) -> DataFrame:
    """Spread over as many tasks as a shuffle has, in any scale."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _files(spark: SparkSession, batches: int) -> str:
    """Files per micro-batch, so that a table dealt out takes about so many batches."""
    return str(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // batches))


def _appended(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = scratch_path(spark, "stream-out")
    jobs.append_stream(rows, path, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def replay_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a replay that died in its third step and was run again."""
    raw, topic, progress = (scratch_path(spark, label) for label in ("raw-trips", "topic", "progress"))
    files.write_parquet(fx.raw_trips(spark, sf_dir), raw)
    begun = []

    def dies(start: datetime) -> None:
        begun.append(start)
        if len(begun) == 3:
            raise InterruptedError

    run = partial(replay_plan.replay_to_topic, spark, raw, "parquet", key_field="event_id", step=LANDING_STEP, out=topic, progress=progress)
    with suppress(InterruptedError):
        run(before_step=dies)
    run()
    return messages.decode(spark.read.parquet(topic)).drop("ingest_time")


def stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, _topic(spark, fx.trips(spark, sf_dir)))


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, jobs.clean_stream(_topic(spark, fx.trips(spark, sf_dir))))


def stream_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "staging")
    topic = _topic(spark, fx.trips(spark, sf_dir))
    jobs.stream_to_staging(topic, path, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    return spark.read.parquet(path).drop(jobs.BATCH_ID)


def stream_clean_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a trigger of fixed intervals."""
    path, rows = scratch_path(spark, "stream-out"), jobs.clean_stream(_topic(spark, fx.trips(spark, sf_dir)))
    query = jobs.append_stream(rows, path, scratch_path(spark, "stream-state"), interval="1 second")
    query.processAllAvailable()
    query.stop()
    return spark.read.schema(rows.schema).parquet(path)


def stream_two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics, each with a stream of its own, into one staging table."""
    path, trips = scratch_path(spark, "staging"), fx.trips(spark, sf_dir)
    for left in range(2):
        topic = _topic(spark, trips.where(F.col("ride_id").cast("long") % 2 == left))
        jobs.stream_to_staging(topic, path, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    return spark.read.parquet(path).drop(jobs.BATCH_ID)


def stream_retry_after_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table after two micro-batches, a daily run, and the second batch once more."""
    path, trips = scratch_path(spark, "staging"), _cleaned(spark, sf_dir).drop("treated")
    batches = [trips.where(F.col("ride_id").cast("long") % 2 == left) for left in range(2)]
    sink = jobs.staging_sink(path)
    for number, batch in enumerate(batches):
        sink(batch, number)
    daily_batch.run_day(spark, path, scratch_path(spark, "warehouse"))
    jobs.staging_sink(path)(batches[1], 1)
    return spark.read.parquet(path).select("ride_id", "event_time", "treated")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic with all trips and then a correction of each, merged batch by batch."""
    topic, table = scratch_path(spark, "topic"), scratch_path(spark, "warehouse")
    for trips in (fx.trips(spark, sf_dir), fx.updates(spark, sf_dir)):
        topics.publish(_dealt(messages.encode(trips)), "parquet", topic)
    stream = messages.decode(topics.read_topic(spark, "parquet", topic, maxFilesPerTrigger=_files(spark, 1)))
    state = scratch_path(spark, "stream-state")
    jobs.foreach_batch(stream, jobs.upsert_sink(table), state, interval=None).awaitTermination()
    return spark.read.parquet(table).drop(tables.EVENT_DATE)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of spoilt messages in a stream."""
    staging, bad, source = (scratch_path(spark, label) for label in ("staging", "quarantine", "topic"))
    topics.publish(_dealt(fx.spoilt_messages(messages.encode(fx.trips(spark, sf_dir)))), "parquet", source)
    stream = topics.read_topic(spark, "parquet", source, maxFilesPerTrigger=_files(spark, 2))
    jobs.stream_with_quarantine(stream, staging, bad, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    good = spark.read.parquet(staging).select(F.lit("accepted").alias("outcome"))
    return _outcomes(good.unionByName(spark.read.parquet(bad).select(F.col("reject_reason").alias("outcome"))))


def stream_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "windows")
    cleaned = jobs.clean_stream(_topic(spark, fx.trips(spark, sf_dir)))
    jobs.stream_daily_window(cleaned, path, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    return spark.read.parquet(path).drop(jobs.WINDOW)


def _landed(spark: SparkSession, trips: DataFrame, step: timedelta = LANDING_STEP, late: DataFrame | None = None) -> DataFrame:
    """The trips as a stream in event order, about two steps to a micro-batch; ``late`` ones come after all others."""
    by_date, landing = scratch_path(spark, "by-date"), scratch_path(spark, "landing")
    tables.write_table(tables.with_event_date(trips), by_date)
    slices = replay.land_in_event_order(spark.read.parquet(by_date), landing, step)
    if late is not None:
        _dealt(tables.with_event_date(late)).write.parquet(f"{landing}/{replay.SLICE}={2**60}")
        slices += 1
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(landing).select("path").count()
    pace = max(1, 2 * files // max(1, slices))
    return replay.replay_stream(spark, landing, tables.with_event_date(trips), files_per_batch=pace).drop(tables.EVENT_DATE)


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows in append mode: each once, when the watermark has passed its end."""
    path, rows = scratch_path(spark, "windows"), enrich.clean_trips(_landed(spark, fx.trips(spark, sf_dir).drop("treated"), timedelta(days=1)))
    jobs.append_closed_windows(rows, path, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    return spark.read.parquet(path)


def stream_late_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows, closed while every tenth trip was still missing and amended when these came."""
    trips, path = enrich.clean_trips(fx.trips(spark, sf_dir).drop("treated")), scratch_path(spark, "windows")
    late = F.col("ride_id").cast("long") % 10 == 0
    stream = _landed(spark, trips.where(~late), late=trips.where(late))
    jobs.windows_with_amendments(stream, path, scratch_path(spark, "stream-state"), interval=None).awaitTermination()
    return jobs.amended_windows(spark, path)


def replay_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, _landed(spark, fx.trips(spark, sf_dir)))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trip and a later, dearer copy of it: the first stays."""
    trips = fx.trips(spark, sf_dir)
    later = F.timestamp_micros(F.unix_micros("event_time") + F.lit(16 * 86_400_000_000))
    copies = trips.withColumns({"event_time": later, "fare_usd": F.col("fare_usd") + 1})
    return _appended(spark, jobs.dedup_stream(_landed(spark, trips.unionByName(copies)), watermark="30 days"))


# Aggregates, versions, quality, models


def daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.daily_window(_cleaned(spark, sf_dir))


def daily_window_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.daily_window(fx.odd_trips(spark, sf_dir), report_odd=True)


def hourly_zone_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.hourly_zone_kpi(_cleaned(spark, sf_dir))


def ingest_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.ingest_lag(fx.trips(spark, sf_dir))


def ingest_lag_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles by day out of stored sketches by hour."""
    path = scratch_path(spark, "lag-sketch")
    files.write_parquet(aggregates.lag_sketch(fx.trips(spark, sf_dir)), path)
    return aggregates.sketch_quantiles(aggregates.merge_sketches(spark.read.parquet(path), "DAY"), [0.5, 0.9, 0.999])


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(fx.trips(spark, sf_dir), INGEST, 2 * 86400)


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert_latest(fx.trips(spark, sf_dir), fx.updates(spark, sf_dir))


def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a stored table, run twice."""
    path = scratch_path(spark, "warehouse")
    tables.upsert_table(fx.trips(spark, sf_dir), path)
    for _ in range(2):
        tables.upsert_table(fx.updates(spark, sf_dir), path)
    return spark.read.parquet(path).drop(tables.EVENT_DATE)


def upsert_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections that move trips to other dates, merged twice into a stored table and its key index."""
    path = scratch_path(spark, "warehouse")
    tables.upsert_table(fx.trips(spark, sf_dir), path)
    tables.upsert_table(fx.updates(spark, sf_dir).where(F.col("ride_id").cast("long") % 3 == 0), path)
    for _ in range(2):
        tables.upsert_table(fx.moved_updates(spark, sf_dir), path)
    return tables.read_table(spark, path).drop(tables.EVENT_DATE)


def upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table gains a column with the corrections of every other trip."""
    path, updates = scratch_path(spark, "warehouse"), fx.updates(spark, sf_dir)
    tables.upsert_table(fx.trips(spark, sf_dir), path)
    newer = updates.where(F.col("ride_id").cast("long") % 2 == 0).withColumn("fare_band", F.floor(F.col("fare_usd") / 10).cast("long"))
    tables.upsert_table(newer, path)
    return tables.read_table(spark, path).drop(tables.EVENT_DATE)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(_cleaned(spark, sf_dir), ["ride_id", "event_time", "fare_usd", "payment_type"])


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_unique(fx.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.in_range(fx.trips(spark, sf_dir), {"distance_km": (0.0, 50.0), "fare_usd": (0.0, None)})


def dq_business_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.business_rules(_cleaned(spark, sf_dir))


def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_zone(fx.zones(spark, sf_dir), fx.boroughs(spark, sf_dir))


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_trips(_enriched(spark, sf_dir).drop("treated"), dim_zone(spark, sf_dir))


def kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpi_daily(marts.fact_trips(_enriched(spark, sf_dir), dim_zone(spark, sf_dir), sides=["pickup"]))


ALL: dict[str, Query] = {
    q.__name__: q
    for q in (
        scan_trips_glob, scan_trips_schema, scan_trips_mixed, scan_trips_widened, parquet_overwrite_roundtrip, csv_source_roundtrip, jdbc_read_ranges,
        payload_map, payload_map_times, payload_defaults, key_fallback, drop_null_event_time, encode_wire, decode_wire, parse_quarantine, quarantined_text, accepted_messages,
        clean_trips, trip_duration, fare_metrics, avg_speed, time_features, enrich_trips, enrich_lineitem, custom_transform,
        untreated_min, untreated_day, mark_treated, backfill_range, daily_batch_warehouse, daily_batch_all, daily_batch_with_late_batch, daily_batch_staging, backfill_corrected,
        row_count, sort_by_event_time, sort_order, first_n_trips, first_half_trips, sample_to_target, sample_hash, union_trip_parts,
        inter_arrival_gap, replay_delay, replay_schedule, replay_schedule_lineitem, emit_offsets,
        stream_source, stream_clean, stream_clean_interval, stream_to_staging, stream_two_topics, stream_quarantine, stream_retry_after_mark, stream_upsert, stream_daily_window, stream_closed_windows, stream_late_trips, replay_as_stream, replay_resumed, stream_dedup,
        daily_window, daily_window_odd_values, hourly_zone_kpi, ingest_lag, ingest_lag_quantiles, freshness, upsert_latest, upsert_table, upsert_moved_keys, upsert_new_column,
        dq_not_null, dq_unique, dq_range, dq_business_rules, dim_zone, fact_trips, kpi_daily,
    )
}


def registered() -> dict[str, Query]:
    """Every query, in UTC and with a portable result."""

    def wrap(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(query(spark, sf_dir))

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        return run

    return {name: wrap(q) for name, q in ALL.items()}
