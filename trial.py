"""Time operators on many trips with hot keys and show how even their tasks are.

Usage: python trial.py [copies per event] [operator ...]

Trips of BENCH_SF_DIR are multiplied; a third of the rows share one ride id and event
time, a third another event time and a third one zone. Task times come from Spark's
event log.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from tripweave.operators import aggregates, enrich, marts, messages, ordering, quality, sampling, treatment, upsert
from tripweave.sources import tables, topics
from tripweave.streaming import jobs

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def hot_trips(spark: SparkSession, copies: int) -> DataFrame:
    """All trips ``copies`` times over, in three equal parts by what they share."""
    trips = fx.trips(spark, SF_DIR).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).repartition(64)
    part = F.pmod(F.xxhash64("ride_id", "copy"), F.lit(3))
    own_id = F.concat_ws("-", "ride_id", "copy")
    moved = F.timestamp_micros(F.unix_micros("event_time") + F.col("copy") * 1000)
    return trips.withColumns(
        {
            "ride_id": F.when(part == 0, "hot").otherwise(own_id),
            "event_time": F.when(part == 0, F.lit("2024-01-20 12:00:00").cast("timestamp"))
            .when(part == 1, F.lit("2024-01-15 08:00:00").cast("timestamp"))
            .otherwise(moved),
            "ingest_time": F.timestamp_micros(F.unix_micros("ingest_time") + F.col("copy")),
            "pickup_zone": F.when(part == 2, "7").otherwise(F.col("pickup_zone")),
        }
    ).drop("copy")


def operators(spark: SparkSession, trips: DataFrame, folder: str) -> dict:
    cleaned = enrich.clean_trips(trips)
    enriched = enrich.enrich(cleaned)
    zones = marts.dim_zone(fx.zones(spark, SF_DIR), fx.boroughs(spark, SF_DIR))
    places = trips.select("ride_id", "event_time")

    def streamed(start) -> None:
        topic = f"{folder}/topic"
        if not os.path.exists(topic):
            topics.publish(messages.encode(trips), "parquet", topic)
        start(topics.read_topic(spark, "parquet", topic, maxFilesPerTrigger="4")).awaitTermination()

    def run(df: DataFrame):
        return lambda: df.write.format("noop").mode("overwrite").save()

    return {
        "read": run(trips),
        "clean": run(cleaned),
        "enrich": run(enriched),
        "encode": run(messages.encode(trips)),
        "encode_decode": run(messages.decode(messages.encode(trips))),
        "hourly_zone_kpi": run(aggregates.hourly_zone_kpi(cleaned)),
        "fact_trips": run(marts.fact_trips(enriched.drop("treated"), zones)),
        "not_unique": run(quality.not_unique(trips, ["ride_id"])),
        "sample_by_hash": run(sampling.sample_by_hash(trips, "ride_id")),
        "untreated_day": run(treatment.untreated_day(trips)),
        "sort": run(ordering.sort_by_event_time(trips)),
        "replay_schedule": lambda: run(ordering.replay_schedule(places, min_delay_s=0.05))(),
        "latest_per_key": run(upsert.latest_per_key(trips)),
        "write_by_date": lambda: tables.write_table(tables.with_event_date(trips), f"{folder}/by-date"),
        "stream_to_staging": lambda: streamed(lambda s: jobs.stream_to_staging(s, f"{folder}/stg", f"{folder}/c1", None)),
        "stream_dedup": lambda: streamed(
            lambda s: jobs.append_stream(
                jobs.dedup_stream(jobs.clean_stream(s), watermark="40 days"), f"{folder}/dedup", f"{folder}/c2", None
            )
        ),
    }


def task_times(folder: str) -> dict[int, list[tuple[float, float]]]:
    """Start and length of every task by stage, in milliseconds."""
    stages = defaultdict(list)
    for path in glob.glob(f"{folder}/log/*"):
        with open(path) as log:
            for line in log:
                if '"SparkListenerTaskEnd"' in line:
                    event = json.loads(line)
                    info = event["Task Info"]
                    stages[event["Stage ID"]].append((info["Launch Time"], info["Finish Time"] - info["Launch Time"]))
    return stages


def main() -> None:
    copies, only = int(sys.argv[1]) if len(sys.argv) > 1 else 200, sys.argv[2:]
    folder = tempfile.mkdtemp(prefix="run-")
    os.mkdir(f"{folder}/log")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{folder}/log")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    hot_trips(spark, copies).write.parquet(f"{folder}/trips")
    trips = spark.read.parquet(f"{folder}/trips")
    rows = trips.count()
    spans = {}
    for name, action in operators(spark, trips, folder).items():
        if not only or name in only:
            start = time.time()
            action()
            spans[name] = (start, time.time())
    spark.stop()
    stages = task_times(folder)
    print(f"{rows} trips; files in {folder}")
    for name, (start, end) in spans.items():
        inside = [t for t in stages.values() if start * 1000 <= t[0][0] <= end * 1000]
        heaviest = sorted(length for _, length in max(inside, key=lambda t: sum(length for _, length in t)))
        even = heaviest[-1] / max(1, heaviest[len(heaviest) // 2])
        print(f"{name:20s}{end - start:8.1f} s {rows / (end - start) / 1e6:7.1f} M rows/s   slowest/median task {even:.1f}")


if __name__ == "__main__":
    main()
