"""Message topic to staging table, without end."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripweave.sources.topics import TOPIC, kafka_options, read_topic
from tripweave.streaming.jobs import BATCH_INTERVAL, stream_to_staging


def start_staging(
    spark: SparkSession,
    servers: str,
    staging: str,
    checkpoint: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    interval: str = BATCH_INTERVAL,
    **options: str,
) -> StreamingQuery:
    """Clean a Kafka topic into the staging table; more ``options`` go to the source.

    The first run begins at ``starting`` and later ones at the checkpoint, so a
    restart neither loses nor repeats a trip. ``maxOffsetsPerTrigger`` bounds a
    batch after a long stop, and ``minPartitions`` gives the topic partition that a
    hot key has filled to several tasks.
    """
    messages = read_topic(spark, "kafka", **kafka_options(servers, topic, starting), **options)
    return stream_to_staging(messages, staging, checkpoint, interval)
