"""Message topics: any source or sink with key and value columns, Kafka by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.schemas import MESSAGE

# Fixed value: the topic's name.
TOPIC = "rides_raw"


def kafka_options(servers: str, topic: str = TOPIC, starting: str = "latest") -> dict[str, str]:
    """Options of a Kafka read. A checkpoint takes over from ``starting`` after the first run."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def read_topic(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """An unbounded stream of messages. File formats read a directory of key/value files."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(MESSAGE)
    return reader.load(path) if path else reader.load()


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Send encoded messages from the executors. For a dry run show ``messages`` instead."""
    writer = messages.write.format(fmt).mode("append").options(**options)
    if path:
        writer.save(path)
    else:
        writer.save()
