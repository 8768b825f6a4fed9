"""Sources and sinks of streams: Kafka topics by name, and folders of files with the same columns (key, value, timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "key string, value binary, timestamp timestamp"


def kafka_options(servers: str, topic: str, starting: str = "latest", group: str | None = None) -> dict[str, str]:
    """Options of a topic's reader; lost data fails a run rather than passing unseen."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "true"}
    return options | ({"kafka.group.id": group} if group else {})


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", group: str | None = None) -> DataFrame:
    """A topic as a stream of messages. Needs Spark's Kafka package on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, group)).load()
    return raw.select(F.col("key").cast("string").alias("key"), "value", "timestamp")


def snapshot(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A topic from its beginning to its end now, as a table: the newest message of each key."""
    raw = spark.read.format("kafka").options(**kafka_options(servers, topic, "earliest")).option("endingOffsets", "latest").load()
    return newest_by_key(raw.select(F.col("key").cast("string").alias("key"), "value", "timestamp", "partition", "offset"), ["partition", "offset"])


def newest_by_key(messages: DataFrame, order: list[str]) -> DataFrame:
    """key, value of each key's last message; a key whose last message has no value is gone, as in a compacted topic."""
    last = messages.groupBy("key").agg(F.max_by(F.struct("value"), F.struct(*order)).alias("m"))
    return last.select("key", "m.value").filter("value is not null")


def files(spark: SparkSession, path: str, per_batch: int = 1000) -> DataFrame:
    """A folder of Parquet files of messages as a stream, in the order they were written."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", per_batch).parquet(path)


def publish(messages: DataFrame, checkpoint: str, path: str | None = None, servers: str | None = None, topic: str | None = None, trigger: dict | None = None):
    """Start writing a stream of (key, value) to a topic or a folder. Offsets are committed after a batch is written."""
    writer = messages.select("key", "value").writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    if path is not None:
        return writer.format("parquet").option("path", path).start()
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).start()
