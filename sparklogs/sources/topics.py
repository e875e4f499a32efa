"""Topics of JSON messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.schemas import LOG

FIELDS = ["timestamp", "level", "location", "host", "message"]


def to_topic(df: DataFrame, topic: str | Column, extra: list[str] | None = None) -> DataFrame:
    """(topic, value): one JSON object per event; columns in `extra` ride along. `topic` is a name, or a column of names."""
    return df.select((F.lit(topic) if isinstance(topic, str) else topic).alias("topic"), F.to_json(F.struct(*FIELDS)).alias("value"), *(extra or []))


def from_topic(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """LOG rows of messages, bytes or text; broken messages give nulls."""
    return df.select(F.from_json(F.col("value").cast("string"), LOG).alias("e"), *(extra or [])).select("e.*", *(extra or []))


def write_topic(messages: DataFrame, servers: str | None = None, folder: str | None = None) -> None:
    """To a broker, or appended to a folder of Parquet files by topic."""
    if servers:
        messages.select("topic", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        messages.write.mode("append").partitionBy("topic").parquet(folder)


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, folder: str | None = None, starting: str | None = None, max_per_batch: int | None = None) -> DataFrame:
    """A stream of (topic, value) from a broker, or from a folder that `write_topic` fills."""
    return read_topics(spark, [topic], servers, folder, starting, max_per_batch)


def read_topics(spark: SparkSession, topics: list[str], servers: str | None = None, folder: str | None = None, starting: str | None = None, max_per_batch: int | None = None) -> DataFrame:
    """One stream of several topics; each message keeps its topic.

    From a broker `starting` is "latest" unless given and `max_per_batch` counts
    messages. A folder is read from its beginning and `max_per_batch` counts files;
    `messages.read_messages` has a start and counts messages there too.
    """
    if not servers and starting is not None:
        raise ValueError("a folder has no start: see messages.read_messages")
    if servers:
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting or "latest")
        if max_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
        return reader.load().select("topic", F.col("value").cast("string").alias("value"))
    reader = spark.readStream.schema("topic string, value string")
    if max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    return reader.parquet(folder).where(F.col("topic").isin(topics))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
