"""Message sources: a broker, or files holding messages; one schema for both."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"


@dataclass(frozen=True)
class MessageSource:
    """Where messages come from.  ``topics`` may be comma-separated."""

    topics: str
    kind: str = "kafka"
    path: str | None = None
    fmt: str = "parquet"
    settings: Mapping[str, str] = field(default_factory=dict)
    starting: str = "earliest"
    streaming: bool = False
    per_trigger: int | None = None

    @property
    def topic_list(self) -> list[str]:
        return [t.strip() for t in self.topics.split(",") if t.strip()]


def message_source(spark: SparkSession, spec: MessageSource) -> DataFrame:
    """Messages of the listed topics with their positions; text key and value."""
    if spec.kind == "kafka":
        if "bootstrap.servers" not in spec.settings:
            raise ValueError("settings need bootstrap.servers")
        reader = spark.readStream if spec.streaming else spark.read
        reader = reader.format("kafka").option("subscribe", ",".join(spec.topic_list))
        reader = reader.option("startingOffsets", spec.starting)
        if spec.per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(spec.per_trigger))
        for name, value in spec.settings.items():
            reader = reader.option(f"kafka.{name}", value)
        raw = reader.load()
        return raw.select(
            "topic", "partition", "offset", "timestamp",
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        )
    if spec.kind == "files":
        reader = spark.readStream if spec.streaming else spark.read
        reader = reader.format(spec.fmt).schema(MESSAGE_SCHEMA)
        if spec.per_trigger and spec.streaming:
            reader = reader.option("maxFilesPerTrigger", str(spec.per_trigger))
        return reader.load(spec.path).where(F.col("topic").isin(spec.topic_list))
    raise ValueError(f"unknown message source {spec.kind!r}")


def topic_scan(messages: DataFrame, topics: Sequence[str], ignore_blank: bool = False) -> DataFrame:
    """Messages of some topics, without null (and, if asked, blank) values."""
    keep = F.col("topic").isin(list(topics)) & F.col("value").isNotNull()
    return messages.where(keep & (F.trim("value") != "") if ignore_blank else keep)


def next_offsets(messages: DataFrame) -> DataFrame:
    """Position to go on from, per topic and partition."""
    return messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
