"""Message-queue source and sink: columns plus connector options.

The Kafka connector package has to be on the class path of the job; it is not needed for anything but the two
functions that name it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.functions.keys import message_key
from aeroline.schemas import READING


def keyed_messages(records: DataFrame, key: Column, columns: list[str] | None = None) -> DataFrame:
    """Key and JSON value of any event stream; NULL fields are written out."""
    value = F.to_json(F.struct(*(columns or records.columns)), {"ignoreNullFields": "false"})
    return records.select(key.alias("key"), value.alias("value"))


def to_messages(records: DataFrame) -> DataFrame:
    """Messages of readings, keyed by instrument."""
    return keyed_messages(records, message_key(), [field.name for field in READING.fields])


def from_messages(messages: DataFrame) -> DataFrame:
    """Records of messages; works on batch and streaming frames, with text or binary values.

    A field that cannot be parsed is NULL. Messages that are no JSON object are left to :func:`broken_messages`.
    """
    value = F.col("value").cast("string")
    kept = messages.filter(F.json_object_keys(value).isNotNull())
    return kept.select(F.from_json(value, READING).alias("_record")).select("_record.*")


def broken_messages(messages: DataFrame) -> DataFrame:
    """Key and text of messages that give no record, for the quarantine and a later replay."""
    value = F.col("value").cast("string")
    broken = messages.filter(F.json_object_keys(value).isNull())
    return broken.select(F.col("key").cast("string").alias("key"), value.alias("value"))


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_records: int | None = None) -> DataFrame:
    """Topic as a stream from its first message on; offsets live in the query's checkpoint.

    ``max_records`` bounds a micro-batch over the whole topic; without it a drain takes what is there.
    """
    if not topic:
        raise ValueError("a topic is required")
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.option("startingOffsets", "earliest").load()


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    if not topic:
        raise ValueError("a topic is required")
    messages = to_messages(records)
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
