"""Appending sinks of streams that take no batch twice.

An upsert forgives a batch that is repeated after a failure; an append does not. Here a batch is entered under its query
and number by the write itself: it is a partition of the table, and a repeated batch replaces its own partition. There is no
second place that could disagree with the rows, and nothing of other batches is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aeroline.functions.readings import is_rejected, rejection_reason
from aeroline.sources.messages import broken_messages, to_messages
from aeroline.sources.tables import path_exists

QUERY, BATCH = "_query", "_batch"


def append_once(rows: DataFrame, path: str, query: str, batch: int) -> None:
    """Rows of one batch into the table at ``path``. Doing it again with the same batch changes nothing, as a source gives a
    repeated batch the same rows."""
    marked = rows.withColumns({QUERY: F.lit(query), BATCH: F.lit(batch).cast("long")})
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(QUERY, BATCH).parquet(path)


def write_once(rows: DataFrame, path: str, checkpoint: str, query: str) -> StreamingQuery:
    """Drain a stream into an appended table. ``query`` names the stream for good: a restart with the same checkpoint uses the
    same name, a stream with a new checkpoint needs a new one, because its batches count from 0 again."""
    writer = rows.writeStream.foreachBatch(lambda batch, number: append_once(batch, path, query, number))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_appended(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table without its marks; empty, with the given schema, if no batch has been written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema or "value STRING")
    reader = spark.read if schema is None else spark.read.schema(schema)
    stored = reader.parquet(path)
    return stored.drop(QUERY, BATCH)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: rows per query and batch, counted from the footers of the files."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{QUERY} STRING, {BATCH} LONG, rows LONG")
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col(QUERY).cast("string").alias(QUERY), F.col(BATCH).cast("long").alias(BATCH)).agg(F.count(F.lit(1)).alias("rows"))


def rejects_to_quarantine(readings: DataFrame, path: str, checkpoint: str, query: str = "rejects") -> StreamingQuery:
    """Every rejected reading of a stream with its first reason, each once."""
    rejected = readings.filter(is_rejected()).withColumn("rejection_reason", rejection_reason())
    return write_once(rejected, path, checkpoint, query)


def messages_to_quarantine(messages: DataFrame, path: str, checkpoint: str, query: str = "broken") -> StreamingQuery:
    """Key and text of every message that gives no record, each once."""
    return write_once(broken_messages(messages), path, checkpoint, query)


def records_to_outbox(records: DataFrame, path: str, checkpoint: str, query: str = "outbox") -> StreamingQuery:
    """Messages of readings, each once. A queue cannot take a batch back, so what is to be sent is stored first and sent from
    here; query and batch go along for receivers that have to tell a repetition."""
    return write_once(to_messages(records), path, checkpoint, query)
