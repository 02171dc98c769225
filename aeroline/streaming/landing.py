"""Bounded streaming ingest: messages to the landing zone, landing files to bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aeroline.sources.landing import landing_rows, stream_json_lines, with_partitions
from aeroline.sources.messages import broken_messages, from_messages
from aeroline.sources.progress import advance, read_progress, write_progress


SPREAD = 4


def clustered(records: DataFrame, *columns: str, spread: int = SPREAD) -> DataFrame:
    """Rows of one partition folder in ``spread`` tasks at most, so a batch writes that many files a folder and not one
    per task; a hot hour still has several writers."""
    part = F.pmod(F.xxhash64(*records.columns), F.lit(spread))
    return records.withColumn("_part", part).repartition(*columns, "_part").drop("_part")


def messages_to_landing(messages: DataFrame, landing: str, checkpoint: str) -> StreamingQuery:
    """Drain what is available now into JSON lines under ``date=…/`` and stop.

    The file sink records which files belong to a committed batch, so a batch repeated after a failure is not seen
    twice by Spark readers. Offsets are committed after the files.
    """
    return records_to_landing(from_messages(messages), landing, checkpoint)


def broken_to_quarantine(messages: DataFrame, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Drain the messages that give no record into JSON lines of key and text, and stop."""
    writer = broken_messages(messages).writeStream.format("json").option("ignoreNullFields", False)
    return writer.option("path", quarantine).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def records_to_landing(records: DataFrame, landing: str, checkpoint: str) -> StreamingQuery:
    writer = clustered(landing_rows(records), "date").writeStream.format("json").option("ignoreNullFields", False)
    writer = writer.partitionBy("date").option("path", landing).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def landing_to_bronze(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, max_files: int | None = None, archive: str | None = None,
    metrics: dict[str, Column] | None = None,
) -> StreamingQuery:
    """Every landing file once into Parquet by date and hour; processed files can be moved to an archive.

    Unreadable lines go along in the corrupt-record column, so one scan serves the readings and their quarantine.
    Files of the last batch are archived when the next run commits it. ``metrics`` are aggregates over all lines of a batch,
    taken as they pass and reported with its progress under the name "bronze".
    """
    lines = with_partitions(stream_json_lines(spark, landing, max_files, archive))
    if metrics:
        lines = lines.observe("bronze", *[column.alias(name) for name, column in metrics.items()])
    records = clustered(lines, "date", "hour")
    writer = records.writeStream.format("parquet").partitionBy("date", "hour")
    writer = writer.option("path", bronze).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def track_progress(records: DataFrame, progress: str, checkpoint: str) -> StreamingQuery:
    """Keep the oldest reading time of a historical stream; taking the minimum twice changes nothing."""
    def keep_oldest(batch: DataFrame, _batch_id: int) -> None:
        write_progress(advance(read_progress(batch.sparkSession, progress), batch), progress)

    writer = records.writeStream.foreachBatch(keep_oldest).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
