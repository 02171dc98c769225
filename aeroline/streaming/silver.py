"""Streaming upsert into the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aeroline.operators.dedup import keep_best, total_order
from aeroline.operators.merge import finish_swap, upsert_table
from aeroline.plans.silver import CLEANED_KEYS, valid_readings
from aeroline.session import scratch, staged
from aeroline.sources.tables import read_table


def readings_to_silver(
    readings: DataFrame, path: str, checkpoint: str, tie_breakers: list[str] | None = None
) -> StreamingQuery:
    """Keep the best reading per hour, site and pollutant across micro-batches.

    A stateful ``dropDuplicates`` would keep the first reading that arrives, not the one with the highest index, so
    every batch is merged by key instead. The upsert is idempotent and finishes the swap of a batch that failed
    in it, so a repeated batch ends in the same table. What a batch stages is dropped with it.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        finish_swap(batch.sparkSession, path, ["date"])
        with scratch(batch.sparkSession):
            upsert(staged(valid_readings(batch), "micro-batch"))

    def upsert(valid: DataFrame) -> None:
        stored = read_table(valid.sparkSession, path, like=valid)
        low, high = valid.agg(F.min("date")).scalar(), valid.agg(F.max("date")).scalar()
        arrived = valid.select(*CLEANED_KEYS).distinct()
        rivals = stored.filter(F.col("date").between(low, high)).join(arrived, CLEANED_KEYS, "left_semi")
        order = total_order(valid, [F.col("aqi").desc()], CLEANED_KEYS, tie_breakers)
        best = keep_best(rivals.unionByName(valid), CLEANED_KEYS, order)
        upsert_table(best, path, CLEANED_KEYS, ["date"])

    writer = readings.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
