"""Progress of the historical load: a one-row table with the oldest loaded reading time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.fixed_values import BACKFILL_TARGET
from aeroline.functions.times import as_timestamp, reading_time
from aeroline.session import staged
from aeroline.sources.tables import path_exists

SCHEMA = "oldest_loaded TIMESTAMP_NTZ, ingested_at TIMESTAMP"


def oldest_of(records: DataFrame, utc: str = "UTC") -> DataFrame:
    return records.agg(F.min(reading_time(utc)).alias("oldest_loaded"))


def advance(state: DataFrame, records: DataFrame, utc: str = "UTC") -> DataFrame:
    """New state: the older of what was and what came. Progress never moves forward in time again."""
    came = oldest_of(records, utc).select("oldest_loaded", F.current_timestamp().alias("ingested_at"))
    both = state.select("oldest_loaded", "ingested_at").unionByName(came)
    return both.agg(F.min("oldest_loaded").alias("oldest_loaded"), F.max("ingested_at").alias("ingested_at"))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The stored state; one row with NULLs if nothing was loaded yet."""
    if path_exists(spark, path):
        return spark.read.schema(SCHEMA).json(path)
    return spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS oldest_loaded, CAST(NULL AS TIMESTAMP) AS ingested_at")


def write_progress(state: DataFrame, path: str) -> None:
    """The new state is staged first, because it is computed from the table it replaces."""
    staged(state, "progress").coalesce(1).write.mode("overwrite").json(path)


def is_done(state: DataFrame, target: str = BACKFILL_TARGET) -> DataFrame:
    """Whether the historical load has reached its target date."""
    reached = F.coalesce(F.col("oldest_loaded") <= as_timestamp(target), F.lit(False))
    return state.select("oldest_loaded", reached.alias("is_done"))
