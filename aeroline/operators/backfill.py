"""Planning of historical loads as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.fixed_values import BACKFILL_TARGET, BACKFILL_WEEKS, READING_TIME_FORMAT
from aeroline.functions.times import as_timestamp, event_hour, hour_of, interval


def next_window(state: DataFrame, today: str, target: str = BACKFILL_TARGET) -> DataFrame:
    """The window to load next, and whether the backfill is done.

    ``state`` is the one-row progress table (oldest_loaded, NULL before the first load). The window ends an hour
    before the oldest loaded hour and is two weeks long; without progress it is the two weeks up to yesterday 23:00.
    """
    length = interval(f"{BACKFILL_WEEKS * 7} DAYS")
    oldest = hour_of(F.col("oldest_loaded"))
    midnight = as_timestamp(today)
    start = F.coalesce(oldest, midnight) - length
    end = F.coalesce(oldest, midnight) - interval("1 HOUR")
    done = F.coalesce(F.col("oldest_loaded") <= as_timestamp(target), F.lit(False))
    return state.select(
        F.date_format(start, READING_TIME_FORMAT).alias("window_start"),
        F.date_format(end, READING_TIME_FORMAT).alias("window_end"),
        done.alias("is_done"),
    )


def backfill_windows(state: DataFrame, target: str = BACKFILL_TARGET) -> DataFrame:
    """All windows from the oldest loaded hour back to the target: the schedule the repeated runs would follow."""
    length = interval(f"{BACKFILL_WEEKS * 7} DAYS")
    oldest = hour_of(F.col("oldest_loaded"))
    # Inside the condition, so that no sequence is built for a finished backfill.
    stops = F.sequence(oldest, as_timestamp(target) + interval("1 SECOND"), -length)
    pending = F.when(F.col("oldest_loaded") > as_timestamp(target), stops)
    ends = state.select(F.posexplode(pending).alias("window_number", "stop"))
    return ends.select(
        "window_number",
        F.date_format(F.col("stop") - length, READING_TIME_FORMAT).alias("window_start"),
        F.date_format(F.col("stop") - interval("1 HOUR"), READING_TIME_FORMAT).alias("window_end"),
    )


def coverage_gaps(readings: DataFrame, key: str = "parameter") -> DataFrame:
    """Hours without any reading between the first and last hour of every key.

    Readings are reduced to distinct (key, hour) first. The spine is a sequence of days per key, each dealt on as a row
    and then taken apart into hours, so one stray time makes a row per day and not one huge array of hours.
    """
    present = readings.select(key, event_hour().alias("gap_hour")).distinct()
    ends = present.groupBy(key).agg(F.min("gap_hour").alias("low"), F.max("gap_hour").alias("high"))
    days = ends.select(key, "low", "high", F.explode(F.sequence(F.to_date("low"), F.to_date("high"))).alias("day"))
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=h))
    spine = days.select(key, "low", "high", F.explode(hours).alias("gap_hour")).filter(F.col("gap_hour").between(F.col("low"), F.col("high")))
    spine = spine.select(key, "gap_hour")
    return spine.join(present, [key, "gap_hour"], "left_anti")
