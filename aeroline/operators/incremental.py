"""Row- and partition-level increments."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroline.functions.times import as_timestamp, beginning_of_time, interval, next_hour, reading_time

MODES = ("incremental", "backfill", "full")


def high_watermark(target: DataFrame, moment: Column, lookback: str) -> Column:
    """Latest moment in the target minus ``lookback`` as a scalar subquery; 1900 if the target is empty."""
    latest = target.agg((F.max(moment) - interval(lookback)).alias("latest"))
    return F.coalesce(latest.scalar(), beginning_of_time())


def is_new(moment: Column, target: DataFrame, target_moment: Column, lookback: str = "1 hour") -> Column:
    """True for rows strictly after the target's watermark."""
    return moment > high_watermark(target, target_moment, lookback)


def is_new_hour(moment: Column, target: DataFrame, target_hour: Column, lookback: str = "1 hour") -> Column:
    """True for rows whose *hour* lies strictly after the watermark.

    With the default lookback only the latest loaded hour and later ones pass; a wider lookback also admits late rows.
    The hour of a moment is after the watermark exactly if the moment is at or after the next full hour, and in this
    form the condition is a plain lower bound on the time column, which reaches the scan.
    """
    return moment >= next_hour(high_watermark(target, target_hour, lookback))


def in_range(moment: Column, start: str, end: str) -> Column:
    """Inclusive range of an explicit backfill, which ignores the watermark."""
    return moment.between(as_timestamp(start), as_timestamp(end))


def late_row_count(batch: DataFrame, target: DataFrame, target_hour: Column, lookback: str = "1 hour") -> DataFrame:
    """How many batch rows the watermark leaves out: the price of the default mode, made visible."""
    passes = is_new_hour(reading_time(), target, target_hour, lookback)
    return batch.filter(reading_time().isNotNull()).agg(
        F.count_if(passes).alias("on_time"), F.count_if(~passes).alias("late")
    )


def partition_inventory(df: DataFrame, columns: tuple[str, ...] = ("date", "hour")) -> DataFrame:
    """Partitions present in a table. Only the partition columns are read, one row per record, reduced before the shuffle."""
    return df.select(*columns).distinct()


def unprocessed_partitions(source: DataFrame, target: DataFrame, columns: tuple[str, ...] = ("date", "hour")) -> DataFrame:
    """Source partitions the target does not have, compared at the full partition grain."""
    return partition_inventory(source, columns).join(partition_inventory(target, columns), list(columns), "left_anti")


def only_partitions(df: DataFrame, wanted: DataFrame, columns: tuple[str, ...] = ("date", "hour")) -> DataFrame:
    """Rows of the wanted partitions.

    The scalar bounds on the first partition column reach the scan as partition filters; the semi join makes the
    selection exact.
    """
    lead = columns[0]
    bounds = wanted.agg(F.min(lead).alias("low"), F.max(lead).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    return df.filter(F.col(lead).between(low, high)).join(wanted, list(columns), "left_semi")


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """NULL-safe key match: a NULL key part matches NULL, so reruns do not insert such rows again."""
    return reduce(and_, [left[name].eqNullSafe(right[name]) for name in keys])


def new_members(members: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Members that are not known yet: NOT EXISTS on one or more columns.

    An anti join instead of NOT IN, because a single NULL among the known values makes NOT IN return nothing.
    """
    return members.join(known.select(*keys), keys, "left_anti")
