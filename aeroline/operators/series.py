"""Hourly, local-time and regional series over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroline.functions.readings import assign_region
from aeroline.functions.times import as_timestamp, hour_timestamp, to_local


def _readings_of(fact: DataFrame, dim_parameter: DataFrame, parameter: str, start: str, end: str) -> DataFrame:
    """Facts of one pollutant in an inclusive date range; the range prunes fact partitions."""
    wanted = dim_parameter.filter(F.col("parameter") == parameter).select("parameter_key")
    dates = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return fact.filter(dates).join(wanted, "parameter_key")


def hourly_mean(fact: DataFrame, dim_parameter: DataFrame, parameter: str, start: str, end: str) -> DataFrame:
    """Mean index per hour over all sites."""
    readings = _readings_of(fact, dim_parameter, parameter, start, end)
    return readings.groupBy("date", "hour").agg(F.avg("aqi").alias("avg_aqi"))


def site_hourly_mean(
    fact: DataFrame, dim_parameter: DataFrame, dim_site: DataFrame, parameter: str, start: str, end: str
) -> DataFrame:
    """Mean index per hour and site coordinate.

    Readings are first reduced to sums per hour and site key, so the site join sees groups instead of readings; sums
    and counts, unlike means, can be combined exactly when two sites share a coordinate.
    """
    readings = _readings_of(fact, dim_parameter, parameter, start, end)
    per_site = readings.groupBy("date", "hour", "site_key").agg(F.sum("aqi").alias("total"), F.count("aqi").alias("n"))
    located = per_site.join(dim_site.select("site_key", "latitude", "longitude"), "site_key")
    mean = F.sum("total") / F.sum("n")
    return located.groupBy("date", "hour", "latitude", "longitude").agg(mean.alias("avg_aqi"))


def calendar_mean(fact: DataFrame, calendar: DataFrame, wanted: Column) -> DataFrame:
    """Mean index and number of readings per hour of day, over the days of a calendar that are ``wanted``.

    ``fact`` is partitioned by ``date``, the key of the calendar. The days are known only when the calendar has been read;
    Spark then prunes the fact's partitions to them while the query runs, so that Mondays cost a seventh of the table.
    """
    days = calendar.filter(wanted).select("date")
    return fact.join(days, "date").groupBy("hour").agg(F.avg("aqi").alias("avg_aqi"), F.count(F.lit(1)).alias("readings"))


def with_local_time(series: DataFrame) -> DataFrame:
    moment = hour_timestamp()
    return series.withColumns({"datetime_utc": moment, "datetime_local": to_local(moment)})


def local_range(series: DataFrame, start: str, end: str) -> DataFrame:
    """Inclusive range in local time; needs :func:`with_local_time`."""
    return series.filter(F.col("datetime_local").between(as_timestamp(start), as_timestamp(end)))


def regional_mean(site_series: DataFrame) -> DataFrame:
    """Mean of the per-site means per local hour and region: every site counts once, however much it reports."""
    placed = site_series.withColumn("region", assign_region())
    return placed.groupBy("datetime_local", "region").agg(F.avg("avg_aqi").alias("avg_aqi"))
