"""Time columns. Everything is a zone-less UTC timestamp, so results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroline.fixed_values import BEGINNING_OF_TIME, LOCAL_TIME_ZONE


def reading_time(name: str = "utc") -> Column:
    """Text or timestamp to timestamp; unreadable text becomes NULL instead of failing the job."""
    return F.col(name).try_cast("timestamp_ntz")


def reading_date(name: str = "utc") -> Column:
    return F.to_date(reading_time(name))


def reading_hour(name: str = "utc") -> Column:
    return F.hour(reading_time(name))


def hour_timestamp(date: str = "date", hour: str = "hour") -> Column:
    """Date + hour of day -> start of that hour."""
    return F.col(date).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col(hour))


def hour_of(moment: Column) -> Column:
    """Timestamp truncated to its hour, without the zone round trip ``date_trunc`` would take."""
    return F.to_date(moment).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(moment))


def next_hour(moment: Column) -> Column:
    return hour_of(moment) + interval("1 HOUR")


def event_hour(name: str = "utc") -> Column:
    return hour_of(reading_time(name))


def to_local(moment: Column, zone: str = LOCAL_TIME_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment)


def as_timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def beginning_of_time() -> Column:
    return as_timestamp(BEGINNING_OF_TIME)


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")
