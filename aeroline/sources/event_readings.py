"""Readings with realistic faults, derived from the generic ``events`` table.

Ten sites and five pollutants; sentinels and NULLs are planted by remainders of the event id, duplicates arise from
the small number of sites. This is a mapping of every event to one reading: no event is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.functions.times import event_hour
from aeroline.schemas import READING

RAW_COLUMNS = [
    "event_id",
    "ts AS utc",
    """CASE event_type WHEN 'click' THEN 'OZONE' WHEN 'view' THEN 'PM2.5' WHEN 'error' THEN 'NO2'
       WHEN 'purchase' THEN 'PM10' ELSE 'CO' END AS parameter""",
    """CASE event_type WHEN 'click' THEN 'PPB' WHEN 'view' THEN 'UG/M3' WHEN 'error' THEN 'PPB'
       WHEN 'purchase' THEN 'UG/M3' ELSE 'PPM' END AS unit""",
    """CASE WHEN event_id % 97 = 0 THEN -999 WHEN event_id % 89 = 0 THEN NULL
       ELSE CAST(FLOOR(value) AS INT) END AS aqi""",
    """CASE WHEN event_id % 83 = 0 THEN -999 WHEN event_id % 79 = 0 THEN NULL
       WHEN value < 51 THEN 1 WHEN value < 101 THEN 2 WHEN value < 151 THEN 3 WHEN value < 201 THEN 4
       WHEN value < 301 THEN 5 ELSE 6 END AS category""",
    """CASE WHEN event_id % 73 = 0 THEN NULL
       ELSE concat('00000000', CAST(user_id % 10 AS STRING)) END AS fullaqscode""",
    """CASE WHEN event_id % 71 = 0 THEN NULL
       ELSE concat('84000000000', CAST(user_id % 10 AS STRING)) END AS intlaqscode""",
    "concat('Site ', CAST(user_id % 10 AS STRING)) AS sitename",
    "concat('Agency ', CAST(user_id % 10 % 3 AS STRING)) AS agencyname",
    "CAST(20.0 + 3.0 * (user_id % 10) AS DOUBLE) AS latitude",
    "CAST(-158.0 + 9.0 * (user_id % 10) AS DOUBLE) AS longitude",
]


def events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def to_readings(events: DataFrame) -> DataFrame:
    """Works on batch and streaming frames."""
    return events.selectExpr(*RAW_COLUMNS)


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_readings(spark.read.parquet(events_path(sf_dir)))


def hourly_stamped(raw: DataFrame) -> DataFrame:
    """The same readings stamped with the full hour, as hourly feeds are; makes exact duplicates frequent."""
    return raw.withColumn("utc", event_hour())


def feed_records(raw: DataFrame, *others: str) -> DataFrame:
    """Readings in the shape of the feed: its column names and order, minute-resolution text time. ``others`` come along in front."""
    stamped = raw.withColumn("utc", F.date_format("utc", "yyyy-MM-dd'T'HH:mm"))
    return stamped.select(*others, *[F.col(field.name.lower()).cast(field.dataType).alias(field.name) for field in READING.fields])
