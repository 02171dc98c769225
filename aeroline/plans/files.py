"""File-based variant of the layers: bronze, silver and gold as Parquet partitioned by date and hour.

It differs from the canonical tables in grain and keys (sites by international code, one date row per hour, facts at
reading grain) and works partition by partition. A ledger says which partitions a delivery has touched and which of
them a step has done, so a later reading of an hour that is stored already brings the hour back. Every step can be
repeated: partitions that are written are written whole, and count as done only then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.fixed_values import INVALID_NUMBER
from aeroline.functions.keys import path_key
from aeroline.functions.readings import concern_level, weekday_name
from aeroline.operators.columns import lower_case
from aeroline.operators.dedup import drop_duplicates
from aeroline.operators.incremental import new_members, only_partitions
from aeroline.session import staged
from aeroline.sources.landing import read_json_lines, readable, unreadable, with_partitions
from aeroline.sources.tables import path_exists, read_table, write_dimension, write_partitioned

PARTITIONS = ["date", "hour"]
LEDGER = "date DATE, hour INT, delivery STRING"
SILVER_KEYS = ["date", "hour", "intlaqscode", "parameter"]


class Layout:
    """Every path of the file-based layers, so that what is checked is also what is written."""

    def __init__(self, root: str, dataset: str = "readings"):
        self.landing = f"{root}/landing/{dataset}"
        self.archive = f"{root}/archive/{dataset}"
        self.bronze = f"{root}/bronze/{dataset}"  # written by the landing stream only
        self.file_bronze = f"{root}/bronze/{dataset}_files"  # written by the file layers only
        self.quarantine = f"{root}/quarantine/{dataset}_lines"
        self.broken = f"{root}/quarantine/{dataset}_messages"
        self.silver = f"{root}/silver/{dataset}_clean"
        self.progress = f"{root}/state/{dataset}_progress"
        self.reports = f"{root}/state/{dataset}_reports"
        self._gold = f"{root}/gold/{dataset}"

    def ledger(self, step: str) -> str:
        return f"{self.progress}_{step}"

    def gold(self, table: str) -> str:
        return f"{self._gold}/{table}"


def raw_to_bronze(spark: SparkSession, layout: Layout) -> None:
    """Append landing files that bronze does not have yet; lines that are no records go to the quarantine.

    Files are told apart by name, and each is parsed once. Partitions are entered into the ledger and lines into the
    quarantine before the records are stored, so a repeated run completes what an interrupted one has begun.
    """
    lines = with_partitions(read_json_lines(spark, layout.landing))
    stored = read_table(spark, layout.file_bronze, like=readable(lines)).select("original_file")
    known = staged(stored.distinct(), "known-files")  # its size is then known, and a short list is broadcast
    new = staged(new_members(lines, known, ["original_file"]), "new-lines")

    records = readable(new)
    touched = records.filter("date IS NOT NULL AND hour IS NOT NULL").select(*PARTITIONS).distinct()
    touched.withColumn("delivery", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(layout.ledger("pending"))
    broken = unreadable(new)
    known = read_table(spark, layout.quarantine, like=broken)
    new_members(broken, staged(known.select("original_file").distinct(), "known-lines"), ["original_file"]).write.mode("append").parquet(layout.quarantine)
    write_partitioned(records, layout.file_bronze, PARTITIONS, mode="append")


def _open_entries(spark: SparkSession, layout: Layout, step: str) -> DataFrame:
    """Ledger entries that a step has not done."""
    def entries(name: str) -> DataFrame:
        path = layout.ledger(name)
        return spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], LEDGER)

    return staged(entries("pending").join(entries(step), ["date", "hour", "delivery"], "left_anti"), "open-entries")


def valid_bronze(bronze: DataFrame) -> DataFrame:
    """Readings with a valid index, in lower-case columns.

    ``!= -999`` is never true for NULL, so readings without an index drop out as well; category and coordinates are
    not checked here.
    """
    kept = lower_case(bronze.drop("FullAQSCode", "UTC")).filter(F.col("aqi") != INVALID_NUMBER)
    return kept.withColumn("concern_level", concern_level())


def clean_bronze(bronze: DataFrame, tie_breakers: list[str] | None = None) -> DataFrame:
    """One valid reading per hour, international site code and pollutant."""
    return drop_duplicates(valid_bronze(bronze), SILVER_KEYS, tie_breakers)


def bronze_to_silver(spark: SparkSession, layout: Layout) -> None:
    """Clean the (date, hour) partitions of new deliveries, each from all its records."""
    bronze = spark.read.parquet(layout.file_bronze)
    entries = _open_entries(spark, layout, "silver")
    todo = staged(entries.select(*PARTITIONS).distinct(), "todo")
    cleaned = clean_bronze(only_partitions(bronze, todo, tuple(PARTITIONS)).drop("original_file"))
    write_partitioned(cleaned, layout.silver, PARTITIONS)
    entries.write.mode("append").parquet(layout.ledger("silver"))


def with_reading_keys(silver: DataFrame) -> DataFrame:
    """Keys of the file-based star schema. ``hour`` is hashed as a plain number (1, not 01)."""
    return silver.withColumns({
        "site_key": path_key("intlaqscode"),
        "parameter_key": path_key("parameter", "unit"),
        "date_key": path_key("date", "hour"),
        "category_key": path_key("category"),
    })


def site_rows(keyed: DataFrame) -> DataFrame:
    columns = ["site_key", "intlaqscode", "sitename", "agencyname", "latitude", "longitude"]
    return drop_duplicates(keyed.select(*columns).distinct(), ["site_key"])


def parameter_rows(keyed: DataFrame) -> DataFrame:
    return keyed.select("parameter_key", "parameter", "unit").distinct()


def category_rows(keyed: DataFrame) -> DataFrame:
    return keyed.select("category_key", "category", "concern_level").distinct()


def calendar_rows(keyed: DataFrame) -> DataFrame:
    """One row per date and hour, with calendar attributes."""
    day = F.col("date")
    return keyed.select("date_key", "date", "hour").distinct().withColumns({
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "day_of_week_name": weekday_name(F.dayofweek(day)),
    })


def reading_facts(keyed: DataFrame) -> DataFrame:
    """Facts at reading grain."""
    fact_id = path_key("date", "hour", "intlaqscode", "parameter").alias("fact_id")
    return keyed.select(fact_id, "date", "hour", "site_key", "parameter_key", "date_key", "category_key", "aqi")


def silver_to_gold(spark: SparkSession, layout: Layout) -> None:
    """Extend dimensions and fact by the silver partitions of new deliveries.

    Dimension rows are reduced to distinct members by the scan itself, so the column-pruned silver partitions are
    read once per table instead of being held in memory. Facts go last: a partition counts as done only when its
    members are stored.
    """
    silver = spark.read.parquet(layout.silver)
    fact_path = layout.gold("fact_air_quality_readings")
    entries = _open_entries(spark, layout, "gold")
    todo = staged(entries.select(*PARTITIONS).distinct(), "todo")
    keyed = with_reading_keys(only_partitions(silver, todo, tuple(PARTITIONS)))

    _extend(layout.gold("dim_site"), site_rows(keyed), "site_key")
    _extend(layout.gold("dim_parameter"), parameter_rows(keyed), "parameter_key")
    _extend(layout.gold("dim_category"), category_rows(keyed), "category_key")
    _extend(layout.gold("dim_date"), calendar_rows(keyed), "date_key", ["year", "month"])
    write_partitioned(reading_facts(keyed), fact_path, PARTITIONS)
    entries.write.mode("append").parquet(layout.ledger("gold"))


def _extend(path: str, rows: DataFrame, key: str, partition_by: list[str] | None = None) -> None:
    """Rewrite a dimension as what it was plus members it did not have, so that no member appears twice."""
    known = read_table(rows.sparkSession, path, like=rows)
    added = new_members(rows, known, [key])
    write_dimension(staged(known.unionByName(added), "dimension"), path, partition_by)
