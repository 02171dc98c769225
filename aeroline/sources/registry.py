"""Stored tables in the catalogue, with their partitions known by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def location_of(spark: SparkSession, table: str) -> str:
    """Where the files of a table of the catalogue are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].removeprefix("file:").rstrip("/") if rows else ""


def register(spark: SparkSession, table: str, path: str, partition_by: list[str], schema: T.StructType | None = None) -> None:
    """Enter the Parquet table at ``path`` as ``database.table``, or bring its entry up to date.

    The entry is external: dropping it leaves the files alone, and the jobs go on writing by path. Partitions that have come
    or gone since are entered or removed by name; no data file is read for that. A name that stands for another path is
    refused. ``schema`` need not be given unless the table has no files yet.
    """
    database = table.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    if not spark.catalog.tableExists(table):
        fields = (schema or spark.read.parquet(path).schema).fields
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        parts = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING parquet {parts} LOCATION '{place}'")
    elif not location_of(spark, table).endswith(path.removeprefix("file:").rstrip("/")):
        raise ValueError(f"{table} is at {location_of(spark, table)}, not at {path}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(quoted(table))


def listed_partitions(spark: SparkSession, table: str) -> DataFrame:
    """The partitions of a table as rows of typed columns, from the catalogue: no file is listed and no record read."""
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    shown = spark.sql(f"SHOW PARTITIONS {quoted(table)}")
    parts = spark.sql(f"DESCRIBE TABLE {quoted(table)}").collect()
    names = [r["col_name"] for r in parts[next(i for i, r in enumerate(parts) if r["col_name"] == "# col_name") + 1:]]

    def value(name: str):
        text = F.url_decode(F.regexp_extract("partition", rf"(?:^|/){name}=([^/]*)", 1))
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", text).cast(types[name]).alias(name)

    return shown.select(*[value(name) for name in names])


def unprocessed(spark: SparkSession, source: str, target: str, columns: tuple[str, ...]) -> DataFrame:
    """Partitions of ``source`` that ``target`` does not have, by name alone. Those without a value are left out."""
    have = listed_partitions(spark, target).select(*columns)
    return listed_partitions(spark, source).select(*columns).dropna().distinct().join(have, list(columns), "left_anti")
