"""Parquet tables: partitioned, unpartitioned and bucketed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column in order, from folder names: no row and no file is read."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not path_exists(spark, path):
        return []
    folders = location.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(location)
    names = [folder.getPath().getName() for folder in folders]
    values = [name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}=")]
    return sorted(value for value in values if value != "__HIVE_DEFAULT_PARTITION__")


def newest_partition(table: DataFrame, path: str, column: str) -> DataFrame:
    """The partition of the latest date of the table at ``path``, which is all that a watermark needs."""
    values = partition_values(table.sparkSession, path, column)
    return table.filter(F.col(column) == F.lit(values[-1]).cast("date")) if values else table


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """The table at ``path``. With ``like``, its schema is used, so partition columns keep their types, and a table
    that does not exist yet is empty."""
    if like is None:
        return spark.read.parquet(path)
    if not path_exists(spark, path):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path)


def read_partitions(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A partitioned table restricted to an inclusive date range.

    The root is read with a filter on the partition column instead of a list of folder names: Spark prunes the same
    folders and keeps ``date`` and ``hour`` as columns.
    """
    df = spark.read.parquet(root)
    if start:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite") -> None:
    """Write by partition columns.

    ``rebalance`` groups rows by partition and lets adaptive execution split a partition that is too large for one
    task, so a hot day is not written by a single task. Overwriting replaces only partitions present in ``df``.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    balanced = df.hint("rebalance", *[F.col(name) for name in partition_by])
    writer = balanced.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_dimension(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Dimensions are deduplicated first, so they are small: one file per (partition of a) dimension.

    ``rebalance`` without columns merges the few rows into as few files as fit the target file size; a dimension
    that has grown large still gets several writers.
    """
    writer = df.hint("rebalance").write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, column: str) -> DataFrame:
    """A table bucketed and sorted by ``column``; joins of equally bucketed tables need no shuffle.

    ``df`` should have few rows per bucket value, because one task reads a whole bucket.
    """
    df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column).option("path", path).saveAsTable(
        name, mode="overwrite"
    )
    return df.sparkSession.table(name)


def database_for(layer: str, target: str) -> str:
    """Database of a layer: the development target gets its own."""
    return f"test_{layer}" if target == "dev" else layer


def save_as_table(df: DataFrame, layer: str, name: str, target: str = "prod") -> str:
    database = database_for(layer, target)
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return f"{database}.{name}"
