"""Points in latitude/longitude boxes.

A range condition alone leaves Spark only a nested-loop join. Boxes are therefore laid over a grid, which turns the
range join into an equality join on grid cells plus an exact check; a point has one cell, so nothing is doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.fixed_values import REGIONS, REQUEST_BOXES
from aeroline.functions.readings import within
from aeroline.operators.dedup import keep_best

BOUNDS = ["lat_min", "lat_max", "lon_min", "lon_max"]


def literal_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A small constant table whose size the optimizer knows."""
    def text(value):
        return f"'{value}'" if isinstance(value, str) else f"{value}D" if isinstance(value, float) else str(value)

    values = ", ".join("(" + ", ".join(text(value) for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def region_table(spark: SparkSession) -> DataFrame:
    """Regions with their order of precedence; the name is the region key."""
    rows = [(i, *region) for i, region in enumerate(REGIONS)]
    return literal_table(spark, ["precedence", "region_key", *BOUNDS], rows)


def box_table(spark: SparkSession, first: int | None = None) -> DataFrame:
    """The request boxes, numbered from 0; ``first`` limits a development run to the first few."""
    rows = []
    for i, box in enumerate(REQUEST_BOXES[:first]):
        lon_min, lat_min, lon_max, lat_max = (float(bound) for bound in box.split(","))
        rows.append((i, lat_min, lat_max, lon_min, lon_max))
    return literal_table(spark, ["box_id", *BOUNDS], rows)


def _cell(column, size: float):
    return F.floor(column / F.lit(size)).cast("int")


def join_boxes(points: DataFrame, boxes: DataFrame, how: str = "inner", cell: float = 1.0) -> DataFrame:
    """Points × boxes that hold them, bounds inclusive; a point in several boxes gives one row each.

    Use it on distinct coordinates, not on readings.
    """
    lat_cells = F.sequence(_cell(F.col("lat_min"), cell), _cell(F.col("lat_max"), cell))
    lon_cells = F.sequence(_cell(F.col("lon_min"), cell), _cell(F.col("lon_max"), cell))
    gridded = boxes.withColumn("_box_lat", F.explode(lat_cells)).withColumn("_box_lon", F.explode(lon_cells))
    located = points.withColumn("_lat", _cell(F.col("latitude"), cell)).withColumn("_lon", _cell(F.col("longitude"), cell))
    inside = within(F.col("latitude"), F.col("longitude"), *(F.col(bound) for bound in BOUNDS))
    on = (F.col("_lat") == F.col("_box_lat")) & (F.col("_lon") == F.col("_box_lon")) & inside
    return located.join(gridded, on, how).drop("_lat", "_lon", "_box_lat", "_box_lon", *BOUNDS)


def max_region(sites: DataFrame, regions: DataFrame, keys: list[str], tie_breakers: list[str]) -> DataFrame:
    """One row per site: the largest region key among the boxes that hold it, NULL if there is none."""
    placed = join_boxes(sites, regions.select("region_key", *BOUNDS), how="left")
    order = [F.col("region_key").desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in tie_breakers]]
    return keep_best(placed, keys, order)
