"""Running totals, moving averages and ranks over long per-key histories.

A plain window puts the whole history of a key into one task. Here every history is cut at bucket borders (days), so
one busy site is spread over as many groups as it has days, and the results are still exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, key: str, bucket: str, order: list[str], value: str, name: str = "running_total") -> DataFrame:
    """Running sum of an integer ``value`` per key: the sum within the bucket plus the total of all earlier buckets.

    ``bucket`` must follow from the order (a later row is never in an earlier bucket).
    """
    totals = df.groupBy(key, bucket).agg(F.sum(value).alias("_bucket_total"))
    earlier = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, bucket, F.coalesce(F.sum("_bucket_total").over(earlier), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_local", F.sum(value).over(inside))
    return local.join(carried, [key, bucket]).withColumn(name, F.col("_local") + F.col("_carried")).drop("_local", "_carried")


def moving_average(df: DataFrame, keys: list[str], moment: str, value: str, hours: int, name: str = "moving_avg") -> DataFrame:
    """Mean over the trailing ``hours`` up to and including the row's own moment.

    Days are separate groups. A row is also sent to every later day that its range reaches, as history that is not
    counted as a row of its own; so a group holds a day and the range before it, never the whole history of a key.
    """
    if hours <= 0:
        raise ValueError("the trailing range must be positive")
    day = F.to_date(moment)
    last = F.to_date(F.col(moment) + F.make_dt_interval(hours=F.lit(hours)))
    later = F.when(day.isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.datediff(last, day)))
    spread = df.withColumn("_later", F.explode(later)).withColumns({"_day": F.date_add(day, F.col("_later")), "_own": F.col("_later") == 0})
    partition = ", ".join([*keys, "_day"])
    reach = f"RANGE BETWEEN INTERVAL '{hours * 3600 - 1}' SECOND PRECEDING AND CURRENT ROW"
    averaged = spread.withColumn(name, F.expr(f"avg({value}) OVER (PARTITION BY {partition} ORDER BY {moment} {reach})"))
    return averaged.filter("_own").drop("_later", "_day", "_own")


def rank_groups(df: DataFrame, within: str, member: str, value: str) -> DataFrame:
    """Members ranked by their mean value: reduced to one row per member before the window, ties share a rank."""
    means = df.groupBy(within, member).agg(F.avg(value).alias("mean_value"))
    window = Window.partitionBy(within).orderBy(F.col("mean_value").desc())
    return means.withColumns({"position": F.rank().over(window), "dense_position": F.dense_rank().over(window)})
