"""Upsert (merge by key) on plain frames and on partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.operators.incremental import same_key
from aeroline.operators.observed import Counted
from aeroline.session import remove_path, staged
from aeroline.sources.tables import path_exists, read_table, write_partitioned


def merge_frames(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Matched keys take the batch row, the rest of the batch is added. Both sides are unique by key."""
    fresh = batch.select(*keys)
    kept = target.join(fresh, same_key(target, fresh, keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def stage_of(path: str) -> str:
    """Where the next version of a table's partitions waits, beside the table: any later run finds it."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    return f"{folder}/_swap/{name}"


def _emptied_of(stage: str) -> str:
    """Beside a stage: the partitions that have no row any more and go with the swap."""
    return f"{stage}_emptied"


def finish_swap(spark: SparkSession, path: str, partition_by: list[str], stage: str | None = None) -> None:
    """Complete a swap that an earlier run has left unfinished; without one, nothing happens.

    Call it before reading a table that is to be changed. As every change of a table starts with it, a stage is never
    older than the table, and swapping it in again gives the same partitions.
    """
    stage = stage or stage_of(path)
    if not path_exists(spark, f"{stage}/_SUCCESS"):
        return
    write_partitioned(spark.read.parquet(stage), path, partition_by)
    if path_exists(spark, _emptied_of(stage)):
        for row in spark.read.schema("folder STRING").json(_emptied_of(stage)).collect():
            remove_path(spark, f"{path}/{row['folder']}")
    remove_path(spark, f"{stage}/_SUCCESS")  # first, so that what is left of a half-removed stage is not taken for one
    remove_path(spark, stage)
    remove_path(spark, _emptied_of(stage))


def upsert_table(
    batch: DataFrame, path: str, keys: list[str], partition_by: list[str], stage: str | None = None, is_stored: bool = False,
    counted: Counted | None = None,
) -> None:
    """Merge ``batch`` into the Parquet table at ``path``.

    Only partitions the batch touches are read and rewritten; partition columns must follow from the key. The merged
    partitions are staged and then swapped in, because a table must not be overwritten while it is being read. A run
    that is interrupted in the swap leaves its stage complete, and whatever run comes next swaps it in first, see
    :func:`finish_swap`. ``stage`` names another place for it. ``is_stored``: the batch is a plain table already.
    ``counted`` observes the batch as it is written.
    """
    spark, stage = batch.sparkSession, stage or stage_of(path)
    batch = batch if counted is None else counted.of(batch)
    finish_swap(spark, path, partition_by, stage)
    is_first = not path_exists(spark, path)
    if not is_first:
        batch = batch if is_stored else staged(batch, "batch")  # used several times below; written once, its plan runs once
        if batch.isEmpty():
            return
    merged = batch if is_first else _merged_partitions(batch, path, keys, partition_by)
    remove_path(spark, _emptied_of(stage))  # of a replacement that did not get as far as its stage
    merged.write.mode("overwrite").parquet(stage)
    finish_swap(spark, path, partition_by, stage)


def replace_partitions(
    rows: DataFrame, path: str, partition: str, touched: DataFrame, stage: str | None = None, counted: Counted | None = None
) -> None:
    """Replace whole partitions of the table at ``path``, which is partitioned by ``partition`` alone.

    ``touched`` lists their values (one column, unique, a row per partition); ``rows`` are all rows they are to have. A touched
    partition without rows goes. As with :func:`upsert_table` the new partitions are staged beside the table and swapped
    in by dynamic overwrite, and an interrupted swap is finished by whatever run comes next, so running it twice changes
    nothing. Nothing of the old partitions is read.
    """
    spark, stage = rows.sparkSession, stage or stage_of(path)
    finish_swap(spark, path, [partition], stage)
    # Staged apart first: which partitions are left without rows has to be known before the stage counts as complete.
    fresh = rows.join(touched, partition, "left_semi")
    fresh = staged(fresh if counted is None else counted.of(fresh), "replacement")
    gone = touched.join(fresh.select(partition).distinct(), partition, "left_anti")
    folder = F.concat(F.lit(f"{partition}="), F.col(partition).cast("string"))
    gone.select(folder.alias("folder")).where("folder IS NOT NULL").write.mode("overwrite").json(_emptied_of(stage))
    fresh.write.mode("overwrite").parquet(stage)
    finish_swap(spark, path, [partition], stage)


def _merged_partitions(batch: DataFrame, path: str, keys: list[str], partition_by: list[str]) -> DataFrame:
    target = read_table(batch.sparkSession, path, like=batch)
    if partition_by:
        # Staged, so that the short list of partitions is broadcast instead of shuffling the target by a hot date.
        touched = staged(batch.select(*partition_by).distinct(), "touched")
        lead = partition_by[0]
        low, high = touched.agg(F.min(lead)).scalar(), touched.agg(F.max(lead)).scalar()
        target = target.filter(F.col(lead).between(low, high)).join(touched, partition_by, "left_semi")
    return merge_frames(target, batch, keys)
