"""Keep-best and keep-losers deduplication that holds up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
_HASH = "_key_hash"


def total_order(df: DataFrame, first: list[Column], keys: list[str], tie_breakers: list[str] | None = None) -> list[Column]:
    """``first``, then tie-breakers, so that reruns choose the same survivor.

    Without explicit tie-breakers every remaining column is used; rows that still tie are identical copies.
    """
    rest = tie_breakers or [name for name in df.columns if name not in keys]
    return [*first, *[F.col(name).asc_nulls_last() for name in rest]]


def keep_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key.

    The filter on the row number lets Spark keep only one row per key and task *before* the shuffle
    (``WindowGroupLimit``), so a hot key arrives as one row per map task. The hash in front of the keys leaves the
    groups as they are, but speeds up sorting: Spark compares the first sort column cheaply, and a date alone would
    nearly always tie.
    """
    window = Window.partitionBy(_HASH, *keys).orderBy(*order)
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    return hashed.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK, _HASH)


def mark_losers(df: DataFrame, keys: list[str], order: list[Column], row_id: str, flag: str = "is_loser") -> DataFrame:
    """Flag every row that is not the first of its key; ``row_id`` is unique and the last item of ``order``.

    All rows have to be kept here, so nothing can be dropped before the shuffle. Instead every key is ranked in
    two steps. First within slices of the key, spread by ``row_id`` over as many slices as there are shuffle
    partitions: whoever is not the first of a slice has lost. Then the slice winners alone compete for the key.
    Every window group is small even if one key holds most of the table.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_number = F.pmod(F.xxhash64(row_id), F.lit(slices)).cast("int")
    sliced = df.withColumns({"_slice": slice_number, _HASH: F.xxhash64(*keys)})
    by_slice = Window.partitionBy(_HASH, *keys, "_slice").orderBy(*order)
    in_slice = sliced.withColumn("_slice_rank", F.row_number().over(by_slice))
    heat = F.when(F.col("_slice_rank") == 1, F.lit(-1)).otherwise(F.col("_slice"))
    by_key = Window.partitionBy(_HASH, *keys, "_heat").orderBy(*order)
    ranked = in_slice.withColumn("_heat", heat).withColumn(_RANK, F.row_number().over(by_key))
    lost = (F.col("_slice_rank") > 1) | (F.col(_RANK) > 1)
    return ranked.withColumn(flag, lost).drop("_slice", "_slice_rank", "_heat", _RANK, _HASH)


def count_copies(df: DataFrame, name: str = "copies") -> DataFrame:
    """Collapse identical rows into one with a count; hot copies are combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))


def identify_rows(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """A row id for tables that have none: identical rows are counted in ``copies``, so a hash of the content is unique."""
    content = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return count_copies(df).withColumn(row_id, F.sha2(content, 256))


def drop_duplicates(df: DataFrame, keys: list[str], tie_breakers: list[str] | None = None) -> DataFrame:
    """One row per key. Any row would do; a fixed order makes the choice repeatable when a task is rerun."""
    return keep_best(df, keys, total_order(df, [], keys, tie_breakers))
