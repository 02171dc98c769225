"""Cleaned and quarantine tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.fixed_values import DUPLICATE_LABEL
from aeroline.functions.readings import concern_level, is_rejected, is_valid_reading, rejection_reason
from aeroline.functions.times import hour_timestamp, reading_date, reading_hour, reading_time
from aeroline.operators.dedup import identify_rows, keep_best, mark_losers, total_order
from aeroline.operators.incremental import MODES, high_watermark, in_range, is_new, is_new_hour

CLEANED_KEYS = ["date", "hour", "fullaqscode", "parameter"]
REJECTED_KEYS = ["utc", "fullaqscode", "parameter"]

CLEANED_COLUMNS = [
    "parameter", "unit", "aqi", "category", "sitename", "agencyname", "latitude", "longitude", "fullaqscode",
    "date", "hour", "concern_level",
]
REJECTED_COLUMNS = [
    "parameter", "unit", "aqi", "category", "sitename", "agencyname", "latitude", "longitude", "fullaqscode",
    "intlaqscode", "utc", "original_file", "rejection_reason", "rejected_at",
]


def valid_readings(raw: DataFrame) -> DataFrame:
    """Valid readings with date, hour and level of concern, not yet deduplicated."""
    derived = {"date": reading_date(), "hour": reading_hour(), "concern_level": concern_level()}
    return raw.filter(is_valid_reading()).withColumns(derived)


def clean_readings(raw: DataFrame, tie_breakers: list[str] | None = None) -> DataFrame:
    """One reading per hour, site and pollutant: the one with the highest index.

    ``tie_breakers`` decide between equal indices; by default all other columns do.
    """
    extra = [name for name in tie_breakers or [] if name not in CLEANED_COLUMNS]
    valid = valid_readings(raw).select(*CLEANED_COLUMNS, *extra)
    best = total_order(valid, [F.col("aqi").desc()], CLEANED_KEYS, tie_breakers)
    return keep_best(valid, CLEANED_KEYS, best).select(*CLEANED_COLUMNS)


def clean_increment(
    raw: DataFrame,
    cleaned: DataFrame,
    mode: str = "incremental",
    lookback: str = "1 hour",
    start: str | None = None,
    end: str | None = None,
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """The rows to upsert into the cleaned table.

    ``incremental`` takes what lies after the watermark, ``backfill`` takes an inclusive time range regardless of it,
    ``full`` takes everything.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "incremental":
        raw = raw.filter(is_new_hour(reading_time(), cleaned, hour_timestamp(), lookback))
        if "date" in raw.columns:  # a partitioned bronze table: skip the folders before the watermark as well
            raw = raw.filter(F.col("date") >= F.to_date(high_watermark(cleaned, hour_timestamp(), lookback)))
    elif mode == "backfill":
        raw = raw.filter(in_range(reading_time(), start, end))
    return clean_readings(raw, tie_breakers)


def _marked(raw: DataFrame, row_id: str | None) -> DataFrame:
    """Readings with their rejection reason and the number of copies that lost to a better reading or to a copy.

    Rejected readings and duplicates are marked in one scan; a union of two branches would read everything twice.
    The rejected flag is part of the duplicate key, so a rejected reading never competes with valid ones.
    """
    if row_id is None:
        raw, row_id = identify_rows(raw), "row_id"
        copies = F.col("copies")
    else:
        copies = F.lit(1)
    flagged = raw.withColumns({"utc": reading_time(), "_rejected": is_rejected(), "_reason": rejection_reason()})
    order = [F.col("aqi").desc(), F.col(row_id)]
    marked = mark_losers(flagged, [*REJECTED_KEYS, "_rejected"], order, row_id)
    lost = F.when(F.col("is_loser"), copies).otherwise(copies - 1)
    return marked.withColumns({"_lost": lost, "_order": F.col(row_id)}).drop("is_loser")


def duplicate_losers(raw: DataFrame, row_id: str | None = None) -> DataFrame:
    """Valid readings beaten by another with the same exact time, site and pollutant.

    ``row_id`` names a unique column. Without one, identical readings are one row, and ``copies`` says how many of
    them have lost.
    """
    losers = _marked(raw.filter(~is_rejected()), row_id).filter("_lost > 0")
    if row_id is None:
        losers = losers.withColumn("copies", F.col("_lost"))
    return losers.select(*raw.columns, *(["copies"] if row_id is None else []), F.lit(DUPLICATE_LABEL).alias("rejection_reason"))


def reject_readings(raw: DataFrame, row_id: str | None = None, rejected_at: str | None = None) -> DataFrame:
    """Quarantine table: per time, site and pollutant the first rejected reading, with its reason.

    ``rejected_at`` is one value per run and cannot order anything; the row id does.
    """
    now = F.current_timestamp() if rejected_at is None else F.lit(rejected_at).cast("timestamp")
    quarantined = _marked(raw, row_id).filter(F.col("_rejected") | (F.col("_lost") > 0)).withColumns({
        "rejection_reason": F.when(F.col("_rejected"), F.col("_reason")).otherwise(DUPLICATE_LABEL),
        "rejected_at": now,
    })
    first = keep_best(quarantined, REJECTED_KEYS, [F.col("_order")])
    return first.select(*[name for name in REJECTED_COLUMNS if name in first.columns])


def reject_increment(
    raw: DataFrame, rejected: DataFrame, row_id: str | None = None, lookback: str = "1 hour", rejected_at: str | None = None
) -> DataFrame:
    """The rows to upsert into the quarantine table.

    The watermark is that of the quarantine table itself, at full time resolution. Readings without a time cannot be
    compared with it and always pass; the upsert's NULL-safe key keeps them from piling up.
    """
    fresh = raw.filter(is_new(reading_time(), rejected, F.col("utc"), lookback) | reading_time().isNull())
    if "date" in raw.columns:  # a partitioned bronze table: readings without a time are in its default partition
        first_date = F.to_date(high_watermark(rejected, F.col("utc"), lookback))
        fresh = fresh.filter((F.col("date") >= first_date) | F.col("date").isNull())
    return reject_readings(fresh, row_id, rejected_at)
