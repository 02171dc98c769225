"""Star schema: one fact table, six dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.functions.keys import surrogate_key
from aeroline.functions.readings import weekday_name
from aeroline.operators.incremental import new_members
from aeroline.operators.spatial import max_region

FACT_KEYS = ["date_key", "hour_key", "site_key", "parameter_key", "category_key"]
SITE_ATTRIBUTES = ["sitename", "agencyname", "latitude", "longitude"]


def dim_category(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("category", "concern_level").distinct().withColumn("category_key", surrogate_key("category"))


def dim_date(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("date").distinct().withColumn("date_key", surrogate_key("date"))


def dim_calendar(dates: DataFrame) -> DataFrame:
    """Calendar attributes of the days in ``dates`` (one column ``date`` at least): one row per day."""
    weekday = F.dayofweek("date")
    return dates.select("date").distinct().withColumns({
        "year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date"), "day_of_week": weekday, "day_of_week_name": weekday_name(weekday)})


def dim_hour(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("hour").distinct().withColumn("hour_key", surrogate_key("hour"))


def dim_parameter(cleaned: DataFrame) -> DataFrame:
    members = cleaned.select("parameter", "unit").distinct()
    return members.withColumn("parameter_key", surrogate_key("parameter", "unit"))


def dim_site(cleaned: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per site with the largest region key that holds it.

    The range join sees distinct sites, not readings. A site with several descriptions keeps one with a region if
    any has one, then the first in alphabetical order.
    """
    sites = cleaned.select("fullaqscode", *SITE_ATTRIBUTES).distinct()
    placed = max_region(sites, regions, ["fullaqscode"], SITE_ATTRIBUTES)
    keyed = placed.withColumn("site_key", surrogate_key("fullaqscode"))
    return keyed.select("fullaqscode", *SITE_ATTRIBUTES, "site_key", "region_key")


def new_sites(cleaned: DataFrame, known: DataFrame, regions: DataFrame) -> DataFrame:
    """Sites that are new or have moved; a new name alone does not refresh a site."""
    members = cleaned.select("fullaqscode", *SITE_ATTRIBUTES).distinct()
    return dim_site(new_members(members, known, ["fullaqscode", "latitude", "longitude"]), regions)


def new_dimension_rows(members: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only increment of a dimension."""
    return new_members(members, known, keys)


def with_fact_id(fact: DataFrame) -> DataFrame:
    """``date`` stays beside its key: a hash cannot prune partitions."""
    return fact.withColumn("fact_id", surrogate_key(*FACT_KEYS)).select(*FACT_KEYS, "fact_id", "aqi", "date", "hour")


def fact_readings(
    cleaned: DataFrame,
    sites: DataFrame,
    parameters: DataFrame,
    categories: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
) -> DataFrame:
    """Cleaned readings with the keys of five dimensions; a reading without a member in one of them is left out.

    Pass stored (or staged) dimensions: Spark then knows their size and broadcasts those below its threshold.
    """
    joined = (
        cleaned.select("fullaqscode", "parameter", "unit", "category", "date", "hour", "aqi")
        .join(sites.select("fullaqscode", "site_key"), "fullaqscode")
        .join(parameters.select("parameter", "unit", "parameter_key"), ["parameter", "unit"])
        .join(categories.select("category", "category_key"), "category")
        .join(dates.select("date", "date_key"), "date")
        .join(hours.select("hour", "hour_key"), "hour")
    )
    return with_fact_id(joined)


def fact_readings_direct(cleaned: DataFrame) -> DataFrame:
    """The same fact table for a full load, without any join.

    Keys are hashes of the member's own columns, and dimensions built from the same cleaned table hold every member.
    Only a reading without a unit has no parameter row to join and is left out.
    """
    keys = {
        "date_key": surrogate_key("date"),
        "hour_key": surrogate_key("hour"),
        "site_key": surrogate_key("fullaqscode"),
        "parameter_key": surrogate_key("parameter", "unit"),
        "category_key": surrogate_key("category"),
    }
    return with_fact_id(cleaned.filter(F.col("unit").isNotNull()).withColumns(keys))


def new_fact_rows(candidates: DataFrame, known: DataFrame, dated: DataFrame | None = None) -> DataFrame:
    """Facts whose five keys are not stored yet.

    The stored side is restricted to the dates of the candidates, so its partitions are pruned and the cost follows
    the increment, not the table. ``dated`` may name a cheaper table with the same dates, such as the one the
    candidates were built from. The date follows from the date key, so joining on it too changes nothing.
    """
    dates = candidates if dated is None else dated
    low, high = dates.agg(F.min("date")).scalar(), dates.agg(F.max("date")).scalar()
    relevant = known.filter(F.col("date").between(low, high))
    return new_members(candidates, relevant, ["date", *FACT_KEYS])
