"""Domain columns of a reading."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroline.fixed_values import (
    CONCERN_LEVELS,
    INVALID_NUMBER,
    NO_REGION,
    POLLUTANT_NAMES,
    REGIONS,
    REJECTION_LABELS,
    WEEKDAY_NAMES,
)
from aeroline.functions.times import reading_time

NUMBERS = ["aqi", "category"]
REQUIRED = ["aqi", "category", "fullaqscode", "parameter", "latitude", "longitude"]


def lookup(values: dict, key: Column) -> Column:
    """Literal map lookup; an unknown key gives NULL."""
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.create_map(*pairs)[key]


def concern_level(category: str = "category") -> Column:
    return lookup(CONCERN_LEVELS, F.col(category))


def weekday_name(day_of_week: Column) -> Column:
    return lookup(WEEKDAY_NAMES, day_of_week)


def is_valid_reading() -> Column:
    """Keeps a reading with real numbers and all fields the cleaned table needs.

    ``intlaqscode`` is deliberately not among them, while :func:`is_rejected` does test it: a reading that lacks
    only that code is in the cleaned *and* in the quarantine table.
    """
    numbers = [F.col(name) != INVALID_NUMBER for name in NUMBERS]
    present = [F.col(name).isNotNull() for name in REQUIRED]
    return reduce(and_, [*numbers, *present, reading_time().isNotNull()])


def is_rejected() -> Column:
    """True for a reading that belongs in quarantine; never NULL."""
    numbers = [F.col(name) == INVALID_NUMBER for name in NUMBERS]
    missing = [F.col(name).isNull() for name in [*REQUIRED, "intlaqscode"]]
    return F.coalesce(reduce(or_, [*missing, *numbers, reading_time().isNull()]), F.lit(False))


def rejection_reason() -> Column:
    """First label, in order of precedence, whose condition holds.

    Site and agency labels exist although a missing site or agency alone does not reject a reading; they only name
    the reason of readings that something further down the list rejects.
    """
    def holds(label: str, name: str) -> Column:
        if label.startswith("INVALID"):
            return F.col(name) == INVALID_NUMBER
        return (reading_time() if name == "utc" else F.col(name)).isNull()

    return F.coalesce(*[F.when(holds(label, name), F.lit(label)) for label, name in REJECTION_LABELS])


def wanted_pollutant(codes: list[str], parameter: str = "parameter") -> Column:
    """Filter on request codes, which differ from the names in the data (PM25 / PM2.5)."""
    return F.col(parameter).isin([POLLUTANT_NAMES[code] for code in codes])


def within(latitude: Column, longitude: Column, lat_min, lat_max, lon_min, lon_max) -> Column:
    """Inclusive box test."""
    return latitude.between(lat_min, lat_max) & longitude.between(lon_min, lon_max)


def assign_region(latitude: str = "latitude", longitude: str = "longitude", regions=None, default: str = NO_REGION) -> Column:
    """First region, in order of precedence, whose box holds the point; a plain expression, so no join at all."""
    lat, lon = F.col(latitude), F.col(longitude)
    boxes = REGIONS if regions is None else regions
    matches = [F.when(within(lat, lon, *(F.lit(bound) for bound in bounds)), F.lit(name)) for name, *bounds in boxes]
    return F.coalesce(*matches, F.lit(default))
