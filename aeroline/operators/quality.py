"""Data-quality checks. Each returns violations as a table; an empty result means the check passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: (column_name, violations)."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column_name", "violations")


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. Counts are combined before the shuffle, so a hot key costs nothing extra."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with another value; NULL is a matter of :func:`not_null`."""
    return df.filter(~F.col(column).isin(values))


def at_least(df: DataFrame, column: str, low) -> DataFrame:
    return df.filter(F.col(column) < F.lit(low))


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (a NULL key has none)."""
    return fact.join(dimension.select(key), key, "left_anti")


def orphan_counts(fact: DataFrame, dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(check_name, violations) for all keys of a fact table in one scan.

    ``dimensions`` maps a check name to (dimension, key). Facts are reduced to counts per distinct key before anything
    is joined, so neither a hot key nor the size of the fact table reaches the join.
    """
    names = list(dimensions)
    keys = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(dimensions[n][1]).alias("member")) for n in names])
    used = fact.select(F.inline(keys)).groupBy("check_name", "member").agg(F.count(F.lit(1)).alias("facts"))
    known = None
    for name, (dimension, key) in dimensions.items():
        members = dimension.select(F.lit(name).alias("check_name"), F.col(key).alias("member"), F.lit(True).alias("found"))
        known = members if known is None else known.unionByName(members)
    matched = used.join(known.distinct(), ["check_name", "member"], "left")
    missing = F.when(F.col("found").isNull(), F.col("facts")).otherwise(F.lit(0))
    return matched.groupBy("check_name").agg(F.sum(missing).alias("violations"))


def count_violations(checks: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations) for a set of violation tables."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, df in checks.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def failing_rows(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(check_name, violations) of any number of row conditions in one scan; a row fails where its condition is true."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    return counts.unpivot([], list(conditions), "check_name", "violations")


def count_differences(name: str, expected: DataFrame, found: DataFrame, groups: list[str]) -> DataFrame:
    """(check_name, violations): rows that ``found`` has too few or too many against ``expected``, summed over the groups.

    Counted group by group, so that a missing row and a row too many elsewhere do not cancel out. Both sides are reduced to
    counts per group before the shuffle.
    """
    signed = expected.select(*groups, F.lit(1).alias("one")).unionByName(found.select(*groups, F.lit(-1).alias("one")))
    balance = signed.groupBy(*groups).agg(F.sum("one").alias("balance"))
    return balance.agg(F.coalesce(F.sum(F.abs("balance")), F.lit(0)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def schema_differences(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """(column, expected type, found type) for every column that differs; needs no data."""
    found = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    wanted = {field.name: field.dataType.simpleString() for field in expected.fields}
    names = list(dict.fromkeys([*wanted, *found]))
    return [(n, wanted.get(n, "absent"), found.get(n, "absent")) for n in names if wanted.get(n) != found.get(n)]
