"""Config-driven column changes and flattening of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType, StructType


def lower_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def apply_column_plan(df: DataFrame, plan: dict) -> DataFrame:
    """Apply ``{"add": {name: sql}, "cast": {name: type}, "rename": {old: new}, "remove": [name]}``, in that order."""
    result = df.withColumns({name: F.expr(sql) for name, sql in plan.get("add", {}).items()})
    result = result.withColumns({name: F.col(name).cast(kind) for name, kind in plan.get("cast", {}).items()})
    result = result.withColumnsRenamed(plan.get("rename", {}))
    return result.drop(*plan.get("remove", []))


def json_fields(df: DataFrame, column: str) -> StructType:
    """The top-level fields of all objects in a JSON text column, each with a type that fits all its values.

    One aggregate over the column; only the merged schema reaches the driver. Values that are no objects or not JSON
    say nothing; a field with values of unlike types, or objects and lists in it, is VARIANT, one that is always null a
    string. No objects: no fields.
    """
    parsed = F.try_parse_json(column)
    kind = df.select(F.when(F.json_object_keys(column).isNotNull(), parsed).alias("_parsed"))
    found = kind.agg(F.schema_of_variant_agg("_parsed").alias("kind")).first().kind
    if not found or not found.startswith("OBJECT<"):
        return StructType()
    whole = DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
    fields = StructType()
    for field in whole:
        nested = field.dataType.typeName() in ("struct", "array")
        kind = "variant" if nested else "string" if isinstance(field.dataType, NullType) else field.dataType
        fields.add(field.name, kind)
    return fields


def flatten_json(df: DataFrame, column: str, schema: str | None = None, prefix: str = "") -> DataFrame:
    """Replace a JSON text column by one column per top-level field.

    Without ``schema`` the fields are those of :func:`json_fields`; the text is then parsed once per row into a VARIANT,
    and a value that is no object, or an object with a doubled key, gives NULL in every field.
    """
    if schema is None:
        fields = json_fields(df, column)
        parsed = df.withColumn("_parsed", F.try_parse_json(column))
        flat = [_field("_parsed", f.name, f.dataType.simpleString()).alias(f"{prefix}{f.name}") for f in fields]
        return parsed.select(*[name for name in df.columns if name != column], *flat)
    parsed = df.withColumn("_parsed", F.from_json(column, schema))
    fields = parsed.schema["_parsed"].dataType.fieldNames()
    flat = [F.col(f"_parsed.{field}").alias(f"{prefix}{field}") for field in fields]
    return parsed.select(*[name for name in df.columns if name != column], *flat)


def _field(column: str, name: str, kind: str) -> Column:
    """A field of a VARIANT object; a path cannot hold every quote, a map can."""
    if "'" not in name and '"' not in name:
        return F.try_variant_get(column, f"$['{name}']", kind)
    return F.try_variant_get(F.try_variant_get(column, "$", "map<string,variant>")[name], "$", kind)


def explode_json(df: DataFrame, column: str, schema: str, name: str) -> DataFrame:
    """One row per element of a JSON array column."""
    others = [other for other in df.columns if other != column]
    return df.select(*others, F.explode(F.from_json(column, schema)).alias(name))
