"""The canonical layers as stored tables, kept up to date by repeatable increments."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.fixed_values import CONCERN_LEVELS
from aeroline.functions.times import hour_timestamp, interval, next_hour, reading_time
from aeroline.operators import quality
from aeroline.operators.incremental import in_range, only_partitions, same_key
from aeroline.operators.merge import finish_swap, replace_partitions, upsert_table
from aeroline.operators.spatial import region_table
from aeroline.plans import gold, silver
from aeroline.plans.report import RunReport
from aeroline.session import at_once, remove_path, staged
from aeroline.sources.registry import quoted, register
from aeroline.sources.tables import database_for, newest_partition, partition_values, path_exists, read_table

DIMENSION_KEYS = {
    "dim_site": ["fullaqscode"],
    "dim_parameter": ["parameter", "unit"],
    "dim_category": ["category"],
    "dim_date": ["date"],
    "dim_hour": ["hour"],
}
KEY_COLUMNS = {
    "dim_site": "site_key",
    "dim_parameter": "parameter_key",
    "dim_category": "category_key",
    "dim_date": "date_key",
    "dim_hour": "hour_key",
}


#: What a reader of the star schema asks for, in one place.
READINGS_VIEW = """SELECT f.date, f.hour, s.fullaqscode, s.sitename, s.agencyname, s.latitude, s.longitude, s.region_key,
  p.parameter, p.unit, c.category, c.concern_level, f.aqi
FROM {gold}.fact_air_quality_readings f
JOIN {gold}.dim_site s ON f.site_key = s.site_key
JOIN {gold}.dim_parameter p ON f.parameter_key = p.parameter_key
JOIN {gold}.dim_category c ON f.category_key = c.category_key"""

NO_TIME = "1900-01-01"
PARTITIONED = {
    ("silver", "cleaned_readings"): ["date"],
    ("silver", "rejected_readings"): ["rejected_date"],
    ("gold", "fact_air_quality_readings"): ["date"],
}


class Warehouse:
    """Paths of the canonical tables. ``target="dev"`` keeps a development run apart."""

    def __init__(self, root: str, target: str = "prod"):
        self._root, self.target = root, target

    def path(self, layer: str, table: str) -> str:
        return f"{self._root}/{database_for(layer, self.target)}/{table}"

    @property
    def open_dates(self) -> str:
        """Dates that silver has changed and gold has not confirmed."""
        return f"{self._root}/state/{database_for('gold', self.target)}_open_dates"

    def recover(self, spark: SparkSession) -> None:
        """Finish swaps that an interrupted run has left; call it before the tables are read."""
        tables = {**PARTITIONED, **{("gold", name): [] for name in DIMENSION_KEYS}}
        for (layer, table), partition_by in tables.items():
            finish_swap(spark, self.path(layer, table), partition_by)


def update_silver(
    raw: DataFrame,
    warehouse: Warehouse,
    row_id: str | None = None,
    mode: str = "incremental",
    lookback: str = "1 hour",
    start: str | None = None,
    end: str | None = None,
    tie_breakers: list[str] | None = None,
    report: RunReport | None = None,
) -> None:
    """Upsert one increment into the cleaned and the quarantine table.

    Watermarks read the newest stored partition only. The dates of the increment are entered as open before the table
    changes, so gold finds them even if this run ends before it gets there.
    """
    spark = raw.sparkSession
    warehouse.recover(spark)
    cleaned_path = warehouse.path("silver", "cleaned_readings")
    cleaned = read_table(spark, cleaned_path, like=silver.clean_readings(raw))
    newest = newest_partition(cleaned, cleaned_path, "date")
    increment = silver.clean_increment(raw, newest, mode, lookback, start, end, tie_breakers)
    batch = staged(increment if report is None else report.rows_of("cleaned").of(increment), "increment")
    batch.select("date").distinct().write.mode("append").parquet(warehouse.open_dates)
    upsert_table(batch, cleaned_path, silver.CLEANED_KEYS, ["date"], is_stored=True)

    rejected_path = warehouse.path("silver", "rejected_readings")
    rejected = read_table(spark, rejected_path, like=_dated(silver.reject_readings(raw, row_id)))
    if mode == "incremental":
        fresh = silver.reject_increment(raw, newest_partition(rejected, rejected_path, "rejected_date"), row_id, lookback)
    elif mode == "backfill":
        fresh = silver.reject_readings(raw.filter(in_range(reading_time(), start, end)), row_id)
    else:
        fresh = silver.reject_readings(raw, row_id)
    fresh = _dated(fresh)
    if mode == "incremental":
        fresh = _changed(fresh, rejected, partition_values(spark, rejected_path, "rejected_date")[-1:])
    upsert_table(fresh, rejected_path, silver.REJECTED_KEYS, ["rejected_date"], counted=report and report.rows_of("rejected"))


def late_before(spark: SparkSession, warehouse: Warehouse, lookback: str = "1 hour") -> str | None:
    """The hour from which on an incremental run takes readings; None while nothing is stored."""
    path = warehouse.path("silver", "cleaned_readings")
    if not partition_values(spark, path, "date"):
        return None
    stored = newest_partition(spark.read.parquet(path), path, "date")
    return str(stored.agg(next_hour(F.max(hour_timestamp()) - interval(lookback))).first()[0])


def _dated(rejected: DataFrame) -> DataFrame:
    """Partition date of a rejected reading; those without a time share one fixed date, so equality finds it again."""
    return rejected.withColumn("rejected_date", F.coalesce(F.to_date("utc"), F.lit(NO_TIME).cast("date")))


def _changed(fresh: DataFrame, stored: DataFrame, newest: list[str]) -> DataFrame:
    """Rejected readings that are not stored as they are: those without a time pass every watermark, those of the newest
    hour come again, and neither is to be stamped anew."""
    again = stored.filter(F.col("rejected_date").isin([F.lit(day).cast("date") for day in {NO_TIME, *newest}]))
    names = [name for name in fresh.columns if name != "rejected_at"]
    known = again.select(*names)
    return fresh.join(known, same_key(fresh, known, names), "left_anti")


def open_dates(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The dates gold and the checks have to do: those of this run and of runs that did not get that far."""
    path = warehouse.open_dates
    entries = spark.read.schema("date DATE").parquet(path) if path_exists(spark, path) else spark.createDataFrame([], "date DATE")
    return staged(entries.distinct(), "open-dates")


def close_dates(spark: SparkSession, warehouse: Warehouse) -> None:
    """Everything that was open is in gold and checked."""
    remove_path(spark, warehouse.open_dates)


def _of_dates(table: DataFrame, dates: DataFrame | None) -> DataFrame:
    return table if dates is None else only_partitions(table, dates, ("date",))


FACT_RULES = ("insert", "rebuild")


def update_gold(
    spark: SparkSession, warehouse: Warehouse, regions: DataFrame | None = None, dates: DataFrame | None = None, facts: str = "insert",
    report: RunReport | None = None,
) -> None:
    """Insert new dimension members and bring the facts up to date from the cleaned table.

    ``dates`` (one column ``date``) restricts the work to those partitions; without them, the whole cleaned table is
    compared with what is stored. ``facts``: "insert" adds facts whose five keys are not stored yet, so a corrected index
    stays old and a corrected category adds a second fact beside the first. "rebuild" makes the facts of the dates anew
    from the cleaned readings and replaces their partitions, so that there is one fact per cleaned reading again; nothing
    is compared, and the facts of other dates are neither read nor written.
    """
    if facts not in FACT_RULES:
        raise ValueError(f"facts must be one of {FACT_RULES}")
    warehouse.recover(spark)
    cleaned = _of_dates(spark.read.parquet(warehouse.path("silver", "cleaned_readings")), dates)
    regions = region_table(spark) if regions is None else regions

    members = {
        "dim_parameter": gold.dim_parameter(cleaned),
        "dim_category": gold.dim_category(cleaned),
        "dim_date": gold.dim_date(cleaned),
        "dim_hour": gold.dim_hour(cleaned),
        "dim_site": gold.dim_site(cleaned, regions),
    }

    def insert_new(name: str, rows: DataFrame) -> None:
        known = read_table(spark, warehouse.path("gold", name), like=rows)
        if name == "dim_site":
            new = gold.new_sites(cleaned, known, regions)
        else:
            new = gold.new_dimension_rows(rows, known, DIMENSION_KEYS[name])
        upsert_table(new, warehouse.path("gold", name), DIMENSION_KEYS[name], [], counted=report and report.rows_of(name))

    at_once([partial(insert_new, name, rows) for name, rows in members.items()])

    table = {name: spark.read.parquet(warehouse.path("gold", name)) for name in DIMENSION_KEYS}
    candidates = gold.fact_readings(
        cleaned, table["dim_site"], table["dim_parameter"], table["dim_category"], table["dim_date"], table["dim_hour"]
    )
    fact_path = warehouse.path("gold", "fact_air_quality_readings")
    if facts == "rebuild":
        # Without given dates, stored ones that the cleaned table has lost are rebuilt to nothing too.
        stored = spark.createDataFrame([(day,) for day in partition_values(spark, fact_path, "date")], "date STRING").selectExpr("CAST(date AS DATE) AS date")
        touched = cleaned.select("date").unionByName(stored) if dates is None else dates
        replace_partitions(candidates, fact_path, "date", staged(touched.distinct(), "fact-dates"), counted=report and report.rows_of("facts"))
        return
    new = gold.new_fact_rows(candidates, read_table(spark, fact_path, like=candidates), cleaned)
    upsert_table(new, fact_path, ["date", *gold.FACT_KEYS], ["date"], counted=report and report.rows_of("facts"))


def validate(spark: SparkSession, warehouse: Warehouse, dates: DataFrame | None = None) -> DataFrame:
    """(check_name, violations) of all checks on the stored tables, or on some dates of them."""
    cleaned = _of_dates(spark.read.parquet(warehouse.path("silver", "cleaned_readings")), dates)
    fact = _of_dates(spark.read.parquet(warehouse.path("gold", "fact_air_quality_readings")), dates)
    required = ["date", "hour", "fullaqscode", "parameter", "unit", "aqi", "category", "latitude", "longitude", "concern_level"]
    cleaned_rows = {f"cleaned_{name}_not_null": F.col(name).isNull() for name in required}
    cleaned_rows["cleaned_category_values"] = ~F.col("category").isin(list(CONCERN_LEVELS))
    cleaned_rows["cleaned_aqi_range"] = F.col("aqi") < 0
    fact_rows = {f"fact_{name}_not_null": F.col(name).isNull() for name in [*gold.FACT_KEYS, "aqi"]}
    duplicates = {
        "cleaned_unique": quality.unique(cleaned, silver.CLEANED_KEYS),
        "fact_unique": quality.unique(fact, gold.FACT_KEYS),
    }
    results = [quality.failing_rows(cleaned, cleaned_rows), quality.failing_rows(fact, fact_rows)]
    dimensions = {}
    for name, key in KEY_COLUMNS.items():
        dimension = spark.read.parquet(warehouse.path("gold", name))
        dimensions[f"fact_{name}"] = (dimension, key)
        columns = [key, *DIMENSION_KEYS[name]]
        rules = {f"{name}_{column}_not_null": F.col(column).isNull() for column in columns}
        if name == "dim_category":
            rules["dim_category_category_values"] = ~F.col("category").isin(list(CONCERN_LEVELS))
            rules["dim_category_concern_level_not_null"] = F.col("concern_level").isNull()
        results.append(quality.failing_rows(dimension, rules))
        duplicates[f"{name}_key_unique"] = quality.unique(dimension, [key])
        duplicates[f"{name}_unique"] = quality.unique(dimension, DIMENSION_KEYS[name])
    results += [quality.count_violations(duplicates), quality.orphan_counts(fact, dimensions)]
    # A reading without a unit has no parameter to join and so no fact.
    results.append(quality.count_differences("fact_cleaned_counts", cleaned.filter(F.col("unit").isNotNull()), fact, ["date", "hour"]))
    return reduce(DataFrame.unionByName, results)


def register_tables(spark: SparkSession, warehouse: Warehouse, prefix: str = "") -> dict[str, str]:
    """All canonical tables that have rows so far, in a database per layer and target, and the view ``readings`` over the
    star schema. Returns their names."""
    names = {}
    for (layer, table), partition_by in {**PARTITIONED, **{("gold", name): [] for name in DIMENSION_KEYS}}.items():
        path = warehouse.path(layer, table)
        # A partitioned table that has had no row yet is an empty folder without a schema.
        if partition_values(spark, path, partition_by[0]) if partition_by else path_exists(spark, path):
            names[table] = f"{prefix}{database_for(layer, warehouse.target)}.{table}"
            register(spark, names[table], path, partition_by)
    gold = prefix + database_for("gold", warehouse.target)
    if {"fact_air_quality_readings", "dim_site", "dim_parameter", "dim_category"} <= set(names):
        names["readings"] = f"{gold}.readings"
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(names['readings'])} AS {READINGS_VIEW.format(gold=quoted(gold))}")
    return names


def star_of(cleaned: DataFrame, regions: DataFrame | None = None, tables: tuple[str, ...] = tuple(DIMENSION_KEYS)) -> dict[str, DataFrame]:
    """Staged cleaned table plus the named dimensions, for queries that start from raw readings.

    The expensive part (deduplication) runs once; dimensions come from column-pruned scans of the staged table.
    """
    cleaned = staged(cleaned, "cleaned")
    builders = {
        "dim_site": lambda: gold.dim_site(cleaned, region_table(cleaned.sparkSession) if regions is None else regions),
        "dim_parameter": lambda: gold.dim_parameter(cleaned),
        "dim_category": lambda: gold.dim_category(cleaned),
        "dim_date": lambda: gold.dim_date(cleaned),
        "dim_hour": lambda: gold.dim_hour(cleaned),
    }
    dimensions = at_once([partial(staged, builders[name](), name) for name in tables])
    return {"cleaned": cleaned, **dict(zip(tables, dimensions))}
