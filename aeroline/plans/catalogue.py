"""Every operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``.

All queries run over whole tables. Dates and timestamps are returned as ISO text, so results compare the same
whichever engine produced them; means are rounded, because the order of additions differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroline.functions.readings import assign_region, is_rejected, rejection_reason, wanted_pollutant
from aeroline.functions.times import hour_timestamp
from aeroline.operators import backfill, columns, incremental, merge, quality, series, spatial, trends
from aeroline.plans import files, gold, job, silver
from aeroline.plans.report import SCHEMA as REPORT, drain
from aeroline.plans.warehouse import KEY_COLUMNS, Warehouse, close_dates, open_dates, star_of, update_gold, update_silver, validate
from aeroline.session import staged, work_path
from aeroline.sources import landing, messages, progress, registry, tables
from aeroline.sources.event_readings import events_path, feed_records, hourly_stamped, raw_readings, to_readings
from aeroline.streaming.joins import (
    final_watermark, interval_join, join_windows, open_events, open_windows, windowed_counts, with_rest, with_state_partitions,
    write_closed, write_closed_windows,
)
from aeroline.streaming.landing import landing_to_bronze, records_to_landing
from aeroline.streaming.once import append_once, read_appended, rejects_to_quarantine
from aeroline.streaming.silver import readings_to_silver

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TIE = ["event_id"]
RUN_TIME = "2024-02-01 00:00:00"
SERIES_START, SERIES_END = "2024-01-10", "2024-01-16"
SERIES_PARAMETER = "PM2.5"
LOCAL_START, LOCAL_END = "2024-01-11 00:00:00", "2024-01-12 23:59:59"
MEAN_DIGITS = 6


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text."""
    def text(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return F.col(field.name).cast("string").alias(field.name) if isinstance(field.dataType, T.DateType) else F.col(field.name)

    return df.select(*[text(field) for field in df.schema.fields])


def rounded(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.round(name, MEAN_DIGITS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def last_day(raw: DataFrame) -> Column:
    """Start of the last day: what comes before it plays the role of data loaded earlier."""
    return raw.agg(F.to_date(F.max("utc")).cast("timestamp_ntz")).scalar()


def loaded_earlier(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("utc") < last_day(raw))


def bronze_of(raw: DataFrame) -> DataFrame:
    return landing.with_partitions(feed_records(raw))


# --- silver ---------------------------------------------------------------------------------------------------------


@query
def cleaned_readings(spark, sf_dir):
    return plain(silver.clean_readings(raw_readings(spark, sf_dir), TIE))


@query
def cleaned_spark_variant(spark, sf_dir):
    return plain(files.clean_bronze(bronze_of(raw_readings(spark, sf_dir))))


@query
def rejected_readings(spark, sf_dir):
    raw = hourly_stamped(raw_readings(spark, sf_dir))
    return plain(silver.reject_readings(raw, "event_id", RUN_TIME))


@query
def rejection_counts(spark, sf_dir):
    rejected = silver.reject_readings(hourly_stamped(raw_readings(spark, sf_dir)), "event_id", RUN_TIME)
    return rejected.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("readings"))


@query
def duplicate_losers(spark, sf_dir):
    losers = silver.duplicate_losers(hourly_stamped(raw_readings(spark, sf_dir)), "event_id")
    return plain(losers.select("event_id", "utc", "fullaqscode", "parameter", "aqi", "category", "rejection_reason"))


# --- dimensions and facts -------------------------------------------------------------------------------------------


@query
def dim_category(spark, sf_dir):
    return gold.dim_category(silver.clean_readings(raw_readings(spark, sf_dir), TIE))


@query
def dim_parameter(spark, sf_dir):
    return gold.dim_parameter(silver.clean_readings(raw_readings(spark, sf_dir), TIE))


# Date and hour are part of the deduplication key, so their members are the same before and after it.
@query
def dim_date(spark, sf_dir):
    return plain(gold.dim_date(silver.valid_readings(raw_readings(spark, sf_dir))))


@query
def dim_hour(spark, sf_dir):
    return gold.dim_hour(silver.valid_readings(raw_readings(spark, sf_dir)))


@query
def dim_calendar(spark, sf_dir):
    keyed = files.with_reading_keys(files.valid_bronze(bronze_of(raw_readings(spark, sf_dir))))
    return plain(files.calendar_rows(keyed))


@query
def dim_site_region(spark, sf_dir):
    return gold.dim_site(silver.clean_readings(raw_readings(spark, sf_dir), TIE), spatial.region_table(spark))


@query
def dim_site_by_intl_code(spark, sf_dir):
    return files.site_rows(files.with_reading_keys(files.clean_bronze(bronze_of(raw_readings(spark, sf_dir)))))


@query
def fact_readings(spark, sf_dir):
    star = star_of(silver.clean_readings(raw_readings(spark, sf_dir), TIE))
    return plain(
        gold.fact_readings(
            star["cleaned"], star["dim_site"], star["dim_parameter"], star["dim_category"], star["dim_date"], star["dim_hour"]
        )
    )


@query
def fact_readings_direct(spark, sf_dir):
    return plain(gold.fact_readings_direct(silver.clean_readings(raw_readings(spark, sf_dir), TIE)))


@query
def fact_keys_reading_grain(spark, sf_dir):
    keyed = files.with_reading_keys(files.clean_bronze(bronze_of(raw_readings(spark, sf_dir))))
    return plain(files.reading_facts(keyed))


# --- increments -----------------------------------------------------------------------------------------------------


@query
def incremental_silver_batch(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    target = silver.valid_readings(loaded_earlier(raw))
    return plain(silver.clean_increment(raw, target, "incremental", tie_breakers=TIE))


@query
def incremental_backfill_batch(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    target = silver.valid_readings(raw)
    return plain(
        silver.clean_increment(raw, target, "backfill", start=LOCAL_START, end=LOCAL_END, tie_breakers=TIE)
    )


@query
def incremental_rejected_batch(spark, sf_dir):
    raw = hourly_stamped(raw_readings(spark, sf_dir))
    stored = silver.reject_readings(loaded_earlier(raw), "event_id", RUN_TIME)
    return plain(silver.reject_increment(raw, stored, "event_id", rejected_at=RUN_TIME))


@query
def late_rows(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    target = silver.valid_readings(loaded_earlier(raw))
    return incremental.late_row_count(raw, target, hour_timestamp())


@query
def new_dim_members_not_in(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    known = gold.dim_date(silver.valid_readings(loaded_earlier(raw)))
    return plain(gold.new_dimension_rows(gold.dim_date(silver.valid_readings(raw)), known, ["date"]))


@query
def new_fact_rows_not_exists(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    candidates = gold.fact_readings_direct(silver.clean_readings(raw, TIE))
    known = gold.fact_readings_direct(silver.clean_readings(loaded_earlier(raw), TIE))
    return plain(gold.new_fact_rows(candidates, known, silver.valid_readings(raw)))


@query
def upsert_by_key(spark, sf_dir):
    """A stored table of everything before the last day, into which the last increment is merged."""
    raw = raw_readings(spark, sf_dir)
    path = work_path(spark, "cleaned-table")
    tables.write_partitioned(silver.clean_readings(loaded_earlier(raw), TIE), path, ["date"])
    stored = spark.read.parquet(path)
    merge.upsert_table(silver.clean_increment(raw, stored, tie_breakers=TIE), path, silver.CLEANED_KEYS, ["date"])
    return plain(spark.read.parquet(path).select(*silver.CLEANED_COLUMNS))


@query
def unprocessed_partitions(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    dated = landing.with_partitions(raw, "utc").filter("date IS NOT NULL")
    earlier = landing.with_partitions(loaded_earlier(raw), "utc")
    return plain(incremental.unprocessed_partitions(dated, earlier))


# --- series ---------------------------------------------------------------------------------------------------------


def _star_for_series(spark, sf_dir, *dimensions):
    # Date and pollutant are part of the key that duplicates are told by, so what is not asked for can go first.
    wanted = (F.col("parameter") == SERIES_PARAMETER) & (F.col("utc") >= F.lit(SERIES_START).cast("timestamp_ntz")) & (
        F.col("utc") < F.date_add(F.lit(SERIES_END).cast("date"), 1).cast("timestamp_ntz"))
    star = star_of(silver.clean_readings(raw_readings(spark, sf_dir).filter(wanted), TIE), tables=dimensions)
    return gold.fact_readings_direct(star["cleaned"]), star


def _hourly(spark, sf_dir):
    fact, star = _star_for_series(spark, sf_dir, "dim_parameter")
    return series.hourly_mean(fact, star["dim_parameter"], SERIES_PARAMETER, SERIES_START, SERIES_END)


def _site_hourly(spark, sf_dir):
    fact, star = _star_for_series(spark, sf_dir, "dim_parameter", "dim_site")
    return series.site_hourly_mean(fact, star["dim_parameter"], star["dim_site"], SERIES_PARAMETER, SERIES_START, SERIES_END)


@query
def hourly_mean_aqi(spark, sf_dir):
    return plain(rounded(_hourly(spark, sf_dir), "avg_aqi").orderBy("date", "hour"))


@query
def site_hourly_mean(spark, sf_dir):
    return plain(rounded(_site_hourly(spark, sf_dir), "avg_aqi").orderBy("date", "hour"))


@query
def local_time_window(spark, sf_dir):
    local = series.local_range(series.with_local_time(_hourly(spark, sf_dir)), LOCAL_START, LOCAL_END)
    return plain(rounded(local, "avg_aqi"))


@query
def region_first_match(spark, sf_dir):
    sites = raw_readings(spark, sf_dir).groupBy("sitename", "latitude", "longitude").agg(F.count(F.lit(1)).alias("readings"))
    return sites.withColumn("region", assign_region())


@query
def regional_mean_of_means(spark, sf_dir):
    local = series.local_range(series.with_local_time(_site_hourly(spark, sf_dir)), LOCAL_START, LOCAL_END)
    return plain(rounded(series.regional_mean(local), "avg_aqi"))


@query
def bbox_membership(spark, sf_dir):
    points = raw_readings(spark, sf_dir).groupBy("sitename", "latitude", "longitude").agg(F.count(F.lit(1)).alias("readings"))
    return spatial.join_boxes(points, spatial.box_table(spark))


@query
def pollutant_filter(spark, sf_dir):
    wanted = raw_readings(spark, sf_dir).filter(wanted_pollutant(["PM25", "OZONE"]))
    return wanted.groupBy("parameter", "unit").agg(F.count(F.lit(1)).alias("readings"))


# --- data quality ---------------------------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    names = ["utc", "parameter", "unit", "aqi", "category", "fullaqscode", "intlaqscode", "sitename", "agencyname",
             "latitude", "longitude"]
    return quality.not_null(raw_readings(spark, sf_dir), names)


@query
def dq_unique(spark, sf_dir):
    return quality.unique(raw_readings(spark, sf_dir), ["fullaqscode"])


@query
def dq_unique_combination(spark, sf_dir):
    return plain(quality.unique(silver.valid_readings(raw_readings(spark, sf_dir)), silver.CLEANED_KEYS))


@query
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(raw_readings(spark, sf_dir), "category", [1, 2, 3, 4, 5, 6]).select("event_id", "category")


@query
def dq_range(spark, sf_dir):
    return quality.at_least(raw_readings(spark, sf_dir), "aqi", 0).select("event_id", "aqi")


@query
def dq_orphan_rows(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    dates = staged(gold.dim_date(silver.valid_readings(loaded_earlier(raw))), "dim_date")
    fact = gold.fact_readings_direct(silver.clean_readings(raw, TIE))
    return plain(quality.orphans(fact, dates, "date_key").select("fact_id", "date_key", "date", "hour", "aqi"))


@query
def dq_orphans(spark, sf_dir):
    """Facts of all days against dimensions that stop before the last day."""
    raw = raw_readings(spark, sf_dir)
    star = star_of(silver.clean_readings(loaded_earlier(raw), TIE))
    fact = gold.fact_readings_direct(silver.clean_readings(raw, TIE))
    return quality.orphan_counts(fact, {name: (star[name], key) for name, key in KEY_COLUMNS.items()})


@query
def stage_reconciliation(spark, sf_dir):
    """Readings per stage from one scan, plus what deduplication kept; the parts must add up."""
    raw = raw_readings(spark, sf_dir)
    rejected = is_rejected()
    valid = silver.is_valid_reading()
    parts = raw.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(valid).alias("valid"),
        F.count_if(rejected).alias("rejected"),
        F.count_if(valid & rejected).alias("in_both"),
    )
    kept = silver.valid_readings(raw).select(*silver.CLEANED_KEYS).distinct().agg(F.count(F.lit(1))).scalar()
    balanced = F.col("valid") + F.col("rejected") - F.col("in_both") == F.col("raw")
    return parts.withColumns({"cleaned": kept, "merged_away": F.col("valid") - kept, "adds_up": balanced})


# --- messages, landing, backfill ------------------------------------------------------------------------------------


@query
def kafka_rows(spark, sf_dir):
    return messages.to_messages(feed_records(raw_readings(spark, sf_dir)))


@query
def kafka_round_trip(spark, sf_dir):
    return columns.lower_case(messages.from_messages(messages.to_messages(feed_records(raw_readings(spark, sf_dir)))))


@query
def user_event_messages(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return messages.keyed_messages(events, F.col("user_id").cast("string"))


@query
def transaction_event_messages(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", price)
    return messages.keyed_messages(orders, F.col("o_custkey").cast("string"))


def api_bodies(events: DataFrame) -> DataFrame:
    """One API body per event: a list of readings, an error object, another object, or text that is not JSON."""
    body = F.expr("""
        CASE event_type
          WHEN 'error' THEN concat('{"WebServiceError": [{"Message": "failed ', event_id, '"}]}')
          WHEN 'signup' THEN concat('<html>', event_id, '</html>')
          WHEN 'purchase' THEN props
          WHEN 'view' THEN concat('[{"SiteName": "Site ', user_id, '", "AQI": ', CAST(floor(value) AS INT), '},',
                                  ' {"SiteName": "Next ', user_id, '", "Extra": 1}]')
          ELSE concat('[{"SiteName": "Site ', user_id, '", "AQI": ', CAST(floor(value) AS INT), '}]')
        END""")
    return events.select("event_id", body.alias("body"))


@query
def api_payload_rows(spark, sf_dir):
    rows = landing.body_rows(api_bodies(table(spark, sf_dir, "events")))
    return rows.select("event_id", F.col("SiteName").alias("sitename"), F.col("AQI").alias("aqi"))


@query
def api_payload_failures(spark, sf_dir):
    failed = landing.failed_bodies(api_bodies(table(spark, sf_dir, "events")))
    return failed.select("event_id", "status", "error_message")


@query
def progress_min_date(spark, sf_dir):
    oldest = progress.oldest_of(feed_records(raw_readings(spark, sf_dir)))
    return progress.is_done(oldest).withColumn("oldest_loaded", F.date_format("oldest_loaded", "yyyy-MM-dd'T'HH:mm"))


@query
def backfill_windows(spark, sf_dir):
    return backfill.backfill_windows(progress.oldest_of(feed_records(raw_readings(spark, sf_dir))))


@query
def backfill_next_window(spark, sf_dir):
    return backfill.next_window(progress.oldest_of(feed_records(raw_readings(spark, sf_dir))), RUN_TIME)


@query
def coverage_gaps(spark, sf_dir):
    return plain(backfill.coverage_gaps(raw_readings(spark, sf_dir)))


@query
def landing_counts(spark, sf_dir):
    return landing.landing_counts(feed_records(raw_readings(spark, sf_dir)))


@query
def delivery_outcomes(spark, sf_dir):
    """Good lines, lines with a bad field and broken lines through the landing zone: what becomes of each."""
    raw = raw_readings(spark, sf_dir)
    record = F.to_json(F.struct(*feed_records(raw).columns), {"ignoreNullFields": "false"})
    lines = feed_records(raw).select(record.alias("line")).withColumn("n", F.get_json_object("line", "$.UTC"))
    bad = F.regexp_replace("line", '"Latitude":[0-9.]+', '"Latitude":"n/a"')
    line = F.when(F.col("n").endswith("7"), bad).when(F.col("n").endswith("9"), F.concat(F.lit("{broken "), "line")).otherwise(F.col("line"))
    path = work_path(spark, "delivery")
    lines.select(line.alias("value")).write.text(path)
    read = staged(landing.read_json_lines(spark, path), "delivery-lines")
    records = columns.lower_case(landing.readable(read))
    outcome = F.when(is_rejected(), rejection_reason()).otherwise(F.lit("valid"))
    counted = records.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))
    broken = landing.unreadable(read).agg(F.lit("quarantined").alias("outcome"), F.count(F.lit(1)).alias("lines"))
    return counted.unionByName(broken)


# --- file-based layers and streams ----------------------------------------------------------------------------------


@query
def bronze_partitions(spark, sf_dir):
    """Landing files to bronze and back: readings per partition, with the folder date as lineage."""
    layout = files.Layout(work_path(spark, "bronze"))
    landing.write_landing(feed_records(raw_readings(spark, sf_dir)), layout.landing)
    files.raw_to_bronze(spark, layout)
    stored = landing.path_partitions(spark.read.parquet(layout.file_bronze))
    counted = stored.groupBy("date", "hour", "path_date").agg(F.count(F.lit(1)).alias("readings"))
    return plain(counted)


@query
def medallion_two_deliveries(spark, sf_dir):
    """Two deliveries that share their hours: the second brings readings of hours that are stored already."""
    layout = files.Layout(work_path(spark, "deliveries"))
    raw = raw_readings(spark, sf_dir)
    for part in (0, 1):
        landing.write_landing(feed_records(raw.filter(F.col("event_id") % 2 == part)), layout.landing)
        files.raw_to_bronze(spark, layout)
        files.bronze_to_silver(spark, layout)
        files.silver_to_gold(spark, layout)
    fact = spark.read.parquet(layout.gold("fact_air_quality_readings"))
    return plain(fact.select("fact_id", "date", "hour", "site_key", "parameter_key", "date_key", "category_key", "aqi"))


@query
def medallion_fact(spark, sf_dir):
    """Landing to gold through stored files, in one run."""
    layout = files.Layout(work_path(spark, "medallion"))
    landing.write_landing(feed_records(raw_readings(spark, sf_dir)), layout.landing)
    files.raw_to_bronze(spark, layout)
    files.bronze_to_silver(spark, layout)
    files.silver_to_gold(spark, layout)
    fact = spark.read.parquet(layout.gold("fact_air_quality_readings"))
    return plain(fact.select("fact_id", "date", "hour", "site_key", "parameter_key", "date_key", "category_key", "aqi"))


@query
def warehouse_fact(spark, sf_dir):
    """Stored canonical tables after two increments: everything before the last day, then the rest."""
    raw = hourly_stamped(raw_readings(spark, sf_dir))
    warehouse = Warehouse(work_path(spark, "warehouse"))
    update_silver(loaded_earlier(raw), warehouse, "event_id", tie_breakers=TIE)
    update_gold(spark, warehouse)
    update_silver(raw, warehouse, "event_id", tie_breakers=TIE)
    update_gold(spark, warehouse)
    fact = spark.read.parquet(warehouse.path("gold", "fact_air_quality_readings"))
    return plain(fact.select(*gold.FACT_KEYS, "fact_id", "aqi", "date", "hour"))


def _corrections(raw: DataFrame) -> DataFrame:
    """Readings issued again: some with a higher index, some that have moved up a category as well."""
    moved = F.col("event_id") % 13 == 0
    again = raw.filter(((F.col("event_id") % 11 == 0) | moved) & (F.col("aqi") > 0) & (F.col("category") > 0))
    return again.withColumns({
        "event_id": -F.col("event_id"),
        "aqi": F.col("aqi") + F.when(moved, 60).otherwise(10),
        "category": F.when(moved, F.least(F.col("category") + 1, F.lit(6))).otherwise(F.col("category")),
    })


def _corrected_warehouse(spark, sf_dir) -> Warehouse:
    """A loaded warehouse whose cleaned readings of a week have then been corrected by a backfill; gold has not followed yet."""
    raw = hourly_stamped(raw_readings(spark, sf_dir))
    warehouse = Warehouse(work_path(spark, "corrected"))
    update_silver(raw, warehouse, "event_id", "full", tie_breakers=TIE)
    update_gold(spark, warehouse)
    close_dates(spark, warehouse)
    first, last = f"{SERIES_START} 00:00:00", f"{SERIES_END} 23:59:59"
    update_silver(raw.unionByName(_corrections(raw)), warehouse, "event_id", "backfill", start=first, end=last, tie_breakers=TIE)
    return warehouse


@query
def reprocessed_facts(spark, sf_dir):
    """Corrected indices and categories reach the facts: the dates a backfill has touched are rebuilt and replaced."""
    warehouse = _corrected_warehouse(spark, sf_dir)
    update_gold(spark, warehouse, dates=open_dates(spark, warehouse), facts="rebuild")
    fact = spark.read.parquet(warehouse.path("gold", "fact_air_quality_readings"))
    return plain(fact.select(*gold.FACT_KEYS, "fact_id", "aqi", "date", "hour"))


@query
def reprocessing_checks(spark, sf_dir):
    """Facts too few or too many against the cleaned readings, after inserting new facts only and after the rebuild."""
    warehouse = _corrected_warehouse(spark, sf_dir)
    dates = open_dates(spark, warehouse)
    counts = []
    for rule in ("insert", "rebuild"):
        update_gold(spark, warehouse, dates=dates, facts=rule)
        found = validate(spark, warehouse, dates).filter("check_name = 'fact_cleaned_counts'")
        counts.append(staged(found.select(F.lit(rule).alias("facts"), "violations"), "counts"))
    return counts[0].unionByName(counts[1])


@query
def job_end_to_end(spark, sf_dir):
    """Messages, some of them broken, through the whole job: rows of every stage."""
    root = work_path(spark, "job")
    sent = messages.to_messages(feed_records(raw_readings(spark, sf_dir)))
    broken = F.get_json_object("value", "$.UTC").endswith("9")
    sent = sent.withColumn("value", F.when(broken, F.concat(F.lit("{broken "), "value")).otherwise(F.col("value")))
    sent.write.parquet(f"{root}/inbox")
    stream = spark.readStream.schema("key STRING, value STRING").parquet(f"{root}/inbox")
    job.run_canonical(spark, job.parse_arguments(["--root", root]), stream)
    layout, stored = files.Layout(root), Warehouse(root)
    counts = [
        spark.read.parquet(path).agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("rows"))
        for stage, path in [
            ("messages", f"{root}/inbox"), ("bronze", layout.bronze), ("cleaned", stored.path("silver", "cleaned_readings")),
            ("rejected", stored.path("silver", "rejected_readings")), ("facts", stored.path("gold", "fact_air_quality_readings"))]]
    quarantined = spark.read.schema("key STRING, value STRING").json(layout.broken)
    return reduce(DataFrame.unionByName, [*counts, quarantined.agg(F.lit("broken").alias("stage"), F.count(F.lit(1)).alias("rows"))])


@query
def job_report(spark, sf_dir):
    """The report of a second run whose delivery is partly late, with indices that are text in every other record."""
    layout = files.Layout(work_path(spark, "reported"))
    raw = raw_readings(spark, sf_dir)
    records = feed_records(raw, "event_id")
    value = F.to_json(F.struct(*[name for name in records.columns if name != "event_id"]), {"ignoreNullFields": "false"})
    lines = records.select("event_id", value.alias("value"))
    text = F.when(F.col("event_id") % 2 == 0, F.regexp_replace("value", '"AQI":(-?[0-9]+)', '"AQI":"$1 units"')).otherwise(F.col("value"))
    root = layout.landing.rsplit("/landing/", 1)[0]
    for run, part in (("first", lines.filter("event_id % 17 <> 0")), ("second", lines.filter("event_id % 17 = 0").withColumn("value", text))):
        part.select("value").write.mode("append").text(layout.landing)
        job.run_canonical(spark, job.parse_arguments(["--root", root, "--run-id", run]))
    report = spark.read.schema(REPORT).json(layout.reports)
    return report.filter("run_id = 'second' AND stage IN ('bronze', 'cleaned')").select("stage", "metric", "value")


@query
def history_windows(spark, sf_dir):
    """History loaded backwards in windows, by two runs: what each window has brought."""
    layout = files.Layout(work_path(spark, "history"))
    landing.write_landing(feed_records(raw_readings(spark, sf_dir)), layout.landing)
    root = layout.landing.rsplit("/landing/", 1)[0]
    for windows in (["--windows", "2"], []):
        job.run_canonical(spark, job.parse_arguments(
            ["--root", root, "--mode", "history", "--today", "2024-02-01", "--until", "2023-12-25T00:00", *windows]))
    report = spark.read.schema(REPORT).json(layout.reports).withColumn("at", F.split("stage", " "))
    found = report.filter("size(at) = 2 AND at[1] IN ('cleaned', 'facts') AND metric = 'rows'")
    wide = found.groupBy(F.col("at")[0].alias("window_start")).agg(
        *[F.max(F.when(F.col("at")[1] == stage, F.col("value").cast("long"))).alias(stage) for stage in ("cleaned", "facts")])
    return wide


def _fresh_prefix(path: str) -> str:
    """Databases of its own for a query, so that it meets no other run's tables."""
    return f"q_{path.rsplit('-', 1)[-1]}_"


@query
def catalogue_readings(spark, sf_dir):
    """A development run's star schema as readers see it: by name, in the target's database, through the view."""
    root = work_path(spark, "registered")
    landing.write_landing(feed_records(raw_readings(spark, sf_dir)), files.Layout(root).landing)
    prefix = _fresh_prefix(root)
    job.run_canonical(spark, job.parse_arguments(["--root", root, "--target", "dev", "--catalogue", prefix]))
    return plain(spark.table(f"{prefix}test_gold.readings"))


@query
def listed_unprocessed_partitions(spark, sf_dir):
    """Hours that one table has and another lacks, from the catalogue's lists of partitions."""
    dated = landing.with_partitions(raw_readings(spark, sf_dir), "utc").select("event_id", "utc", "date", "hour")
    root = work_path(spark, "listed")
    prefix = _fresh_prefix(root)
    for name, rows in (("source", dated), ("target", loaded_earlier(dated))):
        tables.write_partitioned(rows, f"{root}/{name}", ["date", "hour"])
        registry.register(spark, f"{prefix}bronze.{name}", f"{root}/{name}", ["date", "hour"])
    return plain(registry.unprocessed(spark, f"{prefix}bronze.source", f"{prefix}bronze.target", ("date", "hour")))


def _stored_facts(spark, sf_dir) -> DataFrame:
    path = work_path(spark, "facts-by-date")
    tables.write_partitioned(gold.fact_readings_direct(silver.clean_readings(raw_readings(spark, sf_dir), TIE)), path, ["date"])
    return spark.read.parquet(path)


@query
def weekday_hourly_mean(spark, sf_dir):
    """Mondays only: the calendar says which partitions of the facts are read."""
    fact = _stored_facts(spark, sf_dir)
    calendar = staged(gold.dim_calendar(fact), "calendar")
    return rounded(series.calendar_mean(fact, calendar, F.col("day_of_week_name") == "Monday"), "avg_aqi")


@query
def yearly_monthly_counts(spark, sf_dir):
    """A calendar written by year and month and read back: readings per stored month."""
    cleaned = staged(silver.clean_readings(raw_readings(spark, sf_dir), TIE).select("date", "hour"), "dated")
    path = work_path(spark, "by-month")
    tables.write_dimension(gold.dim_calendar(cleaned), path, ["year", "month"])
    return cleaned.join(spark.read.parquet(path), "date").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("readings"), F.count_distinct("date").alias("days"))


ARRAY_SIZE = 500


@query
def json_array_readings(spark, sf_dir):
    """Deliveries that are one JSON array each, of about 500 readings, read back: readings and indices per site."""
    records = feed_records(raw_readings(spark, sf_dir), "event_id")
    names = [name for name in records.columns if name != "event_id"]
    delivery = F.pmod(F.xxhash64("event_id"), F.lit(max(1, records.count() // ARRAY_SIZE)))
    body = F.to_json(F.collect_list(F.struct(*names)), {"ignoreNullFields": "false"})
    path = work_path(spark, "arrays")
    records.groupBy(delivery.alias("delivery")).agg(body.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = landing.readable(landing.read_json_array(spark, path))
    return read.groupBy(F.col("SiteName").alias("sitename")).agg(
        F.count(F.lit(1)).alias("readings"), F.sum("AQI").alias("total_aqi"), F.count("AQI").alias("with_aqi"))


@query
def first_boxes_membership(spark, sf_dir):
    """Development cap: sites and readings in each of the first five request boxes, also where there are none."""
    boxes = spatial.box_table(spark, 5)
    points = raw_readings(spark, sf_dir).groupBy("sitename", "latitude", "longitude").agg(F.count(F.lit(1)).alias("readings"))
    inside = spatial.join_boxes(points, boxes).groupBy("box_id").agg(F.count(F.lit(1)).alias("sites"), F.sum("readings").alias("readings"))
    return boxes.select("box_id").join(inside, "box_id", "left").fillna(0, ["sites", "readings"])


@query
def archived_batches(spark, sf_dir):
    """Landing files taken eight at a time and moved to an archive once their batch is committed, by two runs: what each
    has read, what is in bronze, and what landing zone and archive hold together."""
    layout = files.Layout(work_path(spark, "archived"))
    records = feed_records(raw_readings(spark, sf_dir), "event_id")
    read = []
    for part in (records.filter("event_id % 10 <> 0"), records.filter("event_id % 10 = 0")):
        landing.write_landing(part.drop("event_id"), layout.landing)
        done = drain(spark, lambda: landing_to_bronze(
            spark, layout.landing, layout.bronze, f"{layout.progress}_bronze", 8, layout.archive, {"rows": F.count(F.lit(1))}))
        read.append(sum(values["rows"] for _, values in done))
    counted = spark.createDataFrame([("first run", read[0]), ("second run", read[1])], "place STRING, readings LONG")
    bronze = spark.read.parquet(layout.bronze).agg(F.lit("bronze").alias("place"), F.count(F.lit(1)).alias("readings"))
    lines = landing.read_json_lines(spark, [layout.landing, layout.archive])
    kept = lines.agg(F.lit("landing and archive").alias("place"), F.count(F.lit(1)).alias("readings"))
    return reduce(DataFrame.unionByName, [counted, bronze, kept])


@query
def validation_report(spark, sf_dir):
    """All checks of the stored tables after a load; a unit may be missing in the readings, nothing else is violated."""
    raw = hourly_stamped(raw_readings(spark, sf_dir))
    warehouse = Warehouse(work_path(spark, "checked"))
    unit = F.when(F.col("event_id") % 10 != 0, F.col("unit"))
    update_silver(raw.withColumn("unit", unit), warehouse, "event_id", "full", tie_breakers=TIE)
    update_gold(spark, warehouse)
    return validate(spark, warehouse)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(events_path(sf_dir)).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_landing(spark, sf_dir):
    """Event stream to landing files and on to bronze, both drained; readings per bronze partition."""
    folder = work_path(spark, "stream")
    records = feed_records(to_readings(_event_stream(spark, sf_dir)))
    records_to_landing(records, f"{folder}/landing", f"{folder}/checkpoint-landing").awaitTermination()
    landing_to_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoint-bronze").awaitTermination()
    stored = spark.read.parquet(f"{folder}/bronze")
    return plain(stored.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("readings")))


@query
def stream_silver_upsert(spark, sf_dir):
    folder = work_path(spark, "stream")
    readings = to_readings(_event_stream(spark, sf_dir))
    readings_to_silver(readings, f"{folder}/silver", f"{folder}/checkpoint", TIE).awaitTermination()
    return plain(spark.read.parquet(f"{folder}/silver").select(*silver.CLEANED_COLUMNS))


@query
def stream_quarantine_once(spark, sf_dir):
    """Rejected readings appended by a stream, and a batch written a second time: each reading is there once."""
    folder = work_path(spark, "stream")
    rejects_to_quarantine(to_readings(_event_stream(spark, sf_dir)), f"{folder}/rejects", f"{folder}/checkpoint").awaitTermination()
    stored = read_appended(spark, f"{folder}/rejects")
    append_once(staged(stored, "again"), f"{folder}/rejects", "rejects", 0)  # the one batch there was, as after a lost commit
    return read_appended(spark, f"{folder}/rejects").select("event_id", "rejection_reason")


def _stream_join(spark, sf_dir, how):
    """Views and purchases per user and day, joined as streams: days the watermark has closed, and those still open."""
    session = with_state_partitions(spark, spark.sparkContext.defaultParallelism)
    kinds, names = ("view", "purchase"), ("views", "purchases")
    of = [(F.col("event_type") == kind) for kind in kinds]
    streams = [windowed_counts(_event_stream(session, sf_dir).filter(kind), "user_id", "ts", "1 day", "1 hour", name) for kind, name in zip(of, names)]
    folder = work_path(spark, "stream")
    drained = write_closed_windows(join_windows(*streams, "user_id", how), f"{folder}/joined", f"{folder}/checkpoint")
    drained.awaitTermination()
    events, closed = table(spark, sf_dir, "events"), spark.read.parquet(f"{folder}/joined")
    rest = open_windows(*[events.filter(kind) for kind in of], "user_id", "ts", timedelta(days=1), names, closed, final_watermark(drained), how)
    return plain(with_rest(closed, rest).drop("state"))


@query
def stream_join_inner(spark, sf_dir):
    return _stream_join(spark, sf_dir, "inner")


@query
def stream_join_left(spark, sf_dir):
    return _stream_join(spark, sf_dir, "left")


VIEW_TO_PURCHASE = timedelta(hours=1)


def _views_and_purchases(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two streams of single events, as two topics would give them."""
    views = events.filter(F.col("event_type") == "view").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed_at"))
    purchases = events.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchased_at"), F.col("value").alias("paid"))
    return views, purchases


def _stream_intervals(spark, sf_dir, how):
    """Each view with the same user's purchases in the hour after it, event by event, joined as streams and drained."""
    session = with_state_partitions(spark, spark.sparkContext.defaultParallelism)
    how_to = ("user_id", "viewed_at", "purchased_at", VIEW_TO_PURCHASE)
    joined = interval_join(*_views_and_purchases(_event_stream(session, sf_dir)), *how_to, "1 hour", how)
    folder = work_path(spark, "stream")
    drained = write_closed(joined, f"{folder}/joined", f"{folder}/checkpoint")
    drained.awaitTermination()
    closed = spark.read.parquet(f"{folder}/joined")
    if how == "inner":
        return closed
    tables_ = _views_and_purchases(table(spark, sf_dir, "events"))
    rest = open_events(*tables_, "user_id", "view_id", *how_to[1:], closed, final_watermark(drained))
    return with_rest(closed, rest).drop("state")


@query
def stream_interval_inner(spark, sf_dir):
    return plain(_stream_intervals(spark, sf_dir, "inner"))


@query
def stream_interval_left(spark, sf_dir):
    return plain(_stream_intervals(spark, sf_dir, "left"))


@query
def stream_join_anti(spark, sf_dir):
    """Views that no purchase of the user followed within the hour: released by the watermark, or open at the end."""
    alone = _stream_intervals(spark, sf_dir, "left").where(F.col("purchase_id").isNull())
    return plain(alone.select("user_id", "view_id", "viewed_at"))


# --- trends, sets, joins, columns -----------------------------------------------------------------------------------


@query
def running_total(spark, sf_dir):
    cleaned = silver.clean_readings(raw_readings(spark, sf_dir), TIE).select("fullaqscode", "date", "hour", "parameter", "aqi")
    cleaned = staged(cleaned, "running")  # read twice, for bucket totals and for rows
    return plain(trends.running_total(cleaned, "fullaqscode", "date", ["hour", "parameter"], "aqi"))


@query
def moving_average(spark, sf_dir):
    cleaned = silver.clean_readings(raw_readings(spark, sf_dir), TIE)
    hourly = cleaned.select("fullaqscode", "parameter", hour_timestamp().alias("moment"), "aqi")
    return plain(rounded(trends.moving_average(hourly, ["fullaqscode", "parameter"], "moment", "aqi", 6), "moving_avg"))


@query
def moving_average_week(spark, sf_dir):
    cleaned = silver.clean_readings(raw_readings(spark, sf_dir), TIE)
    hourly = cleaned.select("fullaqscode", "parameter", hour_timestamp().alias("moment"), "aqi")
    return plain(rounded(trends.moving_average(hourly, ["fullaqscode", "parameter"], "moment", "aqi", 168), "moving_avg"))


@query
def rank_sites(spark, sf_dir):
    cleaned = silver.clean_readings(raw_readings(spark, sf_dir), TIE)
    return plain(rounded(trends.rank_groups(cleaned, "date", "fullaqscode", "aqi"), "mean_value"))


def _site_hours(spark, sf_dir, parameter):
    """Distinct before the set operation: a busy site reaches it as one row per hour."""
    dated = silver.valid_readings(raw_readings(spark, sf_dir)).filter(F.col("parameter") == parameter)
    return dated.select("date", "hour", "fullaqscode").distinct()


@query
def union_sites(spark, sf_dir):
    return plain(_site_hours(spark, sf_dir, "OZONE").union(_site_hours(spark, sf_dir, "CO")).distinct())


@query
def intersect_sites(spark, sf_dir):
    return plain(_site_hours(spark, sf_dir, "OZONE").intersect(_site_hours(spark, sf_dir, "CO")))


@query
def except_sites(spark, sf_dir):
    return plain(_site_hours(spark, sf_dir, "OZONE").subtract(_site_hours(spark, sf_dir, "CO")))


def _activity(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("user_id").alias("member_id")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )


def _transactions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    spent = F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2)
    return orders.groupBy(F.col("o_custkey").alias("member_id")).agg(F.count(F.lit(1)).alias("orders"), spent.alias("spent"))


# Both event streams are reduced to one row per member before they meet, so a busy member cannot multiply rows.
@query
def activity_join_inner(spark, sf_dir):
    return _activity(spark, sf_dir).join(_transactions(spark, sf_dir), "member_id")


@query
def activity_join_left(spark, sf_dir):
    return _activity(spark, sf_dir).join(_transactions(spark, sf_dir), "member_id", "left")


@query
def activity_join_anti(spark, sf_dir):
    return _transactions(spark, sf_dir).join(_activity(spark, sf_dir), "member_id", "left_anti")


@query
def column_plan(spark, sf_dir):
    plan = {
        "add": {"order_year": "year(o_orderdate)", "is_large": "o_totalprice > 200000"},
        "cast": {"o_orderkey": "string", "order_year": "bigint"},
        "rename": {"o_orderkey": "order_key", "o_orderpriority": "priority"},
        "remove": ["o_orderdate", "o_custkey"],
    }
    return columns.apply_column_plan(table(spark, sf_dir, "orders"), plan)


@query
def flatten_props(spark, sf_dir):
    return columns.flatten_json(table(spark, sf_dir, "events").select("event_id", "event_type", "props"), "props", "k INT", "prop_")


@query
def flatten_inferred(spark, sf_dir):
    """Event properties and order attributes as JSON of one column, flattened by the fields that the data has."""
    events = table(spark, sf_dir, "events").select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("props").alias("body"))
    orders = table(spark, sf_dir, "orders").select(
        F.lit("order").alias("kind"),
        F.col("o_orderkey").alias("id"),
        F.to_json(F.struct(
            F.col("o_orderpriority").alias("priority"), (F.col("o_custkey") % 2 == 0).alias("even"),
            F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("customer"))).alias("body"),
    )
    return columns.flatten_json(events.unionByName(orders), "body")


@query
def bucketed_join(spark, sf_dir):
    """Line items per order joined to orders in equally bucketed tables.

    Line items are summed up per order before they are bucketed: a bucket is read by one task, so its rows per key
    must be few.
    """
    cents = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(cents.alias("gross"), F.count(F.lit(1)).alias("lines"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    buckets = spark.sparkContext.defaultParallelism
    folder = work_path(spark, "bucketed")
    name = folder.rsplit("-", 1)[-1]
    bucketed_lines = tables.write_bucketed(lines, f"lines_{name}", f"{folder}/lines", buckets, "l_orderkey")
    bucketed_orders = tables.write_bucketed(orders, f"orders_{name}", f"{folder}/orders", buckets, "o_orderkey")
    joined = bucketed_lines.join(bucketed_orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("o_orderkey", "o_orderpriority", "gross", "lines")
