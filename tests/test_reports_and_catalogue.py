"""Run reports, the loop of history windows, and tables in the catalogue."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aeroline.operators import series
from aeroline.plans import gold
from aeroline.plans.files import Layout
from aeroline.plans.job import main, parse_arguments
from aeroline.plans.report import SCHEMA, RunReport, landed_metrics, top_fields, type_differences
from aeroline.schemas import CORRUPT, READING_WITH_CORRUPT
from aeroline.sources import progress, registry, tables
from tests.conftest import rows
from tests.test_jobs import RECORD, deliver, write_lines


def report_of(spark, root, run):
    found = spark.read.schema(SCHEMA).json(Layout(root).reports).where(F.col("run_id") == run).collect()
    return {(r["stage"], r["metric"]): r["value"] for r in found}


# --- reports --------------------------------------------------------------------------------------------------------


def test_report_has_rows_late_readings_and_changed_types(spark, tmp_path):
    root = str(tmp_path)
    folder = Path(Layout(root).landing) / "date=2026-03-04"
    write_lines(folder, "a.json", RECORD, {**RECORD, "UTC": "2026-03-05T10:00"}, {**RECORD, "Parameter": "CO", "AQI": -999}, "{broken")
    assert main(["--root", root, "--run-id", "one"]) == 0
    first = report_of(spark, root, "one")
    assert {k: first["bronze", k] for k in ("rows", "broken", "odd_types", "late")} == {"rows": "4", "broken": "1", "odd_types": "0", "late": "0"}
    assert (first["cleaned", "rows"], first["rejected", "rows"], first["facts", "rows"], first["dim_date", "rows"]) == ("2", "1", "2", "2")
    assert not [key for key in first if key[0] == "checks" or key[1].startswith("type of")]

    late = {**RECORD, "UTC": "2026-03-05T09:59", "Parameter": "NO2"}
    odd = {**RECORD, "UTC": "2026-03-05T11:00", "AQI": "seventeen", "Latitude": [1, 2]}
    write_lines(folder, "b.json", late, odd, {**RECORD, "UTC": "2026-03-05T12:00", "Extra": {"a": 1}})
    assert main(["--root", root, "--run-id", "two"]) == 0
    second = report_of(spark, root, "two")
    assert {k: second["bronze", k] for k in ("rows", "broken", "odd_types", "late")} == {"rows": "3", "broken": "0", "odd_types": "1", "late": "1"}
    assert second["bronze", "type of AQI"] == "STRING instead of int" and second["bronze", "type of Latitude"].startswith("ARRAY<")
    # The wider lookback takes the late reading, so it is none.
    write_lines(folder, "c.json", {**late, "Parameter": "SO2"})
    assert main(["--root", root, "--run-id", "three", "--lookback", "5 hours"]) == 0
    assert report_of(spark, root, "three")["bronze", "late"] == "0"


def test_metrics_are_observed_by_the_write_itself(spark, tmp_path):
    report = RunReport(spark, "r")
    counted = report.rows_of("stage")
    counted.of(spark.range(7).where("id <> 3")).write.parquet(f"{tmp_path}/t")
    report.add("other", "metric", 5)
    assert report.values() == {("stage", "rows"): 6, ("other", "metric"): 5}
    for _ in range(2):
        report.write(f"{tmp_path}/reports")
    assert spark.read.schema(SCHEMA).json(f"{tmp_path}/reports").count() == 4


def test_landed_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], READING_WITH_CORRUPT)
    got = empty.agg(*[c.alias(n) for n, c in landed_metrics("2026-03-04 10:00:00").items()]).first()
    assert (got["rows"], got["broken"], got["odd_types"], got["late"]) == (0, 0, 0, 0) and type_differences(got["types"]) == []


@pytest.mark.parametrize("value,found", [
    ("x", [("AQI", "int", "STRING")]), (1.5, [("AQI", "int", "DECIMAL(2,1)")]), (None, []), (3, []), ({"a": [1]}, [("AQI", "int", "OBJECT<a: ARRAY<BIGINT>>")])])
def test_type_differences(spark, value, found):
    line = json.dumps({"SiteName": "a, b: <c>", "AQI": value, "Latitude": 1, "Other": {"x": 1, "y": "z"}})
    frame = spark.createDataFrame([(line,)], f"{CORRUPT} string")
    types = frame.agg(F.schema_of_variant_agg(F.parse_json(CORRUPT))).first()[0]
    assert type_differences(types) == found


def test_top_fields():
    assert top_fields("OBJECT<a: BIGINT, b: OBJECT<c: STRING, d: ARRAY<BIGINT>>, e: DECIMAL(5,2)>") == {
        "a": "BIGINT", "b": "OBJECT<c: STRING, d: ARRAY<BIGINT>>", "e": "DECIMAL(5,2)"}
    assert top_fields("VOID") == top_fields("OBJECT<>") == top_fields(None) == {}


# --- history --------------------------------------------------------------------------------------------------------


HISTORY = ["--mode", "history", "--today", "2026-03-20", "--until", "2026-01-20T00:00"]


def state_of(spark, root):
    return str(progress.read_progress(spark, f"{root}/state/readings_history_progress").first()["oldest_loaded"])


def test_history_runs_from_an_empty_and_from_a_half_done_state(spark, tmp_path, readings):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    # Edges of windows: their last minute, their first, a day without readings, and the day the run is made.
    times = ["2026-03-19T23:59", "2026-03-06T00:00", "2026-03-05T23:30", "2026-01-23T00:00", "2026-03-20T00:00"]
    deliver(spark, layout, readings(*[{"utc": t} for t in times]))
    assert main(["--root", root, *HISTORY, "--windows", "1", "--run-id", "one"]) == 0
    fact = lambda: rows(spark.read.parquet(f"{root}/gold/fact_air_quality_readings"), "date", "hour")
    assert fact() == [("2026-03-06", 0), ("2026-03-19", 23)] and state_of(spark, root) == "2026-03-06 00:00:00"
    assert main(["--root", root, *HISTORY, "--run-id", "two"]) == 0
    assert fact() == [("2026-01-23", 0), ("2026-03-05", 23), ("2026-03-06", 0), ("2026-03-19", 23)]
    assert state_of(spark, root) == "2026-01-09 00:00:00"
    assert report_of(spark, root, "two")["history", "windows"] == "4"
    assert main(["--root", root, *HISTORY, "--run-id", "three"]) == 0
    assert report_of(spark, root, "three")["history", "windows"] == "0"


def test_an_interrupted_history_repeats_its_window(spark, tmp_path, readings, monkeypatch):
    from aeroline.plans import job

    root = str(tmp_path)
    deliver(spark, Layout(root), readings({"utc": "2026-03-19T10:00"}, {"utc": "2026-03-01T10:00"}))

    def lost(*arguments):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(job, "write_progress", lost)
        with pytest.raises(RuntimeError):
            main(["--root", root, *HISTORY])
    assert state_of(spark, root) == "None"
    assert main(["--root", root, *HISTORY]) == 0
    assert rows(spark.read.parquet(f"{root}/gold/fact_air_quality_readings"), "date") == [("2026-03-01",), ("2026-03-19",)]


@pytest.mark.parametrize("given", [["--windows", "2"], ["--mode", "full", "--until", "2020-01-01T00:00"], ["--mode", "history", "--start", "2020-01-01"]])
def test_history_options_belong_to_history(given):
    with pytest.raises(SystemExit):
        parse_arguments(["--root", "/x", *given])


# --- catalogue ------------------------------------------------------------------------------------------------------


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:8]}_"
    yield name
    for row in spark.sql("SHOW DATABASES").collect():
        if row[0].startswith(name):
            spark.sql(f"DROP DATABASE `{row[0]}` CASCADE")


def test_job_writes_and_reads_tables_of_its_target(spark, tmp_path, readings, prefix):
    root = str(tmp_path)
    deliver(spark, Layout(root), readings({}, {"parameter": "CO"}))
    assert main(["--root", root, "--target", "dev", "--catalogue", prefix]) == 0
    view = f"{prefix}test_gold.readings"
    assert rows(spark.table(view), "date", "parameter", "concern_level", "aqi") == [("2026-03-04", "CO", "Good", 17), ("2026-03-04", "OZONE", "Good", 17)]
    assert registry.listed_partitions(spark, f"{prefix}test_silver.cleaned_readings").count() == 1
    deliver(spark, Layout(root), readings({"utc": "2026-03-06T10:00", "aqi": 30}))
    assert main(["--root", root, "--target", "dev", "--catalogue", prefix]) == 0
    assert rows(spark.table(view), "date", "aqi") == [("2026-03-04", 17), ("2026-03-04", 17), ("2026-03-06", 30)]
    assert rows(registry.listed_partitions(spark, f"{prefix}test_gold.fact_air_quality_readings"), "date") == [("2026-03-04",), ("2026-03-06",)]
    assert not spark.catalog.databaseExists(f"{prefix}gold")


def test_a_name_stands_for_one_path_and_partitions_come_and_go(spark, tmp_path, prefix):
    frame = spark.createDataFrame([(1, "a b/c", 3), (2, None, 4)], "x int, day string, hour int")
    frame.write.partitionBy("day", "hour").parquet(f"{tmp_path}/one")
    frame.write.partitionBy("day", "hour").parquet(f"{tmp_path}/two")
    name = f"{prefix}db.t"
    for _ in range(2):
        registry.register(spark, name, f"{tmp_path}/one", ["day", "hour"])
    assert rows(registry.listed_partitions(spark, name), "day", "hour") == [("a b/c", 3), (None, 4)]
    with pytest.raises(ValueError):
        registry.register(spark, name, f"{tmp_path}/two", ["day", "hour"])
    frame.withColumn("hour", F.lit(9)).limit(1).write.mode("append").partitionBy("day", "hour").parquet(f"{tmp_path}/one")
    registry.register(spark, name, f"{tmp_path}/one", ["day", "hour"])
    assert registry.listed_partitions(spark, name).count() == 3 and spark.table(name).count() == 3


def test_unprocessed_partitions_are_found_without_reading_data(spark, tmp_path, prefix):
    frame = spark.createDataFrame([(i, f"2026-03-0{1 + i % 4}", i % 3) for i in range(40)], "x int, date string, hour int").withColumn("date", F.col("date").cast("date"))
    for name, part in (("source", frame), ("target", frame.where("date < '2026-03-04' AND hour < 2"))):
        part.write.partitionBy("date", "hour").parquet(f"{tmp_path}/{name}")
        registry.register(spark, f"{prefix}b.{name}", f"{tmp_path}/{name}", ["date", "hour"])
    found = registry.unprocessed(spark, f"{prefix}b.source", f"{prefix}b.target", ("date", "hour"))
    assert "Scan parquet" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == sorted([(f"2026-03-0{d}", h) for d in range(1, 5) for h in range(3) if d == 4 or h == 2])


def test_a_filtered_calendar_prunes_the_facts_while_the_query_runs(spark, tmp_path):
    facts = spark.sql("SELECT date_add(DATE '2026-03-01', CAST(id % 28 AS INT)) AS date, CAST(id % 24 AS INT) AS hour, CAST(id AS INT) AS aqi FROM range(2000)")
    tables.write_partitioned(facts, f"{tmp_path}/facts", ["date"])
    gold.dim_calendar(facts).coalesce(1).write.parquet(f"{tmp_path}/calendar")
    fact, calendar = spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/calendar")
    mean = series.calendar_mean(fact, calendar, F.col("day_of_week_name") == "Monday")
    assert "dynamicpruning" in mean._jdf.queryExecution().executedPlan().toString()
    wanted = facts.where("dayofweek(date) = 2").groupBy("hour").agg(F.avg("aqi").alias("avg_aqi"), F.count("*").alias("readings"))
    assert rows(mean) == rows(wanted)
