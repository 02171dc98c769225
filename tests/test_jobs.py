"""Sources, sinks, upserts, jobs and streams on temporary folders."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aeroline import session
from aeroline.operators import backfill, columns, merge
from aeroline.operators.merge import merge_frames, upsert_table
from aeroline.plans import files, gold, silver
from aeroline.plans.job import main, parse_arguments
from aeroline.plans.warehouse import Warehouse, update_gold, update_silver, validate
from aeroline.schemas import CORRUPT, READING
from aeroline.sources import landing, messages, progress, tables
from aeroline.sources.event_readings import feed_records, hourly_stamped, raw_readings, to_readings
from aeroline.streaming.landing import SPREAD, landing_to_bronze, messages_to_landing, track_progress
from aeroline.streaming.silver import readings_to_silver
from tests.conftest import GOOD, SF_DIR, rows, same

RECORD = {
    "Latitude": 40.5, "Longitude": -100.25, "UTC": "2026-03-04T14:00", "Parameter": "OZONE", "Unit": "PPB", "AQI": 17,
    "Category": 1, "SiteName": "Mill Lane", "AgencyName": "County Office", "FullAQSCode": "012345678",
    "IntlAQSCode": "840012345678", "source": "test", "ingested_at": "2026-04-01T00:00:00.000000",
}


def write_lines(folder, name, *lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


# --- sources --------------------------------------------------------------------------------------------------------


def test_json_lines_fixed_schema(spark, tmp_path):
    bad_field = {**RECORD, "AQI": "many"}
    write_lines(tmp_path / "date=2026-03-04" / "hour=14", "a.json", RECORD, bad_field, "{not json")
    df = landing.read_json_lines(spark, str(tmp_path)).cache()
    assert df.columns == [field.name for field in READING.fields] + [CORRUPT, "original_file"]
    good = landing.readable(df)
    assert rows(good, "FullAQSCode", "AQI", "Category") == [("012345678", 17, 1), ("012345678", None, 1)]  # a bad field costs only itself
    assert [row.line for row in landing.unreadable(df).collect()] == ["{not json"]
    assert rows(landing.path_partitions(good), "path_date", "path_hour") == [("2026-03-04", 14)] * 2
    assert rows(landing.with_partitions(good), "date", "hour") == [("2026-03-04", 14)] * 2


def test_malformed_folder_names_give_null(spark):
    df = spark.createDataFrame([("x/date=not-a-date/f",), ("x/date=2026-03-10/hour=07/f",)], "original_file STRING")
    assert rows(landing.path_partitions(df), "path_date", "path_hour") == [("2026-03-10", 7), (None, None)]


def test_json_array(spark, tmp_path):
    (tmp_path / "data.json").write_text(json.dumps([RECORD, {**RECORD, "AQI": 3}], indent=1))
    assert rows(landing.readable(landing.read_json_array(spark, str(tmp_path / "data.json"))), "AQI") == [(17,), (3,)]


def test_landing_round_trip_keeps_every_record(spark, tmp_path, readings):
    records = feed_records(readings({}, {"aqi": None}, {"utc": "2026-03-05T01:00"}).withColumn("utc", F.col("utc").cast("timestamp_ntz")))
    landing.write_landing(records, str(tmp_path / "landing"))
    assert {path.name for path in (tmp_path / "landing").glob("date=*")} == {"date=2026-03-04", "date=2026-03-05"}
    back = landing.readable(landing.read_json_lines(spark, str(tmp_path / "landing"))).drop("original_file")
    same(back, records)
    assert rows(landing.landing_counts(records)) == [("2026-03-04", 2), ("2026-03-05", 1)]


@pytest.mark.parametrize("body, status, count", [
    (json.dumps([RECORD, RECORD]), "rows", 2),
    ("[]", "rows", 0),
    ('{"WebServiceError": [{"Message": "Error"}]}', "service_error", 0),
    ('{"anything": "value"}', "unexpected_object", 0),
    ("5", "unexpected_type", 0),
    ("<html>", "bad_json", 0),
])
def test_api_bodies(spark, body, status, count):
    bodies = spark.createDataFrame([(1, body)], "id INT, body STRING")
    assert landing.classify_body(bodies).first().status == status
    assert landing.body_rows(bodies).count() == count
    assert landing.failed_bodies(bodies).count() == (status != "rows")


def test_odd_elements_cost_no_other(spark):
    bodies = spark.createDataFrame([(1, json.dumps([1, {**RECORD, "AQI": "many"}, None, RECORD, "x"]))], "id INT, body STRING")
    assert rows(landing.body_rows(bodies), "id", "SiteName", "AQI") == [(1, "Mill Lane", 17), (1, "Mill Lane", None)]
    assert rows(landing.failed_bodies(bodies), "id", "body", "status") == [(1, "1", "bad_element"), (1, "null", "bad_element"), (1, "x", "bad_element")]


def test_old_files_are_read_and_broken_messages_kept(spark, tmp_path):
    import os

    source, bronze, checkpoint = (str(tmp_path / name) for name in ("landing", "bronze", "state"))
    write_lines(tmp_path / "landing" / "date=2026-03-04", "a.json", RECORD)
    landing_to_bronze(spark, source, bronze, checkpoint).awaitTermination()
    write_lines(tmp_path / "landing" / "date=2026-03-04", "b.json", {**RECORD, "Parameter": "CO"})
    os.utime(tmp_path / "landing" / "date=2026-03-04" / "b.json", (1, 1))
    landing_to_bronze(spark, source, bronze, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(bronze), "Parameter") == [("CO",), ("OZONE",)]
    sent = spark.createDataFrame([("k", json.dumps(RECORD)), ("k", "{oops"), (None, None), ("k", "5")], "key STRING, value STRING")
    assert messages.from_messages(sent).count() == 1
    assert rows(messages.broken_messages(sent), "key", "value") == [("k", "5"), ("k", "{oops"), (None, None)]


def test_file_layers_take_a_later_reading_of_a_stored_hour_and_keep_broken_lines(spark, tmp_path):
    layout = files.Layout(str(tmp_path))
    folder = Path(layout.landing) / "date=2026-03-04"

    def run():
        files.raw_to_bronze(spark, layout)
        files.bronze_to_silver(spark, layout)
        files.silver_to_gold(spark, layout)
        return rows(spark.read.parquet(layout.gold("fact_air_quality_readings")), "aqi"), rows(spark.read.parquet(layout.quarantine), "line")

    write_lines(folder, "a.json", RECORD, "{oops")
    assert run() == ([(17,)], [("{oops",)])
    write_lines(folder, "b.json", {**RECORD, "Parameter": "CO", "AQI": 5}, "[}")
    assert run() == run() == ([(17,), (5,)], [("[}",), ("{oops",)])


def test_first_load_without_a_valid_reading(spark, tmp_path):
    write_lines(tmp_path / "landing" / "readings" / "date=2026-03-04", "a.json", {**RECORD, "AQI": "many"})
    assert main(["--root", str(tmp_path)]) == 0
    assert rows(spark.read.parquet(f"{tmp_path}/silver/rejected_readings"), "rejection_reason") == [("NULL_AQI",)]


@pytest.mark.parametrize("given", [["--start", "2026-01-01"], ["--layers", "files", "--run-id", "x"], ["--layers", "files", "--mode", "full"]])
def test_options_that_do_not_apply_are_refused(given):
    with pytest.raises(SystemExit):
        parse_arguments(["--root", "x", *given])


def test_messages_round_trip(spark):
    records = feed_records(raw_readings(spark, SF_DIR))
    same(messages.from_messages(messages.to_messages(records)), records)
    binary = messages.to_messages(records).withColumn("value", F.encode("value", "UTF-8"))
    same(messages.from_messages(binary), records)
    for call in (lambda: messages.write_kafka(records, "host", ""), lambda: messages.kafka_stream(spark, "host", "")):
        with pytest.raises(ValueError):
            call()


def test_progress_only_moves_back(spark, tmp_path):
    path = str(tmp_path / "progress")
    for utc, expected in [("2026-03-04T14:00", "2026-03-04 14:00:00"), ("2026-03-05T00:00", "2026-03-04 14:00:00"),
                          ("2019-09-01T00:00", "2019-09-01 00:00:00")]:
        batch = spark.createDataFrame([(utc,)], "UTC STRING")
        progress.write_progress(progress.advance(progress.read_progress(spark, path), batch), path)
        assert rows(progress.read_progress(spark, path), "oldest_loaded") == [(expected,)]
    assert rows(progress.is_done(progress.read_progress(spark, path)), "is_done") == [(True,)]


def test_backfill_windows(spark, tmp_path):
    empty = progress.read_progress(spark, str(tmp_path / "none"))
    assert rows(backfill.next_window(empty, "2026-03-20 00:00:00")) == [("2026-03-06T00:00", "2026-03-19T23:00", False)]
    state = spark.sql("SELECT timestamp_ntz'2019-10-01 05:30:00' AS oldest_loaded")
    assert rows(backfill.next_window(state, "2026-03-20 00:00:00")) == [("2019-09-17T05:00", "2019-10-01T04:00", False)]
    assert rows(backfill.backfill_windows(state)) == [
        (0, "2019-09-17T05:00", "2019-10-01T04:00"), (1, "2019-09-03T05:00", "2019-09-17T04:00"),
        (2, "2019-08-20T05:00", "2019-09-03T04:00")]
    done = spark.sql("SELECT timestamp_ntz'2019-09-01 00:00:00' AS oldest_loaded")
    assert backfill.backfill_windows(done).count() == 0 and rows(progress.is_done(done), "is_done") == [(True,)]


def test_coverage_gaps(readings):
    raw = readings({"utc": "2026-03-04T01:10"}, {"utc": "2026-03-04T04:00"}, {"utc": "2026-03-04T04:30", "parameter": "CO"})
    assert rows(backfill.coverage_gaps(raw)) == [("OZONE", "2026-03-04 02:00:00"), ("OZONE", "2026-03-04 03:00:00")]


def test_column_plan_and_flattening(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "m": "x"}', "[1, 2]")], "a INT, p STRING, l STRING")
    plan = {"add": {"b": "a + 1"}, "cast": {"a": "string"}, "rename": {"a": "key"}, "remove": ["l"]}
    assert rows(columns.apply_column_plan(df, plan)) == [("1", '{"k": 5, "m": "x"}', 2)]
    assert rows(columns.flatten_json(df.drop("l"), "p", "k INT, m STRING", "p_"), "a", "p_k", "p_m") == [(1, 5, "x")]
    assert rows(columns.explode_json(df.drop("p"), "l", "ARRAY<INT>", "n")) == [(1, 1), (1, 2)]


def test_flatten_finds_its_fields(spark):
    texts = ['{"a":1,"b":"x","n":null}', '{"a":2.5,"c":{"d":[1]},"it\'s":true}', "[1]", "nope", None, '{"b":5}', '{"a":1,"a":2}', '{"q\\"\'.":7}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    flat = columns.flatten_json(df, "j", prefix="j_")
    assert {f.name: f.dataType.simpleString() for f in flat.schema} == {
        "i": "int", "j_a": "decimal(21,1)", "j_b": "variant", "j_c": "variant", "j_it's": "boolean", "j_n": "string", "j_q\"'.": "bigint"}
    plain = [(r[0], r[1] and float(r[1]), r[2] and r[2].toPython(), r[3] and r[3].toPython(), *r[4:]) for r in sorted(flat.collect())]
    none = (None,) * 6
    assert plain == [
        (0, 1.0, "x", *none[2:]), (1, 2.5, None, {"d": [1]}, True, None, None), (2, *none), (3, *none), (4, *none),
        (5, None, 5, *none[2:]), (6, *none), (7, *none[1:], 7)]
    assert columns.flatten_json(df.where("i IN (2, 3)"), "j").columns == ["i"] == columns.flatten_json(df.limit(0), "j").columns


# --- tables and upserts ---------------------------------------------------------------------------------------------


def test_merge_is_null_safe_and_repeatable(spark):
    target = spark.createDataFrame([(1, None, "old"), (2, "b", "old")], "k INT, n STRING, v STRING")
    batch = spark.createDataFrame([(1, None, "new"), (3, "c", "new")], "k INT, n STRING, v STRING")
    merged = merge_frames(target, batch, ["k", "n"])
    expected = [(1, None, "new"), (2, "b", "old"), (3, "c", "new")]
    assert rows(merged) == expected
    assert rows(merge_frames(merged, batch, ["k", "n"])) == expected


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    make = lambda *values: spark.createDataFrame(values, "k INT, v STRING, day STRING").withColumn("day", F.to_date("day"))
    upsert_table(make((1, "a", "2026-01-01"), (2, "b", "2026-01-02")), path, ["k", "day"], ["day"])
    untouched = sorted((tmp_path / "table" / "day=2026-01-01").glob("*.parquet"))
    upsert_table(make((2, "B", "2026-01-02"), (3, "c", "2026-01-03")), path, ["k", "day"], ["day"])
    assert rows(spark.read.parquet(path)) == [(1, "a", "2026-01-01"), (2, "B", "2026-01-02"), (3, "c", "2026-01-03")]
    assert sorted((tmp_path / "table" / "day=2026-01-01").glob("*.parquet")) == untouched


def test_repeated_run_finishes_from_its_stage(spark, tmp_path, monkeypatch):
    """A run that dies while swapping partitions in must not merge into what is left of the table."""
    path, stage = str(tmp_path / "table"), str(tmp_path / "stage")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k INT, v STRING, p INT")
    batch = spark.createDataFrame([(2, "B", 1)], "k INT, v STRING, p INT")
    upsert_table(first, path, ["k", "p"], ["p"])

    def lose_rows_and_die(merged, where, partition_by):
        tables.write_partitioned(batch, where, partition_by)
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "write_partitioned", lose_rows_and_die)
        with pytest.raises(OSError):
            upsert_table(batch, path, ["k", "p"], ["p"], stage=stage)
    assert spark.read.parquet(path).count() == 1
    for _ in range(2):
        upsert_table(batch, path, ["k", "p"], ["p"], stage=stage)
        assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "B", 1)]


def test_interrupted_first_load_is_finished_from_its_stage(spark, tmp_path, monkeypatch):
    path, stage = str(tmp_path / "table"), str(tmp_path / "stage")
    batch = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k INT, v STRING, p INT")

    def write_half_and_die(df, where, partition_by):
        tables.write_partitioned(df.filter("p = 2"), where, partition_by)
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "write_partitioned", write_half_and_die)
        with pytest.raises(OSError):
            upsert_table(batch, path, ["k", "p"], ["p"], stage=stage)
    upsert_table(batch.limit(0), path, ["k", "p"], ["p"], stage=stage)  # a watermark may leave the repeated batch empty
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "b", 2)]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_the_next_run_finishes_a_swap_whoever_it_is(spark, tmp_path, monkeypatch, partition_by):
    """The table is gone and the run had no name: what it had staged is found beside the table."""
    path = str(tmp_path / "table")
    make = lambda *values: spark.createDataFrame(values, "k INT, v STRING, p INT")
    upsert_table(make((1, "a", 1), (2, "b", 1)), path, ["k", "p"], partition_by)

    def lose_all_and_die(merged, where, _partition_by):
        session.remove_path(spark, where)
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "write_partitioned", lose_all_and_die)
        with pytest.raises(OSError):
            upsert_table(make((2, "B", 1), (3, "c", 2)), path, ["k", "p"], partition_by)
    assert not Path(path).exists()
    merge.finish_swap(spark, path, partition_by)
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "B", 1), (3, "c", 2)]
    upsert_table(make((2, "X", 1)), path, ["k", "p"], partition_by)
    merge.finish_swap(spark, path, partition_by)  # nothing is left to undo it
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "X", 1), (3, "c", 2)]


def test_target_names_and_saved_tables(spark):
    assert (tables.database_for("silver", "dev"), tables.database_for("gold", "prod")) == ("test_silver", "gold")
    name = tables.save_as_table(spark.range(3), "gold", "numbers", "dev")
    assert name == "test_gold.numbers" and spark.table(name).count() == 3


def test_partition_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).selectExpr("id", "date_add(date'2026-01-01', CAST(id AS INT)) AS date", "1 AS hour")
    tables.write_partitioned(df, path, ["date", "hour"])
    part = tables.read_partitions(spark, path, "2026-01-03", "2026-01-04")
    assert rows(part, "id") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(date" in part._jdf.queryExecution().toString()


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    left = tables.write_bucketed(spark.range(100).toDF("a"), "bucketed_a", str(tmp_path / "a"), 4, "a")
    right = tables.write_bucketed(spark.range(50).toDF("b"), "bucketed_b", str(tmp_path / "b"), 4, "b")
    joined = left.join(right.hint("merge"), F.col("a") == F.col("b"))
    assert joined.count() == 50
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_own_folder_only_without_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        session.shared_folder(Cluster)
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_session_factory(spark):
    assert session.get_or_create_session() is spark
    assert session.create_session(overrides={"spark.sql.ansi.enabled": "true"}).conf.get("spark.sql.session.timeZone") == "UTC"
    session.stop_session(None)


# --- jobs -----------------------------------------------------------------------------------------------------------


def deliver(spark, layout, raw):
    landing.write_landing(feed_records(raw.withColumn("utc", F.col("utc").cast("timestamp_ntz"))), layout.landing)


def test_file_layers_take_later_hours_of_a_date_and_repeat_safely(spark, tmp_path, readings):
    layout = files.Layout(str(tmp_path))
    fact_path = layout.gold("fact_air_quality_readings")

    def run():
        files.raw_to_bronze(spark, layout)
        files.bronze_to_silver(spark, layout)
        files.silver_to_gold(spark, layout)
        return spark.read.parquet(fact_path).count()

    deliver(spark, layout, readings({}, {"parameter": "CO"}))
    assert run() == 2
    assert run() == 2 and spark.read.parquet(layout.file_bronze).count() == 2
    deliver(spark, layout, readings({"utc": "2026-03-04T15:00"}, {"utc": "2026-03-05T01:00", "intlaqscode": "new"}))
    assert run() == 4
    assert rows(spark.read.parquet(fact_path), "date", "hour") == [
        ("2026-03-04", 14), ("2026-03-04", 14), ("2026-03-04", 15), ("2026-03-05", 1)]
    for table, key, count in [("dim_site", "site_key", 2), ("dim_parameter", "parameter_key", 2), ("dim_date", "date_key", 3)]:
        dimension = spark.read.parquet(layout.gold(table))
        assert dimension.count() == dimension.select(key).distinct().count() == count


def test_increments_add_up_to_a_full_load_and_reruns_change_nothing(spark, tmp_path):
    raw = hourly_stamped(raw_readings(spark, SF_DIR)).filter("utc IS NOT NULL").cache()
    warehouse = Warehouse(str(tmp_path))
    for end in ["2024-01-10", "2024-01-20", "2024-02-01", "2024-02-01"]:
        update_silver(raw.filter(F.col("utc") < end), warehouse, "event_id", tie_breakers=["event_id"])
        update_gold(spark, warehouse)
    cleaned = spark.read.parquet(warehouse.path("silver", "cleaned_readings"))
    same(cleaned, silver.clean_readings(raw, ["event_id"]))
    rejected = spark.read.parquet(warehouse.path("silver", "rejected_readings"))
    expected = silver.reject_readings(raw, "event_id")
    same(rejected.drop("rejected_at", "rejected_date"), expected.drop("rejected_at"))
    fact = spark.read.parquet(warehouse.path("gold", "fact_air_quality_readings"))
    same(fact, gold.fact_readings_direct(cleaned))
    assert validate(spark, warehouse).filter("violations > 0").count() == 0


def test_gold_finds_dates_of_an_interrupted_backfill(spark, tmp_path, readings):
    root, layout = str(tmp_path), files.Layout(str(tmp_path))
    fact = f"{root}/gold/fact_air_quality_readings"
    deliver(spark, layout, readings({}))
    assert main(["--root", root]) == 0
    deliver(spark, layout, readings({"utc": "2026-03-01T00:00"}, {"utc": "2026-03-06T00:00"}))
    landing_to_bronze(spark, layout.landing, layout.bronze, f"{root}/state/readings_bronze").awaitTermination()
    bronze = columns.lower_case(landing.readable(spark.read.parquet(layout.bronze)))
    update_silver(bronze, Warehouse(root), mode="backfill", start="2026-03-01 00:00:00", end="2026-03-02 00:00:00")  # and no gold
    assert rows(spark.read.parquet(fact), "date") == [("2026-03-04",)]
    assert main(["--root", root]) == 0
    assert rows(spark.read.parquet(fact), "date") == [("2026-03-01",), ("2026-03-04",), ("2026-03-06",)]


def test_a_rerun_stamps_no_rejected_reading_anew(spark, tmp_path, readings):
    warehouse, path = Warehouse(str(tmp_path)), f"{tmp_path}/silver/rejected_readings"
    raw = readings({}, {"aqi": -999}, {"utc": None}, {"utc": "2026-03-05T00:00", "aqi": None})
    update_silver(raw, warehouse, "event_id")
    first = rows(spark.read.parquet(path))
    update_silver(raw, warehouse, "event_id")
    assert rows(spark.read.parquet(path)) == first and len(first) == 3
    update_silver(readings({}, {}, {}, {}, {"utc": None, "parameter": "CO"}), warehouse, "event_id")
    later = rows(spark.read.parquet(path))
    assert set(first) < set(later) and len(later) == 4


def test_watermark_reads_the_newest_partition(spark, tmp_path):
    cleaned = silver.clean_readings(raw_readings(spark, SF_DIR), ["event_id"])
    path = str(tmp_path / "stored")
    tables.write_partitioned(cleaned, path, ["date"])
    stored = spark.read.parquet(path)
    values = tables.partition_values(spark, path, "date")
    assert values == sorted(row[0] for row in rows(stored.select(F.col("date").cast("string")).distinct()))
    assert scanned(tables.newest_partition(stored, path, "date").agg(F.max("hour"))) == [("stored", {"numFiles": 1, "numPartitions": 1})]
    assert tables.partition_values(spark, str(tmp_path / "none"), "date") == []


def scanned(df):
    """Folder name and numbers of files and partitions read of every scan, after running the query."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan"):
            metrics = node.metrics()
            count = {key: metrics.apply(key).value() for key in ("numFiles", "numPartitions") if metrics.contains(key)}
            found.append((node.relation().location().rootPaths().head().getName(), count))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif name.endswith("QueryStage"):
            walk(node.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_increments_read_only_the_folders_they_need(spark, tmp_path):
    cleaned = silver.clean_readings(raw_readings(spark, SF_DIR), ["event_id"])
    tables.write_partitioned(cleaned, str(tmp_path / "stored"), ["date"])
    stored = spark.read.parquet(str(tmp_path / "stored"))
    batch = session.staged(stored.filter("date = '2024-01-20'"), "batch")

    merged = merge._merged_partitions(batch, str(tmp_path / "stored"), silver.CLEANED_KEYS, ["date"])
    assert ("stored", {"numFiles": 1, "numPartitions": 1}) in scanned(merged)
    facts = gold.new_fact_rows(gold.fact_readings_direct(batch), gold.fact_readings_direct(stored), batch)
    assert ("stored", {"numFiles": 1, "numPartitions": 1}) in scanned(facts)
    bronze = stored.withColumns({"utc": F.col("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour")), "intlaqscode": F.lit("x")})
    assert scanned(silver.clean_increment(bronze, stored)) == [("stored", {"numFiles": 1, "numPartitions": 1})]


def test_job_end_to_end(spark, tmp_path, readings):
    root = str(tmp_path)
    layout = files.Layout(root)
    raw = readings({}, {"parameter": "CO"}, {"aqi": -999, "parameter": "NO2"}, {"aqi": 3}, {"aqi": 3})
    deliver(spark, layout, raw)
    write_lines(Path(layout.landing) / "date=2026-03-04", "broken.json", "{not json")
    assert main(["--root", root, "--run-id", "r1"]) == 0
    cleaned = spark.read.parquet(f"{root}/silver/cleaned_readings")
    assert rows(cleaned, "parameter", "aqi") == [("CO", 17), ("OZONE", 17)]
    rejected = spark.read.parquet(f"{root}/silver/rejected_readings")
    assert rows(rejected, "parameter", "rejection_reason") == [("NO2", "INVALID_AQI"), ("OZONE", "DUPLICATE")]
    assert spark.read.parquet(f"{root}/gold/fact_air_quality_readings").count() == 2
    assert rows(landing.unreadable(spark.read.parquet(layout.bronze)), "line") == [("{not json",)]

    deliver(spark, layout, readings({"utc": "2026-03-01T00:00"}, {"utc": "2026-03-06T00:00"}))
    assert main(["--root", root, "--run-id", "r2"]) == 0
    assert rows(spark.read.parquet(f"{root}/silver/cleaned_readings"), "date") == [("2026-03-04",), ("2026-03-04",), ("2026-03-06",)]
    assert main(["--root", root, "--mode", "backfill", "--start", "2026-03-01", "--end", "2026-03-02"]) == 0
    assert spark.read.parquet(f"{root}/gold/fact_air_quality_readings").count() == 4


def test_job_arguments():
    assert parse_arguments(["--root", "/x"]).mode == "incremental"
    with pytest.raises(SystemExit):
        parse_arguments(["--root", "/x", "--mode", "backfill"])


def test_copies_without_row_id(readings):
    raw = readings({}, {}, {"aqi": 9}, {"aqi": 9}).drop("event_id")
    assert rows(silver.duplicate_losers(raw), "aqi", "copies") == [(17, 1), (9, 2)]
    assert rows(silver.reject_readings(raw), "rejection_reason") == [("DUPLICATE",)]


# --- streams --------------------------------------------------------------------------------------------------------


def event_stream(spark, folder):
    schema = spark.read.parquet(f"{SF_DIR}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_messages_to_landing_to_bronze_restarts(spark, tmp_path):
    inbox, land, bronze = (str(tmp_path / name) for name in ("inbox", "landing", "bronze"))
    sent = messages.to_messages(feed_records(raw_readings(spark, SF_DIR)))

    def run():
        stream = spark.readStream.schema("key STRING, value STRING").parquet(inbox)
        messages_to_landing(stream, land, str(tmp_path / "c1")).awaitTermination()
        landing_to_bronze(spark, land, bronze, str(tmp_path / "c2"), max_files=5).awaitTermination()
        return spark.read.parquet(bronze).count()

    sent.write.parquet(inbox)
    assert run() == sent.count()
    assert run() == sent.count()
    sent.limit(7).write.mode("append").parquet(inbox)
    assert run() == sent.count() + 7


def test_stream_sinks_write_few_files_a_folder_and_batches_leave_no_copies(spark, tmp_path):
    inbox, land = str(tmp_path / "inbox"), tmp_path / "landing"
    messages.to_messages(feed_records(raw_readings(spark, SF_DIR))).repartition(16).write.parquet(inbox)
    stream = spark.readStream.schema("key STRING, value STRING").parquet(inbox)
    messages_to_landing(stream, str(land), str(tmp_path / "c")).awaitTermination()
    assert max(len(list(folder.glob("*.json"))) for folder in land.glob("date=*")) <= SPREAD
    with session.scratch(spark):
        folder = Path(session.work_folder(spark))
        session.staged(spark.range(3), "x")
        assert folder.exists()
    assert not folder.exists() and Path(session.work_folder(spark)) == folder.parent


def test_processed_landing_files_are_archived(spark, tmp_path):
    land, archive = tmp_path / "landing", tmp_path / "archive"

    def run(name):
        write_lines(land / "date=2026-03-04", name, RECORD)
        landing_to_bronze(spark, str(land), str(tmp_path / "bronze"), str(tmp_path / "c"), archive=str(archive)).awaitTermination()

    for name in ("a.json", "b.json", "c.json"):
        run(name)
    moved = {path.name for path in archive.rglob("*.json")}
    assert "a.json" in moved and "c.json" not in moved
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 3


def test_stream_upsert_equals_batch_over_many_batches(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    inbox = str(tmp_path / "inbox")
    for part in range(3):  # arrival order has nothing to do with time: late and better readings come in later batches
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(inbox)
    for _ in range(2):
        query = readings_to_silver(to_readings(event_stream(spark, inbox)), str(tmp_path / "silver"), str(tmp_path / "c"), ["event_id"])
        query.awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "silver")).select(*silver.CLEANED_COLUMNS)
    same(stored, silver.clean_readings(to_readings(events), ["event_id"]))


def test_stream_progress(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    feed_records(raw_readings(spark, SF_DIR)).write.parquet(inbox)
    stream = spark.readStream.schema(READING).parquet(inbox)
    track_progress(stream, str(tmp_path / "state"), str(tmp_path / "c")).awaitTermination()
    oldest = rows(raw_readings(spark, SF_DIR).agg(F.min(F.date_format("utc", "yyyy-MM-dd HH:mm:00"))))
    assert rows(progress.read_progress(spark, str(tmp_path / "state")), "oldest_loaded") == oldest


def test_good_record_is_good():
    assert {field.name.lower() for field in READING.fields} <= set(GOOD)
