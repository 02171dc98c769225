"""Corrections that reach the facts, and whole partitions replaced."""

from pathlib import Path

import pytest

from aeroline.operators import merge
from aeroline.operators.merge import replace_partitions
from aeroline.operators.quality import count_differences
from aeroline.plans import gold
from aeroline.plans.files import Layout
from aeroline.plans.job import main
from aeroline.plans.warehouse import Warehouse, close_dates, open_dates, update_gold, update_silver, validate
from tests.conftest import rows, same
from tests.test_jobs import deliver


def load(spark, root, raw, **options):
    warehouse = Warehouse(str(root))
    update_silver(raw, warehouse, "event_id", "full")
    update_gold(spark, warehouse, dates=open_dates(spark, warehouse), **options)
    return warehouse


def differences(spark, warehouse):
    return validate(spark, warehouse).where("check_name = 'fact_cleaned_counts'").first()["violations"]


def test_a_corrected_category_leaves_one_fact_per_reading(spark, tmp_path, readings):
    first = readings({}, {"utc": "2026-03-05T01:00"}, {"utc": "2026-03-06T01:00", "parameter": "CO"})
    later = readings({}, {"utc": "2026-03-05T01:00"}, {"utc": "2026-03-06T01:00", "parameter": "CO"}, {"aqi": 60, "category": 2}, {"utc": "2026-03-05T01:00", "aqi": 18})
    warehouse = load(spark, tmp_path, first)
    fact, path = lambda: spark.read.parquet(path), warehouse.path("gold", "fact_air_quality_readings")
    load(spark, tmp_path, later)
    assert rows(fact(), "date", "aqi") == [("2026-03-04", 17), ("2026-03-04", 60), ("2026-03-05", 17), ("2026-03-06", 17)]
    assert differences(spark, warehouse) == 1
    load(spark, tmp_path, later, facts="rebuild")
    assert rows(fact(), "date", "aqi") == [("2026-03-04", 60), ("2026-03-05", 18), ("2026-03-06", 17)]
    assert differences(spark, warehouse) == 0
    same(fact(), gold.fact_readings_direct(spark.read.parquet(warehouse.path("silver", "cleaned_readings"))))
    with pytest.raises(ValueError):
        update_gold(spark, warehouse, facts="other")


def test_only_touched_dates_are_rewritten(spark, tmp_path, readings):
    warehouse = load(spark, tmp_path, readings({}, {"utc": "2026-03-05T01:00"}), facts="rebuild")
    close_dates(spark, warehouse)
    folder = Path(warehouse.path("gold", "fact_air_quality_readings"))
    files = {day: sorted(p.name for p in (folder / f"date={day}").glob("*.parquet")) for day in ("2026-03-04", "2026-03-05")}
    update_silver(readings({"utc": "2026-03-05T01:00", "aqi": 30}), warehouse, "event_id", "backfill", start="2026-03-05 00:00:00", end="2026-03-05 23:00:00")
    update_gold(spark, warehouse, dates=open_dates(spark, warehouse), facts="rebuild")
    assert sorted(p.name for p in (folder / "date=2026-03-04").glob("*.parquet")) == files["2026-03-04"]
    assert sorted(p.name for p in (folder / "date=2026-03-05").glob("*.parquet")) != files["2026-03-05"]


def test_a_touched_partition_without_rows_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    days = lambda *names: spark.createDataFrame([(n,) for n in names], "day string")
    frame = lambda *r: spark.createDataFrame(list(r), "day string, x int")
    replace_partitions(frame(("a", 1), ("b", 2), ("c", 3), ("z", 9)), path, "day", days("a", "b", "c"))
    assert rows(spark.read.parquet(path), "day", "x") == [("a", 1), ("b", 2), ("c", 3)]
    for _ in range(2):
        replace_partitions(frame(("a", 5)), path, "day", days("a", "b"))
        assert rows(spark.read.parquet(path), "day", "x") == [("a", 5), ("c", 3)]


@pytest.mark.parametrize("broken", ["write_partitioned", "remove_path"])
def test_an_interrupted_replacement_is_finished(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("a",), ("b",)], "day string")
    frame = lambda *r: spark.createDataFrame(list(r), "day string, x int")
    replace_partitions(frame(("a", 1), ("b", 2)), path, "day", days)

    def fail(*arguments, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, broken, fail)
        with pytest.raises(RuntimeError):
            replace_partitions(frame(("a", 5)), path, "day", days)
    merge.finish_swap(spark, path, ["day"])
    assert rows(spark.read.parquet(path), "day", "x") == [("a", 5)]
    # A list of emptied partitions without a stage belongs to nothing and is not applied by a later upsert.
    spark.createDataFrame([("day=a",)], "folder string").write.json(merge._emptied_of(merge.stage_of(path)))
    merge.upsert_table(frame(("c", 7)), path, ["day"], ["day"])
    assert rows(spark.read.parquet(path), "day", "x") == [("a", 5), ("c", 7)]


def test_job_backfill_corrects_stored_facts(spark, tmp_path, readings):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    fact = f"{root}/gold/fact_air_quality_readings"
    deliver(spark, layout, readings({}, {"utc": "2026-03-09T00:00"}))
    assert main(["--root", root]) == 0
    deliver(spark, layout, readings({"aqi": 70, "category": 2}))
    assert main(["--root", root]) == 0  # behind the watermark
    assert rows(spark.read.parquet(fact), "date", "aqi") == [("2026-03-04", 17), ("2026-03-09", 17)]
    assert main(["--root", root, "--mode", "backfill", "--start", "2026-03-04", "--end", "2026-03-04"]) == 0
    assert rows(spark.read.parquet(fact), "date", "aqi") == [("2026-03-04", 70), ("2026-03-09", 17)]


def test_job_can_leave_stored_facts_alone(spark, tmp_path, readings):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    deliver(spark, layout, readings({}))
    assert main(["--root", root, "--facts", "insert"]) == 0
    deliver(spark, layout, readings({"aqi": 70, "category": 2}))
    assert main(["--root", root, "--facts", "insert"]) == 1  # and the checks say that there is a fact too many
    assert rows(spark.read.parquet(f"{root}/gold/fact_air_quality_readings"), "aqi") == [(17,), (70,)]


def test_differences_do_not_cancel_out(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "g int")
    right = spark.createDataFrame([(1,), (2,), (2,), (None,)], "g int")
    assert count_differences("c", left, right, ["g"]).collect() == [("c", 2)]
    assert count_differences("c", left.where("false"), right.where("false"), ["g"]).collect() == [("c", 0)]
