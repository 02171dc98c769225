"""Cleaning and quarantine rules on hand-made readings."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroline.functions.times import hour_timestamp
from aeroline.operators.dedup import count_copies, keep_best, mark_losers
from aeroline.operators.incremental import high_watermark, late_row_count
from aeroline.plans import silver
from aeroline.sources.event_readings import hourly_stamped, raw_readings
from tests.conftest import ids, rows

NOW = "2026-04-01 00:00:00"


def test_cleaned_columns_and_level(readings):
    cleaned = silver.clean_readings(readings({}, {"category": 4, "parameter": "CO"}, {"category": 9, "parameter": "NO2"}))
    assert cleaned.columns == silver.CLEANED_COLUMNS
    assert rows(cleaned, "date", "hour", "concern_level") == [
        ("2026-03-04", 14, "Good"), ("2026-03-04", 14, "Unhealthy"), ("2026-03-04", 14, None)]


@pytest.mark.parametrize("fault", [
    {"aqi": -999}, {"aqi": None}, {"category": -999}, {"category": None}, {"fullaqscode": None}, {"parameter": None},
    {"latitude": None}, {"longitude": None}, {"utc": None}, {"utc": "yesterday"},
])
def test_faults_are_rejected_and_not_cleaned(readings, fault):
    raw = readings(fault)
    assert silver.clean_readings(raw).count() == 0
    assert silver.reject_readings(raw, "event_id", NOW).count() == 1


@pytest.mark.parametrize("fault, reason", [
    ({"aqi": -999, "category": None, "utc": None}, "INVALID_AQI"),
    ({"aqi": None, "category": -999}, "NULL_AQI"),
    ({"category": -999, "sitename": None}, "INVALID_CATEGORY"),
    ({"category": None, "sitename": None}, "NULL_CATEGORY"),
    ({"parameter": None, "sitename": None}, "NULL_SITE"),
    ({"parameter": None, "fullaqscode": None}, "NULL_PARAMETER"),
    ({"fullaqscode": None, "intlaqscode": None}, "NULL_FULLAQSCODE"),
    ({"intlaqscode": None, "agencyname": None}, "NULL_INTLAQSCODE"),
    ({"latitude": None, "agencyname": None}, "NULL_AGENCY"),
    ({"latitude": None, "longitude": None}, "NULL_LATITUDE"),
    ({"longitude": None, "utc": None}, "NULL_LONGITUDE"),
    ({"utc": "yesterday"}, "NULL_DATETIME"),
])
def test_first_matching_reason(readings, fault, reason):
    assert rows(silver.reject_readings(readings(fault), "event_id", NOW), "rejection_reason") == [(reason,)]


def test_missing_site_or_agency_alone_does_not_reject(readings):
    raw = readings({"sitename": None}, {"agencyname": None, "parameter": "CO"})
    assert silver.reject_readings(raw, "event_id", NOW).count() == 0
    assert silver.clean_readings(raw).count() == 2


def test_missing_international_code_is_in_both_tables(readings):
    raw = readings({"intlaqscode": None})
    assert silver.clean_readings(raw).count() == 1
    assert rows(silver.reject_readings(raw, "event_id", NOW), "rejection_reason") == [("NULL_INTLAQSCODE",)]


def test_highest_index_per_hour_survives_and_ties_are_repeatable(readings):
    raw = readings({"aqi": 5}, {"aqi": 9, "sitename": "b"}, {"aqi": 9, "sitename": "a", "utc": "2026-03-04T14:30"})
    assert rows(silver.clean_readings(raw), "aqi", "sitename") == [(9, "a")]
    assert rows(silver.clean_readings(raw, ["event_id"]), "aqi", "sitename") == [(9, "b")]


def test_duplicates_are_by_exact_time(readings):
    raw = readings({"aqi": 5}, {"aqi": 9}, {"aqi": 7, "utc": "2026-03-04T14:30"})
    assert ids(silver.duplicate_losers(raw, "event_id")) == [1]
    assert silver.clean_readings(raw).count() == 1


def test_one_quarantined_reading_per_key(readings):
    raw = readings({"aqi": 5}, {"aqi": 9}, {"aqi": 7}, {"aqi": -999}, {"aqi": None})
    assert ids(silver.duplicate_losers(raw, "event_id")) == [1, 3]
    assert rows(silver.reject_readings(raw, "event_id", NOW), "aqi", "rejection_reason") == [(5, "DUPLICATE")]


def test_rejected_readings_do_not_beat_valid_ones(readings):
    raw = readings({"aqi": 900, "intlaqscode": None}, {"aqi": 9})
    assert ids(silver.duplicate_losers(raw, "event_id")) == []
    assert rows(silver.reject_readings(raw, "event_id", NOW), "rejection_reason") == [("NULL_INTLAQSCODE",)]


def test_hot_key_is_ranked_in_slices(spark):
    """A third of all rows in one group: the marks equal those of a plain ranking, and no window group is large."""
    df = spark.range(3000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.xxhash64("id") % 50).cast("int").alias("aqi"))
    marked = mark_losers(df, ["k"], [F.col("aqi").desc(), F.col("event_id")], "event_id")
    plain = df.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY aqi DESC, event_id) > 1 AS expected")
    assert marked.join(plain, "event_id").filter("is_loser <> expected").count() == 0
    assert marked.filter("NOT is_loser").count() == 2001


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), min_size=1, max_size=40))
def test_survivors_and_losers_equal_brute_force(spark, pairs):
    df = spark.createDataFrame([(i, key, aqi) for i, (key, aqi) in enumerate(pairs)], "event_id INT, k STRING, aqi INT")
    best = {}
    for i, (key, aqi) in enumerate(pairs):
        if key not in best or aqi > pairs[best[key]][1]:
            best[key] = i
    order = [F.col("aqi").desc(), F.col("event_id")]
    assert ids(keep_best(df, ["k"], order)) == sorted(best.values())
    losers = mark_losers(df, ["k"], order, "event_id").filter("is_loser")
    assert ids(losers) == sorted(set(range(len(pairs))) - set(best.values()))


def test_copies_are_collapsed_with_their_count(spark):
    df = spark.range(10).selectExpr("id % 2 AS a", "'x' AS b")
    assert rows(count_copies(df)) == [(0, "x", 5), (1, "x", 5)]


def test_cleaning_shrinks_hot_keys_before_the_shuffle(spark):
    plan = silver.clean_readings(raw_readings(spark, "/root/testdata/sf0.001"), ["event_id"])._jdf.queryExecution().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:] and "WindowGroupLimit" in plan[exchange:]


# Rows per quarantine reason with hourly time stamps, known from an independent count of the sf0.01 events.
def test_known_counts(spark):
    raw = raw_readings(spark, "/root/testdata/sf0.01")
    assert silver.valid_readings(raw).count() == 9412
    assert silver.clean_readings(raw, ["event_id"]).count() == 8294
    rejected = silver.reject_readings(hourly_stamped(raw), "event_id", NOW)
    assert dict(rows(rejected.groupBy("rejection_reason").count())) == {
        "DUPLICATE": 995, "INVALID_AQI": 103, "INVALID_CATEGORY": 114, "NULL_AQI": 109, "NULL_CATEGORY": 120,
        "NULL_FULLAQSCODE": 132, "NULL_INTLAQSCODE": 132}


def at(hour, minute=0, day=4):
    return f"2026-03-{day:02}T{hour:02}:{minute:02}"


def test_watermark_keeps_latest_hour_and_later(readings):
    stored = silver.clean_readings(readings({"utc": at(14)}))
    raw = readings({"utc": at(13, 59)}, {"utc": at(14, 30)}, {"utc": at(15)}, {"utc": at(23, day=3)})
    assert rows(silver.clean_increment(raw, stored), "hour") == [(14,), (15,)]
    wider = silver.clean_increment(raw, stored, lookback="3 hours")
    assert rows(wider, "hour") == [(13,), (14,), (15,)]
    late = late_row_count(raw, stored, hour_timestamp())
    assert rows(late, "on_time", "late") == [(2, 2)]


def test_empty_target_takes_everything(readings):
    raw = readings({"utc": at(1)}, {"utc": at(2)})
    stored = silver.clean_readings(raw.limit(0))
    assert silver.clean_increment(raw, stored).count() == 2
    moment = raw.select(high_watermark(stored, hour_timestamp(), "1 hour").alias("w")).first()["w"]
    assert str(moment) == "1900-01-01 00:00:00"


def test_backfill_ignores_the_watermark(readings):
    stored = silver.clean_readings(readings({"utc": at(14)}))
    raw = readings({"utc": at(3)}, {"utc": at(4)}, {"utc": at(5)})
    batch = silver.clean_increment(raw, stored, "backfill", start="2026-03-04 03:00:00", end="2026-03-04 04:00:00")
    assert rows(batch, "hour") == [(3,), (4,)]
    assert silver.clean_increment(raw, stored, "full").count() == 3
    with pytest.raises(ValueError):
        silver.clean_increment(raw, stored, "sometimes")


def test_rejected_watermark_keeps_readings_without_time(readings):
    stored = silver.reject_readings(readings({"utc": at(14), "aqi": None}), "event_id", NOW)
    raw = readings({"utc": at(13), "aqi": None}, {"utc": at(13, 1), "aqi": None}, {"utc": None}, {"utc": at(15)})
    fresh = silver.reject_increment(raw, stored, "event_id", rejected_at=NOW)
    assert rows(fresh, "utc", "rejection_reason") == [
        ("2026-03-04 13:01:00", "NULL_AQI"), (None, "NULL_DATETIME")]
