"""Keys, dimensions, facts, regions and series on hand-made readings."""

import hashlib

from pyspark.sql import functions as F

from aeroline.fixed_values import REGIONS, REQUEST_BOXES
from aeroline.functions.keys import message_key, path_key, surrogate_key
from aeroline.functions.readings import assign_region, lookup
from aeroline.operators import quality, series, spatial, trends
from aeroline.operators.incremental import new_members
from aeroline.plans import files, gold, silver
from aeroline.plans.warehouse import star_of
from aeroline.sources.event_readings import raw_readings
from tests.conftest import rows, same


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_keys_tell_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", "c")], "x STRING, y STRING, z STRING")
    found = [row[0] for row in df.select(surrogate_key("x", "y", "z")).collect()]
    assert len(set(found)) == 3 and found[2] == md5("a-b-c")
    assert [row[0] for row in df.select(path_key("x", "y", "z")).collect()][2] == md5("a_b_c")


def test_message_key(spark):
    df = spark.createDataFrame([("84001", "CO"), (None, "CO")], "IntlAQSCode STRING, Parameter STRING")
    assert [row[0] for row in df.select(message_key()).collect()] == ["84001_CO", "_CO"]


def test_unknown_map_key_is_null(spark):
    assert spark.range(1).select(lookup({1: "x"}, F.lit(2))).first()[0] is None


def star(readings, *changes):
    return silver.clean_readings(readings(*changes))


def test_dimensions(readings, spark):
    cleaned = star(readings, {}, {"parameter": "CO", "unit": "PPM"}, {"utc": "2026-03-05T01:00", "category": 2})
    assert rows(gold.dim_date(cleaned)) == [("2026-03-04", md5("2026-03-04")), ("2026-03-05", md5("2026-03-05"))]
    assert rows(gold.dim_hour(cleaned)) == [(1, md5("1")), (14, md5("14"))]
    assert rows(gold.dim_category(cleaned)) == [(1, "Good", md5("1")), (2, "Moderate", md5("2"))]
    assert rows(gold.dim_parameter(cleaned)) == [("CO", "PPM", md5("CO-PPM")), ("OZONE", "PPB", md5("OZONE-PPB"))]
    assert rows(gold.dim_site(cleaned, spatial.region_table(spark)), "fullaqscode", "region_key") == [("112233445", "South")]


def test_moved_site_prefers_a_region_and_sites_outside_have_none(readings, spark):
    cleaned = star(readings, {"latitude": 0.0}, {"utc": "2026-03-04T15:00"}, {"fullaqscode": "9", "latitude": 0.0})
    found = rows(gold.dim_site(cleaned, spatial.region_table(spark)), "fullaqscode", "latitude", "region_key")
    assert found == [("112233445", 35.25, "South"), ("9", 0.0, None)]


def test_overlap_largest_key_and_first_region(readings, spark):
    cleaned = star(readings, {"latitude": 38.0, "longitude": -104.0})
    assert rows(gold.dim_site(cleaned, spatial.region_table(spark)), "region_key") == [("West",)]
    assert rows(cleaned.select(assign_region().alias("region"))) == [("Midwest",)]


def test_first_region_bounds_and_default(spark):
    points = [(36.5, -80.0), (36.4999, -80.0), (22.5, -154.0), (0.0, 0.0), (None, -80.0)]
    df = spark.createDataFrame(points, "latitude DOUBLE, longitude DOUBLE").withColumn("region", assign_region())
    assert [row.region for row in df.collect()] == ["Northeast", "South", "Hawaii", "Other", "Other"]


def test_site_increment_only_for_new_or_moved(readings, spark):
    regions = spatial.region_table(spark)
    known = gold.dim_site(star(readings, {}), regions)
    renamed = star(readings, {"sitename": "New name"})
    moved = star(readings, {"latitude": 40.0})
    assert gold.new_sites(renamed, known, regions).count() == 0
    assert rows(gold.new_sites(moved, known, regions), "latitude") == [(40.0,)]


def test_anti_join_survives_null_members(spark):
    members = spark.createDataFrame([(1,), (2,)], "category INT")
    known = spark.createDataFrame([(1,), (None,)], "category INT")
    assert rows(new_members(members, known, ["category"])) == [(2,)]


def test_fact_by_joins_equals_fact_by_keys_and_leaves_out_missing_units(readings):
    cleaned = star(readings, {}, {"unit": None, "parameter": "CO"}, {"utc": "2026-03-05T01:00", "category": 2})
    tables = star_of(cleaned)
    joined = gold.fact_readings(tables["cleaned"], tables["dim_site"], tables["dim_parameter"], tables["dim_category"],
                                tables["dim_date"], tables["dim_hour"])
    assert joined.count() == 2
    same(joined, gold.fact_readings_direct(cleaned))
    first = joined.filter("hour = 14").first()
    parts = ["2026-03-04", "14", "112233445", "OZONE-PPB", "1"]
    assert first.fact_id == md5("-".join(md5(part) for part in parts))


def test_results_do_not_depend_on_broadcasting(spark):
    """Beyond the size bound every join is a shuffle join; the results are the same."""
    cleaned = silver.clean_readings(raw_readings(spark, "/root/testdata/sf0.001"), ["event_id"])

    def build():
        tables = star_of(cleaned)
        fact = gold.fact_readings(tables["cleaned"], tables["dim_site"], tables["dim_parameter"], tables["dim_category"],
                                  tables["dim_date"], tables["dim_hour"])
        return fact, tables["dim_site"]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, sites = build()
        assert "Broadcast" not in fact._jdf.queryExecution().executedPlan().toString()
        shuffled, shuffled_sites = rows(fact), rows(sites)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact, sites = build()
    assert "BroadcastHashJoin" in fact._jdf.queryExecution().executedPlan().toString()
    assert (rows(fact), rows(sites)) == (shuffled, shuffled_sites)


def test_new_facts_are_insert_only(readings):
    known = gold.fact_readings_direct(star(readings, {}))
    same_category = gold.fact_readings_direct(star(readings, {"aqi": 40}))
    other_category = gold.fact_readings_direct(star(readings, {"aqi": 60, "category": 2}))
    assert gold.new_fact_rows(same_category, known).count() == 0
    assert gold.new_fact_rows(other_category, known).count() == 1


def test_calendar_and_reading_facts_hash_plain_hours(readings):
    silver_rows = files.clean_bronze(_bronze(readings({"utc": "2026-03-08T01:00"})))
    keyed = files.with_reading_keys(silver_rows)
    calendar = files.calendar_rows(keyed).first()
    assert calendar.date_key == md5("2026-03-08_1")
    assert (calendar.year, calendar.month, calendar.day, calendar.day_of_week, calendar.day_of_week_name) == (2026, 3, 8, 1, "Sunday")
    fact = files.reading_facts(keyed).first()
    assert fact.fact_id == md5("2026-03-08_1_840112233445_OZONE") and fact.site_key == md5("840112233445")


def _bronze(raw):
    from aeroline.sources.landing import with_partitions
    from aeroline.sources.event_readings import feed_records
    return with_partitions(feed_records(raw))


def test_file_variant_drops_missing_index_but_keeps_bad_category(readings):
    raw = readings({"aqi": None}, {"aqi": -999}, {"category": -999}, {"intlaqscode": None}, {"intlaqscode": None})
    assert rows(files.clean_bronze(_bronze(raw)), "intlaqscode", "category") == [("840112233445", -999), (None, 1)]


def test_grid_join_equals_brute_force(spark):
    """Points on and around box borders, checked against every box in plain Python."""
    boxes = [tuple(float(bound) for bound in box.split(",")) for box in REQUEST_BOXES]
    points = [(lat, lon) for lon_min, lat_min, lon_max, lat_max in boxes
              for lat, lon in [(lat_min, lon_min), (lat_max, lon_max), ((lat_min + lat_max) / 2, (lon_min + lon_max) / 2),
                               (lat_max + 1e-6, lon_max), (lat_min, lon_min - 1e-6)]]
    df = spark.createDataFrame(points, "latitude DOUBLE, longitude DOUBLE").distinct()
    found = rows(spatial.join_boxes(df, spatial.box_table(spark)), "latitude", "longitude", "box_id")
    expected = sorted(((lat, lon, i) for lat, lon in set(points) for i, (a, b, c, d) in enumerate(boxes)
                       if b <= lat <= d and a <= lon <= c), key=repr)
    assert found == expected
    assert spatial.box_table(spark, first=5).count() == 5


def test_grid_left_join_keeps_outside_and_null_points(spark):
    df = spark.createDataFrame([(0.0, 0.0), (None, None), (38.0, -104.0)], "latitude DOUBLE, longitude DOUBLE")
    joined = spatial.join_boxes(df, spatial.region_table(spark), how="left")
    assert rows(joined, "latitude", "region_key") == [(0.0, None), (38.0, "Midwest"), (38.0, "West"), (None, None)]


def test_regional_mean_counts_every_site_once(spark):
    site = spark.createDataFrame([
        ("2026-01-01", 5, 38.0, -90.0, 10.0), ("2026-01-01", 5, 39.0, -90.0, 30.0), ("2026-01-01", 5, 0.0, 0.0, 7.0)],
        "date STRING, hour INT, latitude DOUBLE, longitude DOUBLE, avg_aqi DOUBLE").withColumn("date", F.to_date("date"))
    local = series.with_local_time(site)
    assert rows(series.regional_mean(local)) == [("2026-01-01 00:00:00", "Midwest", 20.0), ("2026-01-01 00:00:00", "Other", 7.0)]


def test_local_range_is_inclusive_in_local_time(spark):
    hours = spark.createDataFrame([("2026-01-01", h) for h in range(24)], "date STRING, hour INT").withColumn("date", F.to_date("date"))
    local = series.local_range(series.with_local_time(hours), "2026-01-01 00:00:00", "2026-01-01 03:00:00")
    assert [row.hour for row in local.orderBy("hour").collect()] == [5, 6, 7, 8]


def test_local_time_follows_daylight_saving(spark):
    hours = spark.createDataFrame([("2026-03-08", 6), ("2026-03-08", 7)], "date STRING, hour INT").withColumn("date", F.to_date("date"))
    assert rows(series.with_local_time(hours), "datetime_local") == [("2026-03-08 01:00:00",), ("2026-03-08 03:00:00",)]


def test_site_means_combine_sites_at_one_coordinate(spark):
    fact = spark.createDataFrame([("2026-01-01", 1, "a", "p", 10), ("2026-01-01", 1, "a", "p", 20), ("2026-01-01", 1, "b", "p", 60)],
                                 "date STRING, hour INT, site_key STRING, parameter_key STRING, aqi INT").withColumn("date", F.to_date("date"))
    parameters = spark.createDataFrame([("p", "CO"), ("q", "NO2")], "parameter_key STRING, parameter STRING")
    sites = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0)], "site_key STRING, latitude DOUBLE, longitude DOUBLE")
    found = series.site_hourly_mean(fact, parameters, sites, "CO", "2026-01-01", "2026-01-01")
    assert rows(found, "latitude", "longitude", "avg_aqi") == [(1.0, 2.0, 30.0)]


def test_running_total_and_moving_average_equal_plain_windows(spark):
    df = spark.range(2000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 40) END AS site", "CAST(id AS INT) AS n",
        "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, CAST(id / 4 AS INT)) AS moment",
        "CAST(xxhash64(id) % 100 AS INT) AS aqi").withColumn("day", F.to_date("moment"))
    total = trends.running_total(df, "site", "day", ["moment", "n"], "aqi")
    expected = df.withColumn("running_total", F.expr("sum(aqi) OVER (PARTITION BY site ORDER BY moment, n ROWS UNBOUNDED PRECEDING)"))
    same(total, expected)
    for hours in (24, 100):
        mean = trends.moving_average(df, ["site"], "moment", "aqi", hours)
        plain = df.withColumn("moving_avg", F.expr(
            f"avg(aqi) OVER (PARTITION BY site ORDER BY moment RANGE BETWEEN INTERVAL '{hours * 3600 - 1}' SECOND PRECEDING AND CURRENT ROW)"))
        same(mean.withColumn("moving_avg", F.round("moving_avg", 9)), plain.withColumn("moving_avg", F.round("moving_avg", 9)))


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -2), (2, "c", None)], "k INT, s STRING, aqi INT")
    assert rows(quality.not_null(df, ["k", "s", "aqi"])) == [("aqi", 1), ("k", 0), ("s", 1)]
    assert rows(quality.unique(df, ["k"])) == [(1, 2)]
    assert quality.unique(df, ["k", "s"]).count() == 0
    assert rows(quality.accepted_values(df, "k", [1]), "k") == [(2,)]
    assert rows(quality.at_least(df, "aqi", 0), "aqi") == [(-2,)]
    dimension = spark.createDataFrame([("a",)], "s STRING")
    assert rows(quality.orphans(df, dimension, "s"), "s") == [("c",), (None,)]
    keyed = df.selectExpr("CAST(k AS STRING) AS k", "s")
    numbers = spark.createDataFrame([("1",), ("2",)], "k STRING")
    assert rows(quality.orphan_counts(keyed, {"s": (dimension, "s"), "k": (numbers, "k")})) == [("k", 0), ("s", 2)]
    summary = quality.count_violations({"u": quality.unique(df, ["k"]), "r": quality.at_least(df, "aqi", -9)})
    assert rows(summary) == [("r", 0), ("u", 1)]


def test_row_conditions_in_one_scan(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (-5, 3)], "a INT, b INT")
    found = quality.failing_rows(df, {"a_null": F.col("a").isNull(), "a_low": F.col("a") < 0, "b_null": F.col("b").isNull()})
    assert rows(found) == [("a_low", 1), ("a_null", 1), ("b_null", 1)]


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, "a")], "k INT, s STRING")
    wanted = spark.createDataFrame([(1, "a")], "k BIGINT, t STRING").schema
    assert quality.schema_differences(df, wanted) == [
        ("k", "bigint", "int"), ("t", "string", "absent"), ("s", "absent", "string")]


def test_region_table_order(spark):
    assert [row.region_key for row in spatial.region_table(spark).orderBy("precedence").collect()] == [r[0] for r in REGIONS]
