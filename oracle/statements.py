"""The same queries as ANSI SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

from aeroline.fixed_values import REGIONS, REQUEST_BOXES
from aeroline.sources.event_readings import RAW_COLUMNS

RUN_TIME = "2024-02-01 00:00:00"
NULL_PART = "_dbt_utils_surrogate_key_null_"

RAW = f"raw AS (SELECT {', '.join(RAW_COLUMNS)} FROM events)"
HOURLY = f"raw AS (SELECT * REPLACE (date_trunc('hour', utc) AS utc) FROM (SELECT {', '.join(RAW_COLUMNS)} FROM events))"
CUTOFF = "cutoff AS (SELECT CAST(CAST(max(utc) AS DATE) AS TIMESTAMP) AS day_start FROM raw)"
EARLIER = "earlier AS (SELECT * FROM raw WHERE utc < (SELECT day_start FROM cutoff))"

VALID = """aqi <> -999 AND category <> -999 AND aqi IS NOT NULL AND category IS NOT NULL AND fullaqscode IS NOT NULL
  AND parameter IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND utc IS NOT NULL"""
REJECT = """(aqi IS NULL OR category IS NULL OR aqi = -999 OR category = -999 OR fullaqscode IS NULL OR intlaqscode IS NULL
  OR parameter IS NULL OR latitude IS NULL OR longitude IS NULL OR utc IS NULL)"""
REASON = """CASE WHEN aqi = -999 THEN 'INVALID_AQI' WHEN aqi IS NULL THEN 'NULL_AQI'
  WHEN category = -999 THEN 'INVALID_CATEGORY' WHEN category IS NULL THEN 'NULL_CATEGORY'
  WHEN sitename IS NULL THEN 'NULL_SITE' WHEN parameter IS NULL THEN 'NULL_PARAMETER'
  WHEN fullaqscode IS NULL THEN 'NULL_FULLAQSCODE' WHEN intlaqscode IS NULL THEN 'NULL_INTLAQSCODE'
  WHEN agencyname IS NULL THEN 'NULL_AGENCY' WHEN latitude IS NULL THEN 'NULL_LATITUDE'
  WHEN longitude IS NULL THEN 'NULL_LONGITUDE' WHEN utc IS NULL THEN 'NULL_DATETIME' END"""
CONCERN = """CASE category WHEN 1 THEN 'Good' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Unhealthy for Sensitive Groups'
  WHEN 4 THEN 'Unhealthy' WHEN 5 THEN 'Very Unhealthy' WHEN 6 THEN 'Hazardous' END"""
CLEANED_COLUMNS = """parameter, unit, aqi, category, sitename, agencyname, latitude, longitude, fullaqscode,
  CAST(date AS VARCHAR) AS date, hour, concern_level"""


def valid(source: str, name: str = "valid", where: str = "TRUE") -> str:
    return f"""{name} AS (SELECT *, CAST(utc AS DATE) AS date, CAST(hour(utc) AS INT) AS hour, {CONCERN} AS concern_level
      FROM {source} WHERE {VALID} AND {where})"""


def cleaned(source: str = "raw", name: str = "cleaned", where: str = "TRUE") -> str:
    return valid(source, f"{name}_valid", where) + f""", {name} AS (SELECT * FROM {name}_valid QUALIFY row_number() OVER (
      PARTITION BY date, hour, fullaqscode, parameter ORDER BY aqi DESC, event_id) = 1)"""


def rejected(source: str = "raw", name: str = "rejected", where: str = "TRUE") -> str:
    return f"""{name}_losers AS (
        SELECT *, 'DUPLICATE' AS rejection_reason FROM {source} WHERE NOT {REJECT} AND {where}
        QUALIFY row_number() OVER (PARTITION BY utc, fullaqscode, parameter ORDER BY aqi DESC, event_id) > 1),
      {name}_all AS (SELECT * FROM {name}_losers
        UNION ALL SELECT *, {REASON} AS rejection_reason FROM {source} WHERE {REJECT} AND {where}),
      {name} AS (SELECT * FROM {name}_all
        QUALIFY row_number() OVER (PARTITION BY utc, fullaqscode, parameter ORDER BY event_id) = 1)"""


REJECTED_COLUMNS = f"""parameter, unit, aqi, category, sitename, agencyname, latitude, longitude, fullaqscode, intlaqscode,
  strftime(utc, '%Y-%m-%d %H:%M:%S') AS utc, rejection_reason, '{RUN_TIME}' AS rejected_at"""


def key(*names: str, sep: str = "-") -> str:
    parts = [f"coalesce(CAST({name} AS VARCHAR), '{NULL_PART}')" for name in names]
    return "md5(" + f" || '{sep}' || ".join(parts) + ")"


DIMS = f"""
  dim_category AS (SELECT DISTINCT category, concern_level, {key('category')} AS category_key FROM cleaned),
  dim_parameter AS (SELECT DISTINCT parameter, unit, {key('parameter', 'unit')} AS parameter_key FROM cleaned),
  dim_date AS (SELECT DISTINCT date, {key('date')} AS date_key FROM cleaned),
  dim_hour AS (SELECT DISTINCT hour, {key('hour')} AS hour_key FROM cleaned),
  dim_region AS (SELECT * FROM (VALUES {', '.join(str(region) for region in REGIONS)})
    AS r(region_key, lat_min, lat_max, lon_min, lon_max)),
  dim_site AS (SELECT c.fullaqscode, c.sitename, c.agencyname, c.latitude, c.longitude, {key('c.fullaqscode')} AS site_key,
      g.region_key
    FROM cleaned c LEFT JOIN dim_region g ON c.latitude >= g.lat_min AND c.latitude <= g.lat_max
      AND c.longitude >= g.lon_min AND c.longitude <= g.lon_max
    QUALIFY row_number() OVER (PARTITION BY c.fullaqscode
      ORDER BY g.region_key DESC NULLS LAST, c.sitename, c.agencyname, c.latitude, c.longitude) = 1)"""
FACT_KEYS = "date_key, hour_key, site_key, parameter_key, category_key"
FACT = f"""fact AS (SELECT dd.date_key, dh.hour_key, ds.site_key, dp.parameter_key, dc.category_key,
    {key('date_key', 'hour_key', 'site_key', 'parameter_key', 'category_key')} AS fact_id, s.aqi, s.date, s.hour
  FROM cleaned s JOIN dim_site ds ON s.fullaqscode = ds.fullaqscode
    JOIN dim_parameter dp ON s.parameter = dp.parameter AND s.unit = dp.unit
    JOIN dim_category dc ON s.category = dc.category JOIN dim_date dd ON s.date = dd.date JOIN dim_hour dh ON s.hour = dh.hour)"""
FACT_COLUMNS = f"{FACT_KEYS}, fact_id, aqi, CAST(date AS VARCHAR) AS date, hour"
STAR = f"WITH {RAW}, {cleaned()}, {DIMS}, {FACT}"

BRONZE = f"""{RAW}, bronze AS (SELECT latitude, longitude, parameter, unit, aqi, category, sitename, agencyname, intlaqscode,
    CAST(utc AS DATE) AS date, CAST(hour(utc) AS INT) AS hour, {CONCERN} AS concern_level FROM raw WHERE aqi <> -999),
  silver AS (SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY date, hour, intlaqscode, parameter
    ORDER BY latitude, longitude, unit NULLS LAST, aqi, category NULLS LAST, sitename, agencyname, concern_level NULLS LAST) = 1)"""
READING_FACTS = f"""SELECT {key('date', 'hour', 'intlaqscode', 'parameter', sep='_')} AS fact_id, CAST(date AS VARCHAR) AS date,
    hour, {key('intlaqscode', sep='_')} AS site_key, {key('parameter', 'unit', sep='_')} AS parameter_key,
    {key('date', 'hour', sep='_')} AS date_key, {key('category', sep='_')} AS category_key, aqi FROM silver"""

INCREMENT = "date_trunc('hour', utc) > (SELECT max(date + to_hours(hour)) - INTERVAL 1 HOUR FROM stored)"

HOURLY_MEAN = f"""{STAR}, hourly AS (SELECT f.date, f.hour, avg(f.aqi) AS avg_aqi
    FROM fact f JOIN dim_parameter p ON f.parameter_key = p.parameter_key
    WHERE f.date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' AND p.parameter = 'PM2.5' GROUP BY f.date, f.hour)"""
SITE_MEAN = f"""{STAR}, site_hourly AS (SELECT f.date, f.hour, s.latitude, s.longitude, avg(f.aqi) AS avg_aqi
    FROM fact f JOIN dim_parameter p ON f.parameter_key = p.parameter_key JOIN dim_site s ON f.site_key = s.site_key
    WHERE f.date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' AND p.parameter = 'PM2.5'
    GROUP BY f.date, f.hour, s.latitude, s.longitude)"""
LOCAL = "timezone('US/Eastern', timezone('UTC', date + to_hours(hour)))"
LOCAL_RANGE = "BETWEEN TIMESTAMP '2024-01-11 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59'"

FIRST_REGION = "CASE " + " ".join(
    f"WHEN latitude BETWEEN {a} AND {b} AND longitude BETWEEN {c} AND {d} THEN '{name}'" for name, a, b, c, d in REGIONS
) + " ELSE 'Other' END"
BOXES = ", ".join(f"({i}, {box})" for i, box in enumerate(REQUEST_BOXES))
FIRST_BOXES = ", ".join(f"({i}, {box})" for i, box in enumerate(REQUEST_BOXES[:5]))
POINTS = "points AS (SELECT sitename, latitude, longitude, count(*) AS readings FROM raw GROUP BY ALL)"

FEED_TIME = "strftime(utc, '%Y-%m-%dT%H:%M')"
SITE_HOURS = """ozone AS (SELECT DISTINCT CAST(date AS VARCHAR) AS date, hour, fullaqscode FROM valid WHERE parameter = 'OZONE'),
  co AS (SELECT DISTINCT CAST(date AS VARCHAR) AS date, hour, fullaqscode FROM valid WHERE parameter = 'CO')"""
MEMBERS = """activity AS (SELECT user_id AS member_id, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases
    FROM events GROUP BY user_id),
  spending AS (SELECT o_custkey AS member_id, count(*) AS orders,
    round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS spent FROM orders GROUP BY o_custkey)"""

NULL_COLUMNS = ["utc", "parameter", "unit", "aqi", "category", "fullaqscode", "intlaqscode", "sitename", "agencyname",
                "latitude", "longitude"]
ORPHAN_CHECKS = {"dim_site": "site_key", "dim_parameter": "parameter_key", "dim_category": "category_key",
                 "dim_date": "date_key", "dim_hour": "hour_key"}

OLDEST = "oldest AS (SELECT date_trunc('hour', min(utc)) AS o FROM raw)"
TRUNCATED = "strftime({}, '%Y-%m-%dT%H:%M')"

CALENDAR_NAMES = """CASE dayofweek(date) WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
  WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' END"""

def stream_join(how: str) -> str:
    return f"""WITH daily AS (SELECT user_id, event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL),
        views AS (SELECT * FROM daily WHERE event_type = 'view'), purchases AS (SELECT * FROM daily WHERE event_type = 'purchase')
        SELECT v.user_id, v.n AS views, p.n AS purchases, strftime(v.day, '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(v.day + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end
        FROM views v {how} JOIN purchases p ON v.user_id = p.user_id AND v.day = p.day"""


def stream_interval(how: str) -> str:
    return f"""SELECT v.user_id, v.event_id AS view_id, strftime(v.ts, '%Y-%m-%d %H:%M:%S') AS viewed_at, p.event_id AS purchase_id,
        strftime(p.ts, '%Y-%m-%d %H:%M:%S') AS purchased_at, p.value AS paid
        FROM (SELECT * FROM events WHERE event_type = 'view') v
        {how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
          ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR"""


WEEK = "utc BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-16 23:59:59'"
CORRECTED = f"""again AS (SELECT * REPLACE (-event_id AS event_id, aqi + CASE WHEN event_id % 13 = 0 THEN 60 ELSE 10 END AS aqi,
      CASE WHEN event_id % 13 = 0 THEN least(category + 1, 6) ELSE category END AS category)
    FROM raw WHERE (event_id % 11 = 0 OR event_id % 13 = 0) AND aqi > 0 AND category > 0),
  issued AS (SELECT * FROM raw UNION ALL SELECT * FROM again WHERE {WEEK})"""

CHECKED = f"""unitless AS (SELECT * REPLACE (CASE WHEN event_id % 10 <> 0 THEN unit END AS unit) FROM raw),
  {cleaned('unitless')}, {DIMS}, {FACT}"""
CHECKS = {"cleaned": ["date", "hour", "fullaqscode", "parameter", "unit", "aqi", "category", "latitude", "longitude", "concern_level"],
          "fact": ["date_key", "hour_key", "site_key", "parameter_key", "category_key", "aqi"],
          "dim_site": ["site_key", "fullaqscode"], "dim_parameter": ["parameter_key", "parameter", "unit"],
          "dim_category": ["category_key", "category", "concern_level"], "dim_date": ["date_key", "date"], "dim_hour": ["hour_key", "hour"]}
UNIQUE = {"cleaned": ("cleaned", "date, hour, fullaqscode, parameter"), "fact": ("fact", FACT_KEYS)} | {
    name: (table, columns) for table, key_name, columns in [
        ("dim_site", "site_key", "fullaqscode"), ("dim_parameter", "parameter_key", "parameter, unit"),
        ("dim_category", "category_key", "category"), ("dim_date", "date_key", "date"), ("dim_hour", "hour_key", "hour")]
    for name, columns in [(f"{table}_key", key_name), (table, columns)]}
VALIDATION = " UNION ALL ".join(
    [f"SELECT '{t}_{c}_not_null' AS check_name, count(*) FILTER ({c} IS NULL) AS violations FROM {t}" for t, names in CHECKS.items() for c in names]
    + [f"SELECT '{name}_unique', count(*) FROM (SELECT 1 FROM {t} GROUP BY {columns} HAVING count(*) > 1)" for name, (t, columns) in UNIQUE.items()]
    + [f"SELECT 'fact_{t}', count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{k} = f.{k})" for t, k in ORPHAN_CHECKS.items()]
    + ["SELECT 'cleaned_category_values', count(*) FROM cleaned WHERE category NOT BETWEEN 1 AND 6",
       "SELECT 'dim_category_category_values', count(*) FROM dim_category WHERE category NOT BETWEEN 1 AND 6",
       "SELECT 'cleaned_aqi_range', count(*) FROM cleaned WHERE aqi < 0",
       """SELECT 'fact_cleaned_counts', abs((SELECT count(*) FROM cleaned WHERE unit IS NOT NULL) - (SELECT count(*) FROM fact))"""])

STATEMENTS = {
    "validation_report": f"WITH {HOURLY}, {CHECKED} {VALIDATION}",
    "job_end_to_end": f"""WITH {RAW}, sent AS (SELECT * REPLACE (date_trunc('minute', utc) AS utc), coalesce(minute(utc) % 10 = 9, FALSE) AS is_broken FROM raw),
        records AS (SELECT * FROM sent WHERE NOT is_broken), {cleaned('records')}, {rejected('records')}
      SELECT 'messages' AS stage, count(*) AS rows FROM sent UNION ALL SELECT 'bronze', count(*) FROM records
      UNION ALL SELECT 'broken', count(*) FROM sent WHERE is_broken UNION ALL SELECT 'cleaned', count(*) FROM cleaned
      UNION ALL SELECT 'rejected', count(*) FROM rejected UNION ALL SELECT 'facts', count(*) FROM cleaned WHERE unit IS NOT NULL""",
    "job_report": f"""WITH {RAW}, sent AS (SELECT * REPLACE (date_trunc('minute', utc) AS utc) FROM raw),
        first_part AS (SELECT * FROM sent WHERE event_id % 17 <> 0), {cleaned('first_part', 'before')},
        second AS (SELECT *, event_id % 2 = 0 AND aqi IS NOT NULL AS odd FROM sent WHERE event_id % 17 = 0),
        newest AS (SELECT max(date + to_hours(hour)) AS h FROM before),
        both_parts AS (SELECT * FROM first_part UNION ALL SELECT * EXCLUDE (odd) FROM second WHERE NOT odd),
        {cleaned('both_parts', 'taken', "date_trunc('hour', utc) >= (SELECT h FROM newest)")}
      SELECT 'bronze' AS stage, 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM second
      UNION ALL SELECT 'bronze', 'broken', '0' UNION ALL SELECT 'bronze', 'odd_types', CAST(count(*) AS VARCHAR) FROM second WHERE odd
      UNION ALL SELECT 'bronze', 'late', CAST(count(*) AS VARCHAR) FROM second WHERE utc < (SELECT h FROM newest)
      UNION ALL SELECT 'bronze', 'type of AQI', 'STRING instead of int'
      UNION ALL SELECT 'cleaned', 'rows', CAST(count(*) AS VARCHAR) FROM taken""",
    "history_windows": f"""WITH {RAW}, {cleaned()}, ends AS (SELECT TIMESTAMP '2024-02-01' - to_days(CAST(14 * n AS INT)) AS e FROM range(0, 3) AS r(n))
        SELECT strftime(e - INTERVAL 14 DAY, '%Y-%m-%dT%H:%M') AS window_start, count(*) AS cleaned, count(*) AS facts
        FROM ends JOIN cleaned ON date + to_hours(hour) >= e - INTERVAL 14 DAY AND date + to_hours(hour) < e GROUP BY e""",
    "catalogue_readings": f"""{STAR} SELECT CAST(f.date AS VARCHAR) AS date, f.hour, s.fullaqscode, s.sitename, s.agencyname, s.latitude,
        s.longitude, s.region_key, p.parameter, p.unit, c.category, c.concern_level, f.aqi
      FROM fact f JOIN dim_site s USING (site_key) JOIN dim_parameter p USING (parameter_key) JOIN dim_category c USING (category_key)""",
    "listed_unprocessed_partitions": f"""WITH {RAW}, {CUTOFF}, {EARLIER}
        SELECT DISTINCT CAST(CAST(utc AS DATE) AS VARCHAR) AS date, CAST(hour(utc) AS INT) AS hour FROM raw
        EXCEPT SELECT CAST(CAST(utc AS DATE) AS VARCHAR), CAST(hour(utc) AS INT) FROM earlier""",
    "weekday_hourly_mean": f"""{STAR} SELECT hour, round(avg(aqi), 6) AS avg_aqi, count(*) AS readings FROM fact
        WHERE dayofweek(date) = 1 GROUP BY hour""",
    "yearly_monthly_counts": f"""WITH {RAW}, {cleaned()} SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
        count(*) AS readings, count(DISTINCT date) AS days FROM cleaned GROUP BY 1, 2""",
    "json_array_readings": f"""WITH {RAW} SELECT sitename, count(*) AS readings, CAST(sum(aqi) AS BIGINT) AS total_aqi, count(aqi) AS with_aqi
        FROM raw GROUP BY sitename""",
    "first_boxes_membership": f"""WITH {RAW}, {POINTS}, boxes AS (SELECT * FROM (VALUES {FIRST_BOXES})
          AS b(box_id, lon_min, lat_min, lon_max, lat_max))
        SELECT b.box_id, count(p.readings) AS sites, CAST(coalesce(sum(p.readings), 0) AS BIGINT) AS readings FROM boxes b LEFT JOIN points p
          ON p.latitude BETWEEN b.lat_min AND b.lat_max AND p.longitude BETWEEN b.lon_min AND b.lon_max GROUP BY b.box_id""",
    "archived_batches": """SELECT 'first run' AS place, count(*) FILTER (event_id % 10 <> 0) AS readings FROM events
        UNION ALL SELECT 'second run', count(*) FILTER (event_id % 10 = 0) FROM events
        UNION ALL SELECT 'bronze', count(*) FROM events UNION ALL SELECT 'landing and archive', count(*) FROM events""",
    "stream_quarantine_once": f"WITH {RAW} SELECT event_id, {REASON} AS rejection_reason FROM raw WHERE {REJECT}",
    "reprocessed_facts": f"WITH {HOURLY}, {CORRECTED}, {cleaned('issued')}, {DIMS}, {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "reprocessing_checks": f"""WITH {HOURLY}, {CORRECTED}, {cleaned('raw', 'before')}, {cleaned('issued', 'after', WEEK)},
        keys AS (SELECT DISTINCT date, hour, fullaqscode, parameter, category FROM (SELECT * FROM before UNION ALL SELECT * FROM after)
          WHERE date IN (SELECT date FROM after)),
        balance AS (SELECT count(*) AS n, (SELECT count(*) FROM after a WHERE a.date = k.date AND a.hour = k.hour) AS m
          FROM keys k GROUP BY k.date, k.hour)
        SELECT 'insert' AS facts, CAST(sum(abs(n - m)) AS BIGINT) AS violations FROM balance UNION ALL SELECT 'rebuild', 0""",
    "stream_interval_inner": stream_interval("INNER"),
    "stream_interval_left": stream_interval("LEFT"),
    "stream_join_anti": """SELECT v.user_id, v.event_id AS view_id, strftime(v.ts, '%Y-%m-%d %H:%M:%S') AS viewed_at FROM events v
        WHERE v.event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id
          AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR)""",
    "stream_join_inner": stream_join("INNER"),
    "stream_join_left": stream_join("LEFT"),
    "cleaned_readings": f"WITH {RAW}, {cleaned()} SELECT {CLEANED_COLUMNS} FROM cleaned",
    "stream_silver_upsert": f"WITH {RAW}, {cleaned()} SELECT {CLEANED_COLUMNS} FROM cleaned",
    "cleaned_spark_variant": f"""WITH {BRONZE} SELECT latitude, longitude, parameter, unit, aqi, category, sitename, agencyname,
        intlaqscode, CAST(date AS VARCHAR) AS date, hour, concern_level FROM silver""",
    "rejected_readings": f"WITH {HOURLY}, {rejected()} SELECT {REJECTED_COLUMNS} FROM rejected",
    "rejection_counts": f"""WITH {HOURLY}, {rejected()} SELECT rejection_reason, count(*) AS readings FROM rejected
        GROUP BY rejection_reason""",
    "duplicate_losers": f"""WITH {HOURLY}, {rejected()} SELECT event_id, strftime(utc, '%Y-%m-%d %H:%M:%S') AS utc, fullaqscode,
        parameter, aqi, category, rejection_reason FROM rejected_losers""",
    "dim_category": f"WITH {RAW}, {cleaned()}, {DIMS} SELECT * FROM dim_category",
    "dim_parameter": f"WITH {RAW}, {cleaned()}, {DIMS} SELECT * FROM dim_parameter",
    "dim_date": f"WITH {RAW}, {cleaned()}, {DIMS} SELECT CAST(date AS VARCHAR) AS date, date_key FROM dim_date",
    "dim_hour": f"WITH {RAW}, {cleaned()}, {DIMS} SELECT * FROM dim_hour",
    "dim_site_region": f"WITH {RAW}, {cleaned()}, {DIMS} SELECT * FROM dim_site",
    "dim_calendar": f"""WITH {BRONZE} SELECT DISTINCT {key('date', 'hour', sep='_')} AS date_key, CAST(date AS VARCHAR) AS date, hour,
        CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day,
        CAST(dayofweek(date) + 1 AS INT) AS day_of_week, {CALENDAR_NAMES} AS day_of_week_name FROM silver""",
    "dim_site_by_intl_code": f"""WITH {BRONZE} SELECT {key('intlaqscode', sep='_')} AS site_key, intlaqscode, sitename, agencyname,
        latitude, longitude FROM silver QUALIFY row_number() OVER (PARTITION BY intlaqscode
        ORDER BY sitename, agencyname, latitude, longitude) = 1""",
    "fact_readings": f"{STAR} SELECT {FACT_COLUMNS} FROM fact",
    "fact_readings_direct": f"{STAR} SELECT {FACT_COLUMNS} FROM fact",
    "warehouse_fact": f"{STAR} SELECT {FACT_COLUMNS} FROM fact",
    "fact_keys_reading_grain": f"WITH {BRONZE} {READING_FACTS}",
    "medallion_two_deliveries": f"WITH {BRONZE} {READING_FACTS}",
    "medallion_fact": f"WITH {BRONZE} {READING_FACTS}",
    "incremental_silver_batch": f"""WITH {RAW}, {CUTOFF}, {EARLIER}, {valid('earlier', 'stored')},
        {cleaned('raw', 'cleaned', INCREMENT)} SELECT {CLEANED_COLUMNS} FROM cleaned""",
    "incremental_backfill_batch": f"WITH {RAW}, {cleaned('raw', 'cleaned', f'utc {LOCAL_RANGE}')} SELECT {CLEANED_COLUMNS} FROM cleaned",
    "incremental_rejected_batch": f"""WITH {HOURLY}, {CUTOFF}, {EARLIER}, {rejected('earlier', 'stored')},
        {rejected('raw', 'rejected', "(utc IS NULL OR utc > (SELECT max(utc) - INTERVAL 1 HOUR FROM stored))")}
        SELECT {REJECTED_COLUMNS} FROM rejected""",
    "late_rows": f"""WITH {RAW}, {CUTOFF}, {EARLIER}, {valid('earlier', 'stored')}
        SELECT count(*) FILTER ({INCREMENT}) AS on_time, count(*) FILTER (NOT ({INCREMENT})) AS late FROM raw""",
    "new_dim_members_not_in": f"""WITH {RAW}, {CUTOFF}, {EARLIER}, {valid('raw')}, {valid('earlier', 'stored')}
        SELECT DISTINCT CAST(date AS VARCHAR) AS date, {key('date')} AS date_key FROM valid
        WHERE date NOT IN (SELECT date FROM stored)""",
    "new_fact_rows_not_exists": f"""{STAR}, {CUTOFF}, {EARLIER}, {cleaned('earlier', 'old')}
        SELECT {FACT_COLUMNS} FROM fact f WHERE NOT EXISTS (SELECT 1 FROM old o WHERE {key('o.date')} = f.date_key
          AND {key('o.hour')} = f.hour_key AND {key('o.fullaqscode')} = f.site_key
          AND {key('o.parameter', 'o.unit')} = f.parameter_key AND {key('o.category')} = f.category_key)""",
    "upsert_by_key": f"""WITH {RAW}, {CUTOFF}, {EARLIER}, {cleaned('earlier', 'stored')}, {cleaned('raw', 'fresh', INCREMENT)},
        merged AS (SELECT * FROM fresh UNION ALL SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM fresh f
          WHERE f.date = s.date AND f.hour = s.hour AND f.fullaqscode = s.fullaqscode AND f.parameter = s.parameter))
        SELECT {CLEANED_COLUMNS} FROM merged""",
    "unprocessed_partitions": f"""WITH {RAW}, {CUTOFF}, {EARLIER}
        SELECT DISTINCT CAST(CAST(utc AS DATE) AS VARCHAR) AS date, CAST(hour(utc) AS INT) AS hour FROM raw
        EXCEPT SELECT CAST(CAST(utc AS DATE) AS VARCHAR), CAST(hour(utc) AS INT) FROM earlier""",
    "hourly_mean_aqi": f"{HOURLY_MEAN} SELECT CAST(date AS VARCHAR) AS date, hour, round(avg_aqi, 6) AS avg_aqi FROM hourly ORDER BY 1, 2",
    "site_hourly_mean": f"""{SITE_MEAN} SELECT CAST(date AS VARCHAR) AS date, hour, latitude, longitude, round(avg_aqi, 6) AS avg_aqi
        FROM site_hourly ORDER BY 1, 2""",
    "local_time_window": f"""{HOURLY_MEAN} SELECT CAST(date AS VARCHAR) AS date, hour, round(avg_aqi, 6) AS avg_aqi,
        strftime(date + to_hours(hour), '%Y-%m-%d %H:%M:%S') AS datetime_utc,
        strftime({LOCAL}, '%Y-%m-%d %H:%M:%S') AS datetime_local FROM hourly WHERE {LOCAL} {LOCAL_RANGE}""",
    "region_first_match": f"WITH {RAW}, {POINTS} SELECT *, {FIRST_REGION} AS region FROM points",
    "regional_mean_of_means": f"""{SITE_MEAN} SELECT strftime({LOCAL}, '%Y-%m-%d %H:%M:%S') AS datetime_local,
        {FIRST_REGION} AS region, round(avg(avg_aqi), 6) AS avg_aqi FROM site_hourly WHERE {LOCAL} {LOCAL_RANGE} GROUP BY 1, 2""",
    "bbox_membership": f"""WITH {RAW}, {POINTS}, boxes AS (SELECT * FROM (VALUES {BOXES})
          AS b(box_id, lon_min, lat_min, lon_max, lat_max))
        SELECT p.*, b.box_id FROM points p JOIN boxes b ON p.latitude BETWEEN b.lat_min AND b.lat_max
          AND p.longitude BETWEEN b.lon_min AND b.lon_max""",
    "pollutant_filter": f"""WITH {RAW} SELECT parameter, unit, count(*) AS readings FROM raw
        WHERE parameter IN ('PM2.5', 'OZONE') GROUP BY parameter, unit""",
    "dq_not_null": f"WITH {RAW} " + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS violations FROM raw" for name in NULL_COLUMNS),
    "dq_unique": f"WITH {RAW} SELECT fullaqscode, count(*) AS occurrences FROM raw GROUP BY fullaqscode HAVING count(*) > 1",
    "dq_unique_combination": f"""WITH {RAW}, {valid('raw')} SELECT CAST(date AS VARCHAR) AS date, hour, fullaqscode, parameter,
        count(*) AS occurrences FROM valid GROUP BY ALL HAVING count(*) > 1""",
    "dq_accepted_values": f"WITH {RAW} SELECT event_id, category FROM raw WHERE category NOT IN (1, 2, 3, 4, 5, 6)",
    "dq_range": f"WITH {RAW} SELECT event_id, aqi FROM raw WHERE aqi < 0",
    "dq_orphan_rows": f"""{STAR}, {CUTOFF}, {EARLIER}, {valid('earlier', 'old')} SELECT f.fact_id, f.date_key,
        CAST(f.date AS VARCHAR) AS date, f.hour, f.aqi FROM fact f
        LEFT JOIN (SELECT DISTINCT date FROM old) d ON f.date = d.date WHERE d.date IS NULL""",
    "dq_orphans": f"{STAR}, {CUTOFF}, {EARLIER}, {cleaned('earlier', 'old')} " + " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, count(*) AS violations FROM fact
            WHERE {column} NOT IN (SELECT {key(*members)} FROM old)"""
        for (name, column), members in zip(ORPHAN_CHECKS.items(),
                                           [("fullaqscode",), ("parameter", "unit"), ("category",), ("date",), ("hour",)])),
    "stage_reconciliation": f"""WITH {RAW}, {cleaned()}, parts AS (SELECT count(*) AS raw,
          count(*) FILTER ({VALID}) AS valid, count(*) FILTER ({REJECT}) AS rejected,
          count(*) FILTER ({VALID} AND {REJECT}) AS in_both, (SELECT count(*) FROM cleaned) AS cleaned FROM raw)
        SELECT *, valid - cleaned AS merged_away, valid + rejected - in_both = raw AS adds_up FROM parts""",
    "kafka_rows": f"""WITH {RAW} SELECT coalesce(intlaqscode, '') || '_' || coalesce(parameter, '') AS key,
        CAST(json_object('Latitude', latitude, 'Longitude', longitude, 'UTC', {FEED_TIME}, 'Parameter', parameter, 'Unit', unit,
          'AQI', aqi, 'Category', category, 'SiteName', sitename, 'AgencyName', agencyname, 'FullAQSCode', fullaqscode,
          'IntlAQSCode', intlaqscode) AS VARCHAR) AS value FROM raw""",
    "kafka_round_trip": f"""WITH {RAW} SELECT latitude, longitude, {FEED_TIME} AS utc, parameter, unit, aqi, category, sitename,
        agencyname, fullaqscode, intlaqscode FROM raw""",
    "user_event_messages": """SELECT CAST(user_id AS VARCHAR) AS key, CAST(json_object('event_id', event_id, 'user_id', user_id,
        'event_type', event_type, 'value', value) AS VARCHAR) AS value FROM events""",
    "transaction_event_messages": """SELECT CAST(o_custkey AS VARCHAR) AS key, '{"o_orderkey":' || o_orderkey || ',"o_custkey":'
        || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","total":' || CAST(o_totalprice AS DECIMAL(18,2)) || '}' AS value
        FROM orders""",
    "api_payload_rows": """SELECT event_id, 'Site ' || user_id AS sitename, CAST(floor(value) AS INT) AS aqi FROM events
          WHERE event_type IN ('view', 'click')
        UNION ALL SELECT event_id, 'Next ' || user_id, NULL FROM events WHERE event_type = 'view'""",
    "api_payload_failures": """SELECT event_id, CASE event_type WHEN 'error' THEN 'service_error' WHEN 'signup' THEN 'bad_json'
          ELSE 'unexpected_object' END AS status, CASE WHEN event_type = 'error' THEN 'failed ' || event_id END AS error_message
        FROM events WHERE event_type IN ('error', 'signup', 'purchase')""",
    "progress_min_date": f"""WITH {RAW} SELECT min({FEED_TIME}) AS oldest_loaded, min({FEED_TIME}) <= '2019-09-01T00:00' AS is_done
        FROM raw""",
    "backfill_windows": f"""WITH {RAW}, {OLDEST}, steps AS (SELECT o, unnest(range(0, 1000)) AS n FROM oldest)
        SELECT CAST(n AS INT) AS window_number, {TRUNCATED.format('o - to_days(CAST(14 * (n + 1) AS INT))')} AS window_start,
          {TRUNCATED.format('o - to_days(CAST(14 * n AS INT)) - INTERVAL 1 HOUR')} AS window_end
        FROM steps WHERE o - to_days(CAST(14 * n AS INT)) > TIMESTAMP '2019-09-01 00:00:00'""",
    "backfill_next_window": f"""WITH {RAW}, {OLDEST} SELECT {TRUNCATED.format('o - to_days(14)')} AS window_start,
        {TRUNCATED.format('o - INTERVAL 1 HOUR')} AS window_end, o <= TIMESTAMP '2019-09-01 00:00:00' AS is_done FROM oldest""",
    "coverage_gaps": f"""WITH {RAW}, present AS (SELECT DISTINCT parameter, date_trunc('hour', utc) AS h FROM raw),
        spine AS (SELECT parameter, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM present GROUP BY parameter)
        SELECT parameter, strftime(h, '%Y-%m-%d %H:%M:%S') AS gap_hour FROM spine
        WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.parameter = spine.parameter AND p.h = spine.h)""",
    "landing_counts": f"WITH {RAW} SELECT CAST(CAST(utc AS DATE) AS VARCHAR) AS date, count(*) AS records FROM raw GROUP BY 1",
    "bronze_partitions": f"""WITH {RAW} SELECT CAST(CAST(utc AS DATE) AS VARCHAR) AS date, CAST(hour(utc) AS INT) AS hour,
        CAST(CAST(utc AS DATE) AS VARCHAR) AS path_date, count(*) AS readings FROM raw GROUP BY 1, 2, 3""",
    "stream_landing": f"""WITH {RAW} SELECT CAST(CAST(utc AS DATE) AS VARCHAR) AS date, CAST(hour(utc) AS INT) AS hour,
        count(*) AS readings FROM raw GROUP BY 1, 2""",
    "running_total": f"""WITH {RAW}, {cleaned()} SELECT fullaqscode, CAST(date AS VARCHAR) AS date, hour, parameter, aqi,
        CAST(sum(aqi) OVER (PARTITION BY fullaqscode ORDER BY date, hour, parameter ROWS UNBOUNDED PRECEDING) AS BIGINT)
          AS running_total FROM cleaned""",
    "moving_average": f"""WITH {RAW}, {cleaned()} SELECT fullaqscode, parameter,
        strftime(date + to_hours(hour), '%Y-%m-%d %H:%M:%S') AS moment, aqi, round(avg(aqi) OVER (
          PARTITION BY fullaqscode, parameter ORDER BY date + to_hours(hour)
          RANGE BETWEEN INTERVAL 5 HOURS PRECEDING AND CURRENT ROW), 6) AS moving_avg FROM cleaned""",
    "moving_average_week": f"""WITH {RAW}, {cleaned()} SELECT fullaqscode, parameter,
        strftime(date + to_hours(hour), '%Y-%m-%d %H:%M:%S') AS moment, aqi, round(avg(aqi) OVER (
          PARTITION BY fullaqscode, parameter ORDER BY date + to_hours(hour)
          RANGE BETWEEN INTERVAL 167 HOURS PRECEDING AND CURRENT ROW), 6) AS moving_avg FROM cleaned""",
    "delivery_outcomes": f"""WITH {RAW}, sent AS (SELECT *, minute(utc) % 10 AS last_digit FROM raw),
      records AS (SELECT * REPLACE (CASE WHEN last_digit = 7 THEN NULL ELSE latitude END AS latitude) FROM sent WHERE last_digit <> 9)
      SELECT CASE WHEN {REJECT} THEN {REASON} ELSE 'valid' END AS outcome, count(*) AS lines FROM records GROUP BY 1
      UNION ALL SELECT 'quarantined', count(*) FROM sent WHERE last_digit = 9""",
    "rank_sites": f"""WITH {RAW}, {cleaned()}, means AS (SELECT date, fullaqscode, avg(aqi) AS m FROM cleaned GROUP BY ALL)
        SELECT CAST(date AS VARCHAR) AS date, fullaqscode, round(m, 6) AS mean_value,
          CAST(rank() OVER (PARTITION BY date ORDER BY m DESC) AS INT) AS position,
          CAST(dense_rank() OVER (PARTITION BY date ORDER BY m DESC) AS INT) AS dense_position FROM means""",
    "union_sites": f"WITH {RAW}, {valid('raw')}, {SITE_HOURS} SELECT * FROM ozone UNION SELECT * FROM co",
    "intersect_sites": f"WITH {RAW}, {valid('raw')}, {SITE_HOURS} SELECT * FROM ozone INTERSECT SELECT * FROM co",
    "except_sites": f"WITH {RAW}, {valid('raw')}, {SITE_HOURS} SELECT * FROM ozone EXCEPT SELECT * FROM co",
    "activity_join_inner": f"WITH {MEMBERS} SELECT * FROM activity JOIN spending USING (member_id)",
    "activity_join_left": f"WITH {MEMBERS} SELECT * FROM activity LEFT JOIN spending USING (member_id)",
    "activity_join_anti": f"WITH {MEMBERS} SELECT * FROM spending WHERE member_id NOT IN (SELECT member_id FROM activity)",
    "column_plan": """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus, o_totalprice, o_orderpriority AS priority,
        CAST(year(o_orderdate) AS BIGINT) AS order_year, o_totalprice > 200000 AS is_large FROM orders""",
    "flatten_props": """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS prop_k FROM events""",
    "flatten_inferred": """SELECT 'event' AS kind, event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
          CAST(NULL AS BIGINT) AS customer, CAST(NULL AS BOOLEAN) AS even, CAST(NULL AS VARCHAR) AS priority FROM events
        UNION ALL SELECT 'order', o_orderkey, NULL, CASE WHEN o_custkey % 3 = 0 THEN o_custkey END, o_custkey % 2 = 0,
          o_orderpriority FROM orders""",
    "bucketed_join": """SELECT o_orderkey, o_orderpriority, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross,
        count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderpriority""",
}
