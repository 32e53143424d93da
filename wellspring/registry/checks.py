"""Registration of queries with their SQL twins, and the shared SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Averages of two-decimal values often end exactly on a rounding tie; the small
# shift, far above summation noise and far below the last digit kept, puts both
# engines on the same side of it.
_SHIFT = 1e-8


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + _SHIFT, 6) for c in columns})


def r6(sql: str) -> str:
    return f"ROUND({sql} + {_SHIFT}, 6)"


def day_text(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def count_rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


EVENT_READINGS = """
readings AS (
  SELECT event_id AS reading_key, user_id AS well_id, event_id % 50 AS sensor_id,
         101 + event_id % 3 AS survey_type_id, ts AS "timestamp",
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS depth_ft, value AS amplitude,
         CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS quality_flag,
         CASE event_type WHEN 'view' THEN 'CSV' WHEN 'click' THEN 'JSON' WHEN 'purchase' THEN 'Parquet'
                         WHEN 'error' THEN 'SEGY' WHEN 'signup' THEN 'SGX' END AS source_format
  FROM events)"""

DIMENSIONS = """
dim_well AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS well_key, c_custkey AS well_id, c_name AS well_name,
         CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal AS longitude, '' AS basin, '' AS field,
         c_mktsegment AS operator, '2025-01-01' AS effective_date, 1 AS is_current
  FROM customer),
dim_sensor AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS sensor_key, p_partkey AS sensor_id, p_type AS sensor_type,
         p_brand AS manufacturer, '' AS model, '2025-01-01' AS effective_date, 1 AS is_current
  FROM part),
dim_time AS (
  SELECT date_diff('day', DATE '1990-01-01', d) + 1 AS time_key, d AS full_date, year(d) AS year,
         quarter(d) AS quarter, month(d) AS month, day(d) AS day, isodow(d) - 1 AS day_of_week,
         week(d) AS week_of_year, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d)),
dim_data_source AS (
  SELECT * FROM (VALUES (1, 'CSV', 'Flat File', '.csv'), (2, 'JSON', 'Structured', '.json'),
                        (3, 'Parquet', 'Columnar', '.parquet'), (4, 'SEGY', 'Seismic', '.segy'),
                        (5, 'SGX', 'Legacy Seismic', '.sgx'))
           AS v(source_key, source_format, source_type, file_extension))"""

FACT = """
fact AS (
  SELECT r.reading_key, w.well_key, COALESCE(s.sensor_key, 1) AS sensor_key, COALESCE(t.time_key, 1) AS time_key,
         COALESCE(d.source_key, 3) AS source_key, r."timestamp", r.depth_ft AS depth, r.amplitude,
         CAST(0 AS DOUBLE) AS frequency, CAST(0 AS DOUBLE) AS phase, r.quality_flag,
         CASE WHEN abs(r.amplitude) > 50 THEN 1 ELSE 0 END AS is_anomaly,
         CASE WHEN r.quality_flag = 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS data_quality_score
  FROM readings r JOIN dim_well w USING (well_id)
  LEFT JOIN dim_sensor s ON s.sensor_id = r.sensor_id
  LEFT JOIN dim_time t ON t.full_date = CAST(r."timestamp" AS DATE)
  LEFT JOIN dim_data_source d ON d.source_format = r.source_format)"""

# Every reading with all its dimension columns; marts and reports group this one set.
NAMED = """
named AS (
  SELECT fact.*, well_id, well_name, latitude, longitude, basin, field, operator, dim_well.is_current AS current_well,
         sensor_id, sensor_type, manufacturer, model, dim_sensor.is_current AS current_sensor, year, month,
         source_format
  FROM fact JOIN dim_well USING (well_key) JOIN dim_sensor USING (sensor_key) JOIN dim_time USING (time_key)
  JOIN dim_data_source USING (source_key)),
survey_event AS (
  SELECT well_key, well_id, well_name, source_key, source_format, 'SURVEY-' || well_id AS survey_id,
         'Seismic Survey' AS survey_type, min(time_key) AS time_key, min("timestamp") AS survey_start_date,
         max("timestamp") AS survey_end_date, count(*) AS total_readings, avg(amplitude) AS avg_amplitude,
         count(*) FILTER (quality_flag = 1) / count(*)::DOUBLE AS data_quality_rate
  FROM named GROUP BY ALL)"""

MARTS = """
well_mart AS (
  SELECT well_id, well_name, latitude, longitude, source_format, count(*) AS total_readings,
         avg(amplitude) AS avg_amplitude, count(*) FILTER (quality_flag = 1) / count(*)::DOUBLE AS data_quality_rate,
         count(*) FILTER (is_anomaly = 1) AS anomaly_count, min("timestamp") AS first_reading,
         max("timestamp") AS last_reading
  FROM named WHERE current_well = 1 GROUP BY ALL),
sensor_mart AS (
  SELECT sensor_id, sensor_type, manufacturer, count(*) AS total_readings, avg(amplitude) AS avg_amplitude,
         count(*) FILTER (quality_flag = 1) / count(*)::DOUBLE AS data_quality_rate,
         min("timestamp") AS first_reading, max("timestamp") AS last_reading
  FROM named WHERE current_sensor = 1 GROUP BY ALL)"""

HISTORY = """
history AS (
  SELECT well_id, well_name, latitude, longitude, source_format, total_readings,
         avg_amplitude * (1 + i * 0.05::DOUBLE) AS avg_amplitude, data_quality_rate, anomaly_count, first_reading,
         last_reading, CAST(i AS VARCHAR) AS snapshot_id,
         TIMESTAMP '2025-01-01 00:00:00' - to_days(CAST(i AS INTEGER)) AS snapshot_timestamp
  FROM well_mart, generate_series(0, 4) AS g(i))"""


def readings_sql(body: str) -> str:
    return f"WITH {EVENT_READINGS}\n{body}"


def star_sql(body: str) -> str:
    return f"WITH {EVENT_READINGS},{DIMENSIONS},{FACT},{NAMED},{MARTS},{HISTORY}\n{body}"


# --- vault -----------------------------------------------------------------

LOADED = "TIMESTAMP '2025-01-01 00:00:00'"


def number_text(expr: str) -> str:
    return f"rtrim(rtrim(CAST({expr} AS VARCHAR), '0'), '.')"


def key_sql(entity: str, expr: str) -> str:
    return f"md5(concat_ws('|', '{entity}', CAST({expr} AS VARCHAR)))"


READING_KEY = (
    "md5(concat_ws('|', 'READING', CAST(well_id AS VARCHAR), CAST(survey_type_id AS VARCHAR), "
    "COALESCE(CAST(sensor_id AS VARCHAR), 'NO_SENSOR'), strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f')))"
)
MEASURE_HASH = f"md5(concat_ws('|', {number_text('depth_ft')}, {number_text('amplitude')}, CAST(quality_flag AS VARCHAR)))"

VAULT = f"""
readings AS (
  SELECT l_suppkey AS well_id, CAST(l_linenumber AS BIGINT) AS survey_type_id,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_partkey END AS sensor_id, l_shipdate AS "timestamp",
         l_quantity AS depth_ft, l_extendedprice AS amplitude,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS quality_flag,
         CASE WHEN l_linestatus = 'O' THEN 'legacy_traces' ELSE 'archive_readings' END AS record_source
  FROM lineitem),
wells AS (
  SELECT s_suppkey AS well_id, s_name AS well_name, CAST(s_nationkey AS DOUBLE) AS location_lat,
         s_acctbal AS location_long, n_name AS operator
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
surveys AS (
  SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS survey_type_id, 'SURVEY-' || l_linenumber AS survey_type
  FROM lineitem),
sensors AS (SELECT p_partkey AS sensor_id, p_type AS sensor_type, p_brand AS manufacturer FROM part),
hub_well AS (
  SELECT {key_sql('WELL', 'well_id')} AS well_hash_key, well_id, {LOADED} AS load_timestamp,
         'master_wells' AS record_source FROM wells),
hub_survey AS (
  SELECT {key_sql('SURVEY', 'survey_type_id')} AS survey_hash_key, survey_type_id, {LOADED} AS load_timestamp,
         'master_surveys' AS record_source FROM surveys),
hub_sensor AS (
  SELECT {key_sql('SENSOR', 'sensor_id')} AS sensor_hash_key, sensor_id, {LOADED} AS load_timestamp,
         'master_sensors' AS record_source FROM sensors),
sat AS (
  SELECT *, {READING_KEY} AS link_hash_key, {LOADED} AS load_timestamp, {MEASURE_HASH} AS hash_diff FROM readings),
link AS (
  SELECT {key_sql('WELL', 'any_value(well_id)')} AS well_hash_key,
         {key_sql('SURVEY', 'any_value(survey_type_id)')} AS survey_hash_key,
         CASE WHEN any_value(sensor_id) IS NOT NULL THEN {key_sql('SENSOR', 'any_value(sensor_id)')} END
           AS sensor_hash_key,
         link_hash_key, {LOADED} AS load_timestamp, MIN(record_source) AS record_source
  FROM sat GROUP BY link_hash_key),
good_hub_well AS (
  SELECT h.* FROM hub_well h JOIN wells w USING (well_id) WHERE w.location_long >= 0)"""

VERSIONS = """
customer_wells AS (SELECT c_custkey AS well_id, c_name AS well_name, c_mktsegment AS operator FROM customer),
moved AS (SELECT well_id, well_name, CASE WHEN well_id % 7 = 0 THEN 'MOVED' ELSE operator END AS operator
          FROM customer_wells),
deliveries AS (
  SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS load_timestamp FROM customer_wells
  UNION ALL SELECT *, TIMESTAMP '2025-02-01 00:00:00' FROM moved
  UNION ALL SELECT *, TIMESTAMP '2025-03-01 00:00:00' FROM moved),
versions AS (
  SELECT *, md5(concat_ws('|', well_name, operator)) AS hash_diff FROM deliveries)"""


def vault_sql(body: str) -> str:
    return f"WITH {VAULT}\n{body}"


def versions_sql(body: str) -> str:
    return f"WITH {VERSIONS}\n{body}"
