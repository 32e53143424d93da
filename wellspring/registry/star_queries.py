"""Star schema, marts, anomalies and snapshots over the given tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.scalars import fill_defaults, quality_band
from wellspring.operators import anomaly, joins, marts, numbering, quality, snapshots, star
from wellspring.registry import bindings as b
from wellspring.registry.checks import day_text, query, r6, readings_sql, rounded, star_sql
from wellspring.session import scratch_path
from wellspring.sources import sinks


@dataclass
class Star:
    """The star schema over one data folder; every part is a lazy DataFrame."""

    spark: SparkSession
    sf: str

    @cached_property
    def readings(self) -> DataFrame:
        return b.event_readings(self.spark, self.sf)

    @cached_property
    def wells(self) -> DataFrame:
        return star.dim_well(b.customer_wells(self.spark, self.sf), None, b.EFFECTIVE)

    @cached_property
    def sensors(self) -> DataFrame:
        return star.dim_sensor(b.part_sensors(self.spark, self.sf), None, b.EFFECTIVE)

    @cached_property
    def calendar(self) -> DataFrame:
        return star.dim_time(self.spark)

    @cached_property
    def sources(self) -> DataFrame:
        return star.dim_data_source(self.spark)

    @cached_property
    def facts(self) -> DataFrame:
        return star.fact_sensor_reading(self.readings, self.wells, self.calendar, self.sensors, self.sources)

    @cached_property
    def surveys(self) -> DataFrame:
        return star.fact_survey_event(self.facts, self.wells)

    @cached_property
    def well_mart(self) -> DataFrame:
        return marts.mart_well_performance(self.facts, self.wells, self.sources)

    @cached_property
    def sensor_mart(self) -> DataFrame:
        return marts.mart_sensor_analysis(self.facts, self.sensors)

    @cached_property
    def survey_mart(self) -> DataFrame:
        return marts.mart_survey_summary(self.surveys, self.sources)

    @cached_property
    def history(self) -> DataFrame:
        return b.snapshot_history(self.well_mart)


# --- dimensions ------------------------------------------------------------

@query(
    "dim_time",
    star_sql(
        """, days AS (SELECT CAST("timestamp" AS DATE) AS d, COUNT(*) AS n FROM readings GROUP BY 1)
        SELECT t.time_key, strftime(t.full_date, '%Y-%m-%d') AS full_date, t.year, t.quarter, t.month, t.day,
               t.day_of_week, t.week_of_year, t.is_weekend, COALESCE(n, 0) AS readings
        FROM dim_time t LEFT JOIN days ON d = t.full_date"""
    ),
)
def dim_time(spark, sf):
    """The whole calendar with the readings of each day."""
    s = Star(spark, sf)
    days = s.readings.groupBy(F.to_date("timestamp").alias("full_date")).agg(F.count(F.lit(1)).alias("readings"))
    rows = s.calendar.join(days, "full_date", "left").fillna({"readings": 0})
    return day_text("full_date")(rows)


@query(
    "dim_data_source",
    star_sql(
        """SELECT d.source_key, d.source_format, d.source_type, d.file_extension, COUNT(r.reading_key) AS readings
        FROM dim_data_source d LEFT JOIN readings r USING (source_format) GROUP BY ALL"""
    ),
)
def dim_data_source(spark, sf):
    """The static source rows with the readings each source delivered."""
    s = Star(spark, sf)
    per_source = s.readings.groupBy("source_format").agg(F.count(F.lit(1)).alias("readings"))
    return s.sources.join(per_source, "source_format", "left").fillna({"readings": 0})


@query(
    "dim_well",
    """WITH rows AS (
        SELECT c_custkey AS well_id, c_name AS well_name, CAST(c_nationkey AS DOUBLE) AS latitude,
               c_acctbal AS longitude, c_mktsegment AS operator FROM customer
        UNION ALL
        SELECT DISTINCT l_partkey, CAST(l_partkey AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
               CAST(NULL AS VARCHAR)
        FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer))
      SELECT row_number() OVER (ORDER BY well_id) AS well_key, well_id, well_name, latitude, longitude, operator,
             '2025-01-01' AS effective_date, 1 AS is_current FROM rows""",
)
def dim_well(spark, sf):
    """Customers as master wells; part keys of lineitem as the ids the vault knows."""
    ids = b.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("well_id"))
    rows = star.dim_well(b.customer_wells(spark, sf), ids, b.EFFECTIVE)
    kept = rows.select(
        "well_key", "well_id", "well_name", "latitude", "longitude", "operator", "effective_date", "is_current"
    )
    return day_text("effective_date")(kept)


@query(
    "dim_sensor",
    """WITH masters AS (SELECT p_partkey AS sensor_id, p_type AS sensor_type, p_brand AS manufacturer
                        FROM part WHERE p_size > 25),
      rows AS (
        SELECT * FROM masters
        UNION ALL
        SELECT DISTINCT l_partkey, 'Unknown', CAST(NULL AS VARCHAR) FROM lineitem
        WHERE l_partkey NOT IN (SELECT sensor_id FROM masters))
      SELECT row_number() OVER (ORDER BY sensor_id) AS sensor_key, sensor_id, sensor_type, manufacturer,
             '2025-01-01' AS effective_date, 1 AS is_current FROM rows""",
)
def dim_sensor(spark, sf):
    """Large parts as master sensors; the other part keys of lineitem come in as Unknown."""
    masters = b.part_sensors(spark, sf).join(
        b.table(spark, sf, "part").filter("p_size > 25").select(F.col("p_partkey").alias("sensor_id")), "sensor_id"
    )
    ids = b.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("sensor_id"))
    rows = star.dim_sensor(masters, ids, b.EFFECTIVE).select(
        "sensor_key", "sensor_id", "sensor_type", "manufacturer", "effective_date", "is_current"
    )
    return day_text("effective_date")(rows)


def _well_rows(spark, sf):
    wells = b.customer_wells(spark, sf).select("well_id", "well_name", "operator")
    rich = wells.join(
        b.table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("well_id")), "well_id"
    )
    return wells, rich


@query(
    "dim_insert_ignore",
    """SELECT c_custkey AS well_id, c_name AS well_name,
              CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'LATE' END AS operator FROM customer""",
)
def dim_insert_ignore(spark, sf):
    """Wells in credit are there already; a delivery of all wells, all marked LATE, adds only the others."""
    wells, existing = _well_rows(spark, sf)
    return joins.insert_ignore(existing, wells.withColumn("operator", F.lit("LATE")), "well_id")


@query(
    "dim_upsert",
    """SELECT c_custkey AS well_id, c_name AS well_name,
              CASE WHEN c_acctbal >= 0 THEN 'NEW' ELSE c_mktsegment END AS operator FROM customer""",
)
def dim_upsert(spark, sf):
    """All wells are there; a delivery of the wells in credit replaces those rows."""
    wells, incoming = _well_rows(spark, sf)
    return joins.upsert(wells, incoming.withColumn("operator", F.lit("NEW")), "well_id")


# --- facts -----------------------------------------------------------------

@query("fact_sensor_reading", star_sql("SELECT * FROM fact"))
def fact_sensor_reading(spark, sf):
    return Star(spark, sf).facts


@query(
    "fact_rejects",
    star_sql("SELECT r.* FROM readings r WHERE r.well_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"),
)
def fact_rejects(spark, sf):
    """Readings whose well is not among the wells in credit."""
    s = Star(spark, sf)
    wells = star.dim_well(
        b.customer_wells(spark, sf).filter(F.col("location_long") >= 0), None, b.EFFECTIVE
    )
    return star.fact_rejects(s.readings, wells).select(s.readings.columns)


@query(
    "fact_survey_event",
    star_sql(
        f"""SELECT well_key, time_key, source_key, survey_id, survey_type, survey_start_date, survey_end_date,
        total_readings, {r6('avg_amplitude')} AS avg_amplitude, {r6('data_quality_rate')} AS data_quality_rate
        FROM survey_event"""
    ),
)
def fact_survey_event(spark, sf):
    return rounded(Star(spark, sf).surveys, "avg_amplitude", "data_quality_rate")


@query(
    "block_assignment",
    star_sql(
        """, k AS (SELECT COUNT(*) AS k FROM dim_data_source),
        numbered AS (SELECT reading_key, source_key, row_number() OVER (ORDER BY reading_key) AS rn,
                            COUNT(*) OVER () AS n FROM fact)
        SELECT reading_key, CASE WHEN (rn - 1) // (n // k) < k THEN (rn - 1) // (n // k) + 1 ELSE source_key END
                 AS source_key
        FROM numbered, k"""
    ),
)
def block_assignment(spark, sf):
    """Readings in key order, spread over the five sources in equal blocks."""
    s = Star(spark, sf)
    facts = s.facts.select("reading_key", "source_key")
    return numbering.spread_blocks(facts, ["reading_key"], s.sources, "source_key").withColumn(
        "source_key", F.col("source_key").cast("int")
    )


@query(
    "assign_sensors",
    star_sql(
        """, k AS (SELECT COUNT(*) AS k FROM dim_sensor),
        numbered AS (SELECT reading_key, sensor_key, row_number() OVER (ORDER BY reading_key) AS rn,
                            COUNT(*) OVER () AS n FROM fact)
        SELECT reading_key, CASE WHEN (rn - 1) // (n // k) < k THEN (rn - 1) // (n // k) + 1 ELSE sensor_key END
                 AS sensor_key
        FROM numbered, k"""
    ),
)
def assign_sensors(spark, sf):
    s = Star(spark, sf)
    return star.assign_sensors(s.facts.select("reading_key", "sensor_key"), s.sensors)


# --- marts and reports -----------------------------------------------------

_WELL_MART = f"""SELECT well_id, well_name, latitude, longitude, source_format, total_readings,
    {r6('avg_amplitude')} AS avg_amplitude, {r6('data_quality_rate')} AS data_quality_rate, anomaly_count,
    first_reading, last_reading FROM well_mart"""


@query("mart_well_performance", star_sql(_WELL_MART))
def mart_well_performance(spark, sf):
    return rounded(Star(spark, sf).well_mart, "avg_amplitude", "data_quality_rate")


@query(
    "mart_sensor_analysis",
    star_sql(
        f"""SELECT sensor_id, sensor_type, manufacturer, total_readings,
        {r6('data_quality_rate')} AS data_quality_rate, {r6('avg_amplitude')} AS avg_amplitude, first_reading,
        last_reading FROM sensor_mart"""
    ),
)
def mart_sensor_analysis(spark, sf):
    return rounded(Star(spark, sf).sensor_mart, "avg_amplitude", "data_quality_rate")


@query(
    "mart_survey_summary",
    star_sql(
        f"""SELECT survey_type, source_format, count(DISTINCT well_key) AS wells_surveyed,
        CAST(sum(total_readings) AS BIGINT) AS total_readings, {r6('avg(avg_amplitude)')} AS avg_amplitude,
        {r6('avg(data_quality_rate)')} AS avg_data_quality_rate, min(survey_start_date) AS earliest_survey,
        max(survey_end_date) AS latest_survey
        FROM survey_event GROUP BY ALL"""
    ),
)
def mart_survey_summary(spark, sf):
    return rounded(Star(spark, sf).survey_mart, "avg_amplitude", "avg_data_quality_rate")


@query(
    "mart_well_performance_wide",
    star_sql(
        f"""SELECT well_id, well_name, latitude, longitude, basin, field, operator, source_format,
        count(*) AS total_readings, {r6('avg(amplitude)')} AS avg_amplitude,
        {r6('stddev_samp(amplitude)')} AS std_amplitude, {r6('avg(data_quality_score)')} AS data_quality_rate,
        count(*) FILTER (is_anomaly = 1) AS anomaly_count, min(depth) AS min_depth, max(depth) AS max_depth
        FROM named WHERE current_well = 1 GROUP BY ALL"""
    ),
)
def mart_well_performance_wide(spark, sf):
    s = Star(spark, sf)
    wide = marts.mart_well_performance_wide(s.facts, s.wells, s.sources)
    return rounded(wide, "avg_amplitude", "std_amplitude", "data_quality_rate")


_SENSOR_WIDE = """, wide AS (
    SELECT sensor_id, sensor_type, manufacturer, model, count(*) AS total_measurements,
    avg(amplitude) AS avg_amplitude, avg(frequency) AS avg_frequency, avg(data_quality_score) AS avg_quality,
    count(*) FILTER (is_anomaly = 1) AS anomaly_count
    FROM named WHERE current_sensor = 1 GROUP BY ALL)"""


@query(
    "mart_sensor_analysis_wide",
    star_sql(
        _SENSOR_WIDE
        + f"""SELECT sensor_id, sensor_type, manufacturer, model, total_measurements,
        {r6('avg_amplitude')} AS avg_amplitude, {r6('avg_frequency')} AS avg_frequency,
        {r6('avg_quality')} AS avg_quality, anomaly_count FROM wide"""
    ),
)
def mart_sensor_analysis_wide(spark, sf):
    s = Star(spark, sf)
    wide = marts.mart_sensor_analysis_wide(s.facts, s.sensors)
    return rounded(wide, "avg_amplitude", "avg_frequency", "avg_quality")


@query(
    "sensor_reliability",
    star_sql(
        _SENSOR_WIDE
        + f"""SELECT sensor_id, sensor_type, manufacturer, {r6('AVG(avg_quality)')} AS reliability_score,
        CAST(SUM(anomaly_count) AS BIGINT) AS anomaly_count FROM wide
        GROUP BY sensor_id, sensor_type, manufacturer ORDER BY reliability_score DESC, sensor_id"""
    ),
)
def sensor_reliability(spark, sf):
    s = Star(spark, sf)
    wide = marts.mart_sensor_analysis_wide(s.facts, s.sensors)
    return rounded(marts.sensor_reliability(wide), "reliability_score")


@query(
    "survey_listing",
    star_sql(
        f"""SELECT survey_id, survey_type, well_name, survey_start_date, survey_end_date, total_readings,
        {r6('avg_amplitude')} AS avg_amplitude, {r6('data_quality_rate')} AS data_quality_rate FROM survey_event"""
    ),
)
def survey_listing(spark, sf):
    s = Star(spark, sf)
    return rounded(marts.survey_listing(s.surveys, s.wells), "avg_amplitude", "data_quality_rate")


@query(
    "monthly_readings",
    star_sql(
        f"""SELECT year, month, count(*) AS monthly_readings, {r6('avg(amplitude)')} AS avg_amplitude
        FROM named GROUP BY ALL ORDER BY ALL"""
    ),
)
def monthly_readings(spark, sf):
    s = Star(spark, sf)
    return rounded(marts.monthly_readings(s.facts, s.calendar), "avg_amplitude")


@query(
    "kpi_stats",
    star_sql(
        f"""SELECT COUNT(DISTINCT well_id) AS total_wells, CAST(SUM(total_readings) AS BIGINT) AS total_readings,
        {r6('AVG(data_quality_rate)')} AS avg_data_quality, CAST(SUM(anomaly_count) AS BIGINT) AS total_anomalies,
        (SELECT COUNT(DISTINCT sensor_id) FROM sensor_mart) AS total_sensors,
        {r6('SUM(total_readings * avg_amplitude) / SUM(total_readings)')} AS avg_amplitude
        FROM well_mart"""
    ),
)
def kpi_stats(spark, sf):
    s = Star(spark, sf)
    return rounded(marts.kpi_stats(s.well_mart, s.sensor_mart), "avg_data_quality", "avg_amplitude")


@query(
    "wells_map",
    star_sql(
        f"""SELECT well_id, well_name, latitude AS lat, longitude AS lon, total_readings,
        {r6('avg_amplitude')} AS avg_amplitude, {r6('data_quality_rate')} AS data_quality_rate, anomaly_count
        FROM well_mart WHERE latitude <> 0 AND longitude <> 0"""
    ),
)
def wells_map(spark, sf):
    return rounded(marts.wells_map(Star(spark, sf).well_mart), "avg_amplitude", "data_quality_rate")


@query(
    "quality_by_source",
    star_sql(
        f"SELECT source_format, {r6('AVG(data_quality_rate) * 100')} AS quality_pct FROM well_mart GROUP BY source_format"
    ),
)
def quality_by_source(spark, sf):
    return rounded(marts.quality_by_source(Star(spark, sf).well_mart), "quality_pct")


@query(
    "quality_band",
    star_sql(
        """SELECT well_id, source_format, CASE WHEN data_quality_rate > 0.9 THEN 'good'
        WHEN data_quality_rate >= 0.7 THEN 'fair' ELSE 'poor' END AS band FROM well_mart"""
    ),
)
def quality_band_query(spark, sf):
    return Star(spark, sf).well_mart.select(
        "well_id", "source_format", quality_band("data_quality_rate").alias("band")
    )


@query(
    "top_wells",
    star_sql(
        f"""SELECT well_id, well_name, source_format, total_readings, {r6('avg_amplitude')} AS avg_amplitude,
        anomaly_count, {r6('ROUND(anomaly_count * 100.0::DOUBLE / total_readings, 2)')} AS anomaly_rate_pct
        FROM well_mart ORDER BY total_readings DESC, well_id, source_format LIMIT 10"""
    ),
)
def top_wells(spark, sf):
    return rounded(marts.top_wells(Star(spark, sf).well_mart), "avg_amplitude", "anomaly_rate_pct")


@query(
    "name_like",
    star_sql(f"{_WELL_MART} WHERE well_name LIKE '%Customer%42%'"),
)
def name_like(spark, sf):
    mart = Star(spark, sf).well_mart.filter(F.col("well_name").like("%Customer%42%"))
    return rounded(mart, "avg_amplitude", "data_quality_rate")


@query(
    "fill_defaults",
    """SELECT c_custkey AS well_id, COALESCE(CASE WHEN c_acctbal >= 0 THEN c_name END, 'Unknown') AS well_name,
       COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS longitude FROM customer""",
)
def fill_defaults_query(spark, sf):
    known = F.col("location_long") >= 0
    rows = b.customer_wells(spark, sf).select(
        "well_id",
        F.when(known, F.col("well_name")).alias("well_name"),
        F.when(known, F.col("location_long")).alias("longitude"),
    )
    return fill_defaults(rows, marts.MART_DEFAULTS)


@query(
    "reading_statistics",
    readings_sql(
        """SELECT COUNT(*) AS total_traces, COUNT(DISTINCT well_id) AS unique_wells,
        (SELECT string_agg(CAST(s AS VARCHAR), ',' ORDER BY s) FROM (SELECT DISTINCT survey_type_id AS s FROM readings))
          AS survey_types,
        MIN(depth_ft) AS min_depth_ft, MAX(depth_ft) AS max_depth_ft, MIN(amplitude) AS min_amplitude,
        MAX(amplitude) AS max_amplitude FROM readings"""
    ),
)
def reading_statistics(spark, sf):
    return marts.reading_statistics(b.event_readings(spark, sf)).withColumn(
        "survey_types", F.array_join(F.col("survey_types").cast("array<string>"), ",")
    )


def _summary_sql(column: str) -> str:
    q = [f"quantile_cont({column}, {p})" for p in (0.25, 0.5, 0.75)]
    return f"""SELECT '{column}' AS column_name, COUNT({column}) AS count, {r6(f'AVG({column})')} AS mean,
        {r6(f'STDDEV_SAMP({column})')} AS std, MIN({column}) AS min, {r6(q[0])} AS q1, {r6(q[1])} AS median,
        {r6(q[2])} AS q3, MAX({column}) AS max FROM readings"""


@query(
    "column_summary",
    readings_sql(f"{_summary_sql('depth_ft')} UNION ALL {_summary_sql('amplitude')}"),
)
def column_summary(spark, sf):
    rows = marts.column_summary(b.event_readings(spark, sf), ["depth_ft", "amplitude"])
    return rounded(rows, "mean", "std", "q1", "median", "q3")


@query(
    "table_counts",
    star_sql(
        """SELECT 'dim_well' AS table_name, COUNT(*) AS row_count FROM dim_well
        UNION ALL SELECT 'dim_sensor', COUNT(*) FROM dim_sensor
        UNION ALL SELECT 'fact_sensor_reading', COUNT(*) FROM fact
        UNION ALL SELECT 'fact_survey_event', COUNT(*) FROM survey_event"""
    ),
)
def table_counts(spark, sf):
    s = Star(spark, sf)
    return marts.table_counts(
        {
            "dim_well": s.wells,
            "dim_sensor": s.sensors,
            "fact_sensor_reading": s.facts,
            "fact_survey_event": s.surveys,
        }
    )


@query(
    "freshness",
    """SELECT MAX(t) AS last_load_time, date_diff('day', CAST(MAX(t) AS DATE), DATE '2025-03-01') AS days_since_load
       FROM (SELECT ts AS t FROM events UNION ALL SELECT l_shipdate FROM lineitem)""",
)
def freshness(spark, sf):
    moments = [b.event_readings(spark, sf).select("timestamp"), b.line_readings(spark, sf).select("timestamp")]
    return marts.freshness(moments, b.AS_OF)


@query(
    "page_slice",
    readings_sql("SELECT * FROM readings ORDER BY reading_key LIMIT 25 OFFSET 50"),
)
def page_slice(spark, sf):
    return numbering.slice_rows(b.event_readings(spark, sf), ["reading_key"], 50, 25)


@query(
    "page_slice_deep",
    readings_sql('''SELECT * FROM readings ORDER BY "timestamp", reading_key LIMIT 40 OFFSET 700'''),
)
def page_slice_deep(spark, sf):
    """A later page by time; only its neighbourhood is sorted."""
    return numbering.slice_rows(b.event_readings(spark, sf), ["timestamp", "reading_key"], 700, 40)


# --- daily analytics -------------------------------------------------------

_ANALYTICS = """, stats AS (SELECT AVG(amplitude) AS m, STDDEV_SAMP(amplitude) AS s FROM readings),
  flagged AS (SELECT r.*, CASE WHEN amplitude < m - 2 * s OR amplitude > m + 2 * s THEN 1 ELSE 0 END AS flag
              FROM readings r, stats),
  analytics AS (
    SELECT well_id, AVG(amplitude) AS avg_amplitude, STDDEV_SAMP(amplitude) AS std_amplitude,
    MIN(amplitude) AS min_amplitude, MAX(amplitude) AS max_amplitude, COUNT(amplitude) AS reading_count,
    CAST(SUM(flag) AS BIGINT) AS anomaly_count,
    AVG(CASE WHEN quality_flag = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS quality_score
    FROM flagged WHERE well_id IS NOT NULL GROUP BY well_id)"""


def _analytics(spark, sf):
    wells = b.customer_wells(spark, sf)
    return marts.well_analytics(b.event_readings(spark, sf), wells, b.LOADED_AT)


@query(
    "well_analytics",
    readings_sql(
        _ANALYTICS
        + f"""SELECT well_id, {r6('avg_amplitude')} AS avg_amplitude, {r6('std_amplitude')} AS std_amplitude,
        min_amplitude, max_amplitude, reading_count, anomaly_count, {r6('quality_score')} AS quality_score,
        'WELL-' || well_id AS well_name, TIMESTAMP '2025-01-01 00:00:00' AS processed_at FROM analytics"""
    ),
)
def well_analytics(spark, sf):
    return rounded(_analytics(spark, sf), "avg_amplitude", "std_amplitude", "quality_score")


@query(
    "load_check",
    readings_sql(
        _ANALYTICS + "SELECT COUNT(*) AS wells, CAST(SUM(reading_count) AS BIGINT) AS readings FROM analytics"
    ),
)
def load_check(spark, sf):
    return marts.load_check(_analytics(spark, sf))


@query(
    "run_report",
    readings_sql(
        _ANALYTICS
        + """SELECT 'run-1' AS pipeline_run, TIMESTAMP '2025-01-01 00:00:00' AS execution_time,
        (SELECT COUNT(*) FROM readings) AS extract_measurements, (SELECT COUNT(*) FROM customer) AS extract_wells,
        COUNT(*) AS transform_wells_processed, CAST(SUM(anomaly_count) AS BIGINT) AS transform_anomalies_found,
        COUNT(*) AS load_postgresql, (SELECT COUNT(*) FROM readings) AS load_mongodb,
        'exports/well_analytics_20250101' AS load_json FROM analytics"""
    ),
)
def run_report(spark, sf):
    readings = b.event_readings(spark, sf)
    wells = b.customer_wells(spark, sf)
    counted = readings.agg(F.count(F.lit(1)).alias("measurements")).withColumn(
        "wells", wells.agg(F.count(F.lit(1))).scalar()
    )
    written = readings.agg(F.count(F.lit(1))).scalar()
    exported = sinks.dated_path("exports", "well_analytics", b.LOADED_AT[:10])
    return sinks.flat(
        sinks.run_report(_analytics(spark, sf), counted, written, "run-1", b.LOADED_AT, exported)
    )


@query(
    "documents_export",
    readings_sql(
        """SELECT reading_key, well_id, sensor_id, survey_type_id,
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", depth_ft, amplitude, quality_flag, source_format
        FROM readings"""
    ),
)
def documents_export(spark, sf):
    return sinks.documents(b.event_readings(spark, sf), ["reading_key"])


# --- anomalies -------------------------------------------------------------

@query(
    "anomaly_threshold",
    readings_sql("SELECT reading_key, CASE WHEN abs(amplitude) > 50 THEN 1 ELSE 0 END AS is_anomaly FROM readings"),
)
def anomaly_threshold(spark, sf):
    rows = b.event_readings(spark, sf)
    return anomaly.threshold_flag(rows, "amplitude", star.ANOMALY_THRESHOLD).select("reading_key", "is_anomaly")


@query("anomaly_sigma", readings_sql(_ANALYTICS + "SELECT reading_key, flag AS is_anomaly FROM flagged"))
def anomaly_sigma(spark, sf):
    return anomaly.sigma_flag(b.event_readings(spark, sf), "amplitude").select("reading_key", "is_anomaly")


@query(
    "anomaly_rate",
    readings_sql(
        _ANALYTICS
        + f"""SELECT COUNT(*) AS total, CAST(SUM(flag) AS BIGINT) AS anomalies,
        {r6('SUM(flag) * 100.0::DOUBLE / COUNT(*)')} AS anomaly_pct FROM flagged"""
    ),
)
def anomaly_rate(spark, sf):
    flagged = anomaly.sigma_flag(b.event_readings(spark, sf), "amplitude")
    return rounded(anomaly.anomaly_rate(flagged), "anomaly_pct")


_Z = """, stats AS (SELECT AVG(amplitude) AS m, STDDEV_SAMP(amplitude) AS s FROM readings),
    scored AS (SELECT r.*, abs((amplitude - m) / s) AS z FROM readings r, stats)"""
_FENCE = """, quartiles AS (SELECT well_id, quantile_cont(amplitude, 0.25) AS q1, quantile_cont(amplitude, 0.75) AS q3
                  FROM readings GROUP BY well_id),
    bounds AS (SELECT well_id, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
               FROM quartiles)"""


@query("anomaly_zscore", readings_sql(_Z + f"SELECT reading_key, {r6('z')} AS z_score, CASE WHEN z > 2.5 THEN 1 ELSE 0 END AS is_anomaly FROM scored"))
def anomaly_zscore(spark, sf):
    scored = anomaly.z_score(b.event_readings(spark, sf), "amplitude")
    flagged = scored.withColumn("is_anomaly", (F.col("z_score") > anomaly.Z_LIMIT).cast("int"))
    return rounded(flagged.select("reading_key", "z_score", "is_anomaly"), "z_score")


@query(
    "anomaly_iqr",
    readings_sql(
        _FENCE
        + """SELECT reading_key, CASE WHEN amplitude < lower_bound OR amplitude > upper_bound THEN 1 ELSE 0 END
        AS is_anomaly FROM readings JOIN bounds USING (well_id)"""
    ),
)
def anomaly_iqr(spark, sf):
    rows = b.event_readings(spark, sf)
    return anomaly.iqr_outliers(rows, ["well_id"], "amplitude").select("reading_key", "is_anomaly")


@query(
    "anomaly_iqr_global",
    readings_sql(
        """, q AS (SELECT quantile_cont(amplitude, 0.25) AS q1, quantile_cont(amplitude, 0.75) AS q3 FROM readings)
        SELECT reading_key, CASE WHEN amplitude < q1 - 1.5 * (q3 - q1) OR amplitude > q3 + 1.5 * (q3 - q1)
        THEN 1 ELSE 0 END AS is_anomaly FROM readings, q"""
    ),
)
def anomaly_iqr_global(spark, sf):
    return anomaly.iqr_outliers(b.event_readings(spark, sf), None, "amplitude").select("reading_key", "is_anomaly")


@query(
    "well_fences",
    readings_sql(
        _FENCE
        + f"""SELECT well_id, {r6('q1')} AS q1, {r6('q3')} AS q3, {r6('lower_bound')} AS lower_bound,
        {r6('upper_bound')} AS upper_bound FROM bounds"""
    ),
)
def well_fences(spark, sf):
    rows = anomaly.fences(b.event_readings(spark, sf), ["well_id"], "amplitude")
    return rounded(rows, "q1", "q3", "lower_bound", "upper_bound")


@query(
    "anomaly_combined",
    star_sql(
        """, stats AS (SELECT AVG(amplitude) AS m, STDDEV_SAMP(amplitude) AS s FROM fact),
        quartiles AS (SELECT well_key, quantile_cont(amplitude, 0.25) AS q1, quantile_cont(amplitude, 0.75) AS q3
                      FROM fact GROUP BY well_key)
        SELECT reading_key, f.well_key, CASE WHEN abs((amplitude - m) / s) > 2.5
          OR amplitude < q1 - 1.5 * (q3 - q1) OR amplitude > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS is_anomaly
        FROM fact f JOIN quartiles USING (well_key), stats"""
    ),
)
def anomaly_combined(spark, sf):
    facts = Star(spark, sf).facts.select("reading_key", "well_key", "amplitude")
    return anomaly.detect_anomalies(facts).select("reading_key", "well_key", "is_anomaly")


@query(
    "flag_where_in",
    readings_sql(
        """SELECT reading_key, CASE WHEN well_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 0
        ELSE quality_flag END AS quality_flag FROM readings"""
    ),
)
def flag_where_in(spark, sf):
    """Readings of wells in debt are marked bad."""
    rows = b.event_readings(spark, sf).select("reading_key", "well_id", "quality_flag")
    in_debt = b.customer_wells(spark, sf).filter(F.col("location_long") < 0)
    return joins.flag_where_in(rows, in_debt, "well_id", {"quality_flag": 0}).drop("well_id")


_BOUND = anomaly.sample_bound(anomaly.DEGRADE_SHARE)


@query(
    "degrade_sample",
    star_sql(
        f"""SELECT reading_key,
        CASE WHEN substr(md5(reading_key || '|0'), 1, 8) < '{_BOUND}' THEN 0 ELSE quality_flag END AS quality_flag,
        CASE WHEN substr(md5(reading_key || '|0'), 1, 8) < '{_BOUND}' THEN 0.5 ELSE data_quality_score END
          AS data_quality_score FROM fact"""
    ),
)
def degrade_sample(spark, sf):
    facts = Star(spark, sf).facts.select("reading_key", "quality_flag", "data_quality_score")
    return anomaly.degrade_sample(facts, "reading_key")


@query(
    "degrade_exact",
    star_sql(
        """, placed AS (SELECT *, row_number() OVER (ORDER BY md5(reading_key || '|0'), reading_key) AS rn,
                       COUNT(*) OVER () AS n FROM fact)
        SELECT reading_key, CASE WHEN rn <= n // 10 THEN 0 ELSE quality_flag END AS quality_flag,
        CASE WHEN rn <= n // 10 THEN 0.5 ELSE data_quality_score END AS data_quality_score FROM placed"""
    ),
)
def degrade_exact(spark, sf):
    facts = Star(spark, sf).facts.select("reading_key", "quality_flag", "data_quality_score")
    return anomaly.degrade_exact(facts, "reading_key")


# --- snapshots -------------------------------------------------------------

_HISTORY_ROWS = f"""SELECT well_id, well_name, latitude, longitude, source_format, total_readings,
    {r6('avg_amplitude')} AS avg_amplitude, {r6('data_quality_rate')} AS data_quality_rate, anomaly_count,
    first_reading, last_reading, snapshot_id, snapshot_timestamp FROM history"""


@query("snapshot_history", star_sql(_HISTORY_ROWS))
def snapshot_history(spark, sf):
    """Five snapshots written as partitions and read back."""
    path = scratch_path(spark, "snapshots")
    snapshots.write_snapshots(Star(spark, sf).history, path)
    return rounded(snapshots.read_snapshots(spark, path), "avg_amplitude", "data_quality_rate")


@query(
    "list_snapshots",
    star_sql(
        """SELECT snapshot_id, MIN(snapshot_timestamp) AS snapshot_timestamp, COUNT(*) AS records_count
        FROM history GROUP BY snapshot_id"""
    ),
)
def list_snapshots(spark, sf):
    return snapshots.list_snapshots(Star(spark, sf).history)


_SUMMARY = f"""SELECT snapshot_id, MIN(snapshot_timestamp) AS snapshot_timestamp, COUNT(*) AS total_wells,
    CAST(SUM(total_readings) AS BIGINT) AS total_readings, {r6('AVG(avg_amplitude)')} AS avg_amplitude,
    {r6('AVG(data_quality_rate)')} AS avg_quality FROM history"""


@query("snapshot_summary", star_sql(f"{_SUMMARY} GROUP BY snapshot_id"))
def snapshot_summary(spark, sf):
    return rounded(snapshots.snapshot_summary(Star(spark, sf).history), "avg_amplitude", "avg_quality")


@query(
    "time_travel",
    star_sql(
        f"""{_SUMMARY} WHERE snapshot_timestamp = (SELECT MAX(snapshot_timestamp) FROM history
        WHERE snapshot_timestamp <= TIMESTAMP '2024-12-30 12:00:00') GROUP BY snapshot_id"""
    ),
)
def time_travel(spark, sf):
    version = snapshots.as_of(Star(spark, sf).history, "2024-12-30 12:00:00")
    return rounded(snapshots.snapshot_summary(version), "avg_amplitude", "avg_quality")


@query(
    "snapshot_compare",
    star_sql(
        f""", one AS (SELECT MIN(snapshot_timestamp) AS t, COUNT(*) AS w, AVG(avg_amplitude) AS a FROM history
                 WHERE snapshot_id = '3'),
        two AS (SELECT MIN(snapshot_timestamp) AS t, COUNT(*) AS w, AVG(avg_amplitude) AS a FROM history
                WHERE snapshot_id = '0')
        SELECT '3' AS id_1, one.t AS timestamp_1, one.w AS wells_1, {r6('one.a')} AS amplitude_1, '0' AS id_2,
        two.t AS timestamp_2, two.w AS wells_2, {r6('two.a')} AS amplitude_2, two.w - one.w AS wells_diff,
        {r6('two.a - one.a')} AS amplitude_diff, {r6('(two.a - one.a) / one.a * 100')} AS amplitude_change_pct
        FROM one, two"""
    ),
)
def snapshot_compare(spark, sf):
    row = snapshots.compare_snapshots(Star(spark, sf).history, "3", "0")
    return rounded(row, "amplitude_1", "amplitude_2", "amplitude_diff", "amplitude_change_pct")


@query("snapshot_rows", star_sql(f"{_HISTORY_ROWS} WHERE snapshot_id = '2' ORDER BY well_id, source_format LIMIT 20"))
def snapshot_rows(spark, sf):
    """The first rows of one version, as shown on screen."""
    version = snapshots.read_snapshot(Star(spark, sf).history, "2")
    return rounded(
        version.orderBy("well_id", "source_format").limit(20), "avg_amplitude", "data_quality_rate"
    )


@query(
    "snapshot_diff",
    star_sql(
        """, early AS (SELECT f.well_key, ds.source_format, COUNT(*) AS n FROM fact f
                       JOIN dim_data_source ds USING (source_key)
                       WHERE f."timestamp" < TIMESTAMP '2024-01-16 00:00:00' GROUP BY ALL),
        late AS (SELECT f.well_key, ds.source_format, COUNT(*) AS n FROM fact f
                 JOIN dim_data_source ds USING (source_key) GROUP BY ALL)
        SELECT w.well_id, l.source_format, CASE WHEN e.n IS NULL THEN 'added' ELSE 'changed' END AS change,
        e.n AS total_readings_before, l.n AS total_readings_after
        FROM late l JOIN dim_well w USING (well_key) LEFT JOIN early e USING (well_key, source_format)
        WHERE e.n IS DISTINCT FROM l.n"""
    ),
)
def snapshot_diff(spark, sf):
    """The well mart in the middle of the month against the mart at its end."""
    s = Star(spark, sf)
    early_facts = s.facts.filter(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz"))
    early = snapshots.stamp_snapshot(
        marts.mart_well_performance(early_facts, s.wells, s.sources), "mid", "2024-01-16 00:00:00"
    )
    late = snapshots.stamp_snapshot(s.well_mart, "end", "2024-02-01 00:00:00")
    return snapshots.snapshot_diff(
        early.unionByName(late), "mid", "end", ["well_id", "source_format"], ["total_readings"]
    )


# --- quality of the star ---------------------------------------------------

@query(
    "dq_star",
    star_sql(
        """SELECT 'fact_sensor_reading' AS table_name, count(*) AS total_rows,
        count(*) FILTER (depth IS NULL) AS null_depth, count(*) FILTER (amplitude IS NULL) AS null_amplitude,
        count(*) FILTER (longitude < 0) AS orphaned_facts,
        (SELECT count(*) - count(DISTINCT well_id) FROM dim_well) AS duplicate_wells
        FROM named"""
    ),
)
def dq_star(spark, sf):
    """Completeness, facts without a well in credit, duplicate current wells."""
    s = Star(spark, sf)
    counts = joins.reference_counts(s.facts, s.wells.filter(F.col("longitude") >= 0), "well_key")
    current = s.wells.filter(F.col("is_current") == 1)
    return s.facts.agg(
        F.lit("fact_sensor_reading").alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("depth").isNull()).alias("null_depth"),
        F.count_if(F.col("amplitude").isNull()).alias("null_amplitude"),
    ).withColumns(
        {
            "orphaned_facts": counts.select("orphaned_references").scalar(),
            "duplicate_wells": quality.duplicate_groups(current, "well_id").agg(F.count(F.lit(1))).scalar(),
        }
    )


# --- snapshots in a store --------------------------------------------------

def _store(spark, sf) -> snapshots.SnapshotStore:
    """The five versions, each committed by itself, the third of them twice."""
    store = snapshots.SnapshotStore(spark, scratch_path(spark, "snapshot-store"))
    history = sinks.stage(Star(spark, sf).history, scratch_path(spark, "history"))
    for i in (0, 1, 2, 3, 4, 2):
        rows = history.filter(F.col("snapshot_id") == str(i)).drop("snapshot_id", "snapshot_timestamp")
        store.write(rows, str(i), f"{date(2025, 1, 1) - timedelta(days=i)} 00:00:00")
    return store


@query(
    "snapshot_store",
    star_sql(
        """SELECT snapshot_id, MIN(snapshot_timestamp) AS snapshot_timestamp, COUNT(*) AS records_count
        FROM history GROUP BY snapshot_id"""
    ),
)
def snapshot_store(spark, sf):
    """What the manifest of written snapshots lists."""
    return _store(spark, sf).list().drop("files")


@query(
    "snapshot_store_as_of",
    star_sql(
        f"""{_HISTORY_ROWS} WHERE snapshot_timestamp = (SELECT MAX(snapshot_timestamp) FROM history
        WHERE snapshot_timestamp <= TIMESTAMP '2024-12-30 12:00:00')"""
    ),
)
def snapshot_store_as_of(spark, sf):
    """All rows of the written snapshot that was current at a moment."""
    return rounded(_store(spark, sf).as_of("2024-12-30 12:00:00"), "avg_amplitude", "data_quality_rate")
