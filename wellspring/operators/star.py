"""Star schema builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.scalars import entity_label, good_share, nan_to_null, quality_score
from wellspring.operators.history import dedup_first
from wellspring.operators.joins import insert_ignore, lookup_key, rejects, upsert
from wellspring.operators.numbering import surrogate_key
from wellspring.sources.files import static_rows
from wellspring.schemas import DIM_DATA_SOURCE, DIM_SENSOR, DIM_WELL, conform

# The calendar's span, the static source rows and the fact defaults.
CALENDAR_START, CALENDAR_END = "1990-01-01", "2030-12-31"
DATA_SOURCES = [
    (1, "CSV", "Flat File", ".csv"),
    (2, "JSON", "Structured", ".json"),
    (3, "Parquet", "Columnar", ".parquet"),
    (4, "SEGY", "Seismic", ".segy"),
    (5, "SGX", "Legacy Seismic", ".sgx"),
]
DEFAULT_DATE = "2024-01-01"
DEFAULT_TIME_KEY = 1
DEFAULT_SENSOR_KEY = 1
DEFAULT_SOURCE_KEY = 3
ANOMALY_THRESHOLD = 50.0
SURVEY_LABEL = "Seismic Survey"
UNKNOWN = "Unknown"


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def dim_time(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """The calendar. Its key is the day number from ``start``, so numbering needs no sort."""
    day = F.col("full_date")
    return date_range(spark, start, end).select(
        (F.datediff(day, F.lit(start).cast("date")) + 1).alias("time_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
    )


def dim_data_source(spark: SparkSession) -> DataFrame:
    return static_rows(spark, DATA_SOURCES, DIM_DATA_SOURCE)


def dim_well(masters: DataFrame, vault_ids: DataFrame | None, effective: str) -> DataFrame:
    """Well dimension: master rows, then ids only the vault knows, named by their id."""
    renamed = masters.withColumnsRenamed({"location_lat": "latitude", "location_long": "longitude", "status": "well_status"})
    blank = {"well_name": "", "latitude": 0.0, "longitude": 0.0, "basin": "", "field": "", "operator": "",
             "well_status": "", "total_depth": 0.0, "effective_date": effective, "is_current": 1}
    rows = _no_duplicates(conform(renamed.drop("effective_date", "is_current"), DIM_WELL, blank), "well_id")
    if vault_ids is not None:
        only_id = vault_ids.select("well_id", F.col("well_id").cast("string").alias("well_name"))
        rows = insert_ignore(
            rows, conform(only_id, DIM_WELL, {"effective_date": effective, "is_current": 1}), "well_id"
        )
    return surrogate_key(rows, "well_id", "well_key")


def dim_sensor(masters: DataFrame, vault_ids: DataFrame | None, effective: str) -> DataFrame:
    """Sensor dimension, built like the well dimension; a sensor only the vault knows is of type Unknown."""
    renamed = masters.withColumnsRenamed({"status": "sensor_status"})
    blank = {"sensor_type": "", "manufacturer": "", "model": "", "sensor_status": "",
             "effective_date": effective, "is_current": 1}
    rows = _no_duplicates(conform(renamed.drop("effective_date", "is_current"), DIM_SENSOR, blank), "sensor_id")
    if vault_ids is not None:
        only_id = conform(
            vault_ids.select("sensor_id"),
            DIM_SENSOR,
            {"sensor_type": UNKNOWN, "effective_date": effective, "is_current": 1},
        )
        rows = insert_ignore(rows, only_id, "sensor_id")
    return surrogate_key(rows, "sensor_id", "sensor_key")


def _no_duplicates(rows: DataFrame, key: str) -> DataFrame:
    return dedup_first(rows.filter(F.col(key).isNotNull()), key, [c for c in rows.columns if c != key])


def refresh_dimension(
    existing: DataFrame, incoming: DataFrame, key: str, surrogate: str
) -> DataFrame:
    """Type 1 reload: changed rows are replaced, known keys keep their surrogate, new ones go on top."""
    attributes = [c for c in existing.columns if c != surrogate]
    merged = upsert(existing.select(*attributes), incoming.select(*attributes), key)
    known = merged.join(existing.select(key, surrogate), key)
    top = existing.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    fresh = surrogate_key(merged.join(existing.select(key), key, "left_anti"), key, surrogate, top)
    return known.select(*existing.columns).unionByName(fresh.select(*existing.columns))


def fact_sensor_reading(
    readings: DataFrame,
    wells: DataFrame,
    calendar: DataFrame,
    sensors: DataFrame | None = None,
    sources: DataFrame | None = None,
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """Reading facts with dimension keys.

    A reading needs its well; without a match it is left out (``fact_rejects``
    lists those). Sensor, day and source fall back to their default keys. The
    calendar and the static source rows are bounded by their definition, so
    they are broadcast; wells and sensors grow with the data, and Spark decides.
    """
    rows = readings
    columns = set(readings.columns)
    if sensors is not None and "sensor_id" in columns:
        rows = lookup_key(rows, sensors, "sensor_id", "sensor_key", DEFAULT_SENSOR_KEY)
    else:
        rows = rows.withColumn("sensor_key", F.lit(DEFAULT_SENSOR_KEY).cast("long"))
    if sources is not None and "source_format" in columns:
        rows = lookup_key(rows, F.broadcast(sources), "source_format", "source_key", DEFAULT_SOURCE_KEY)
    else:
        rows = rows.withColumn("source_key", F.lit(DEFAULT_SOURCE_KEY))
    moment = F.col("timestamp") if "timestamp" in columns else F.lit(None)
    moment = F.coalesce(moment.cast("timestamp_ntz"), F.lit(DEFAULT_DATE).cast("timestamp_ntz"))
    rows = rows.withColumn("timestamp", moment).withColumn("full_date", F.to_date("timestamp"))
    rows = lookup_key(rows, F.broadcast(calendar), "full_date", "time_key", DEFAULT_TIME_KEY)
    rows = lookup_key(rows, wells, "well_id", "well_key")

    def optional(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in columns else F.lit(0.0)

    flag = F.coalesce(F.col("quality_flag").cast("int"), F.lit(1)) if "quality_flag" in columns else F.lit(1)
    return rows.withColumn("quality_flag", flag).select(
        "reading_key",
        "well_key",
        "sensor_key",
        "time_key",
        "source_key",
        "timestamp",
        F.col("depth_ft").alias("depth"),
        "amplitude",
        optional("frequency").alias("frequency"),
        optional("phase").alias("phase"),
        "quality_flag",
        F.coalesce(F.abs(F.nanvl("amplitude", F.lit(None).cast("double"))) > threshold, F.lit(False)).cast("int").alias("is_anomaly"),
        quality_score().alias("data_quality_score"),
    )


def fact_rejects(readings: DataFrame, wells: DataFrame) -> DataFrame:
    """Readings without a well in the dimension."""
    return rejects(readings, wells, "well_id")


def fact_survey_event(facts: DataFrame, wells: DataFrame) -> DataFrame:
    """One survey per well and source. Facts are aggregated on their keys before the well is joined."""
    per_key = nan_to_null(facts).groupBy("well_key", "source_key").agg(
        F.min("time_key").alias("time_key"),
        F.min("timestamp").alias("survey_start_date"),
        F.max("timestamp").alias("survey_end_date"),
        F.count(F.lit(1)).alias("total_readings"),
        F.avg("amplitude").alias("avg_amplitude"),
        good_share().alias("data_quality_rate"),
    )
    return per_key.join(wells.select("well_key", "well_id"), "well_key").select(
        "well_key",
        "time_key",
        "source_key",
        entity_label("SURVEY", "well_id").alias("survey_id"),
        F.lit(SURVEY_LABEL).alias("survey_type"),
        "survey_start_date",
        "survey_end_date",
        "total_readings",
        "avg_amplitude",
        "data_quality_rate",
    )


def assign_sensors(facts: DataFrame, sensors: DataFrame, order: Sequence[str] = ("reading_key",)) -> DataFrame:
    """Spread readings over all sensors in equal blocks of reading order."""
    from wellspring.operators.numbering import spread_blocks

    return spread_blocks(facts, list(order), sensors, "sensor_key")
