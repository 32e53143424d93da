"""Declared schemas, and the one step that brings a source into one of them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "LONG": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """'name TYPE, ...' to a schema; unlike Spark's DDL text this needs no running session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


MASTER_WELLS = _schema(
    "well_id LONG, well_name STRING, location_lat DOUBLE, location_long DOUBLE, operator STRING, spud_date DATE"
)
MASTER_SURVEYS = _schema("survey_type_id LONG, survey_type STRING")
MASTER_SENSORS = _schema("sensor_id LONG, sensor_type STRING, calibration_date TIMESTAMP")

READING = _schema(
    """well_id LONG, survey_type_id LONG, sensor_id LONG, depth_ft DOUBLE, amplitude DOUBLE,
       timestamp TIMESTAMP, quality_flag LONG"""
)
TRACE = _schema(
    """trace_num LONG, well_id LONG, survey_type_id LONG, depth_ft DOUBLE, amplitude DOUBLE,
       quality_flag INT, source_file STRING"""
)

VAULT_READING = _schema(
    """well_id LONG, survey_type_id LONG, sensor_id LONG, timestamp TIMESTAMP_NTZ, trace_num LONG, depth_ft DOUBLE,
       amplitude DOUBLE, quality_flag LONG, record_source STRING"""
)

DIM_WELL = _schema(
    """well_id LONG, well_name STRING, latitude DOUBLE, longitude DOUBLE, basin STRING, field STRING,
       operator STRING, spud_date DATE, completion_date DATE, well_status STRING, total_depth DOUBLE,
       effective_date DATE, is_current INT"""
)
DIM_SENSOR = _schema(
    """sensor_id LONG, sensor_type STRING, manufacturer STRING, model STRING, installation_date DATE,
       calibration_date DATE, sensor_status STRING, effective_date DATE, is_current INT"""
)
DIM_DATA_SOURCE = _schema("source_key INT, source_format STRING, source_type STRING, file_extension STRING")

MART_WELL = _schema(
    """well_id LONG, well_name STRING, latitude DOUBLE, longitude DOUBLE, source_format STRING, total_readings LONG,
       avg_amplitude DOUBLE, data_quality_rate DOUBLE, anomaly_count LONG, first_reading TIMESTAMP_NTZ,
       last_reading TIMESTAMP_NTZ"""
)
MART_SENSOR = _schema(
    """sensor_id LONG, sensor_type STRING, manufacturer STRING, total_readings LONG, data_quality_rate DOUBLE,
       avg_amplitude DOUBLE, first_reading TIMESTAMP_NTZ, last_reading TIMESTAMP_NTZ"""
)
MART_SURVEY = _schema(
    """survey_type STRING, source_format STRING, wells_surveyed LONG, total_readings LONG, avg_amplitude DOUBLE,
       avg_data_quality_rate DOUBLE, earliest_survey TIMESTAMP_NTZ, latest_survey TIMESTAMP_NTZ"""
)


def conform(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Project ``df`` to ``schema``: cast what is there, add what is missing.

    A missing column becomes its default, or a typed null where none is given.
    Presence is decided while the plan is built; no row is looked at.
    """
    defaults = defaults or {}
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the table lacks, in the order asked for."""
    present = set(df.columns)
    return [name for name in required if name not in present]
