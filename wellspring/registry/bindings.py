"""How the given tables play the roles of wells, sensors, readings and documents.

``events`` are the readings of the star schema (every source format and real
outliers occur there); ``lineitem`` rows are the readings of the vault, part of
them without a sensor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.sources.files import list_sources

LOADED_AT = "2025-01-01 00:00:00"
EFFECTIVE = "2025-01-01"
SECOND_DELIVERY = "2025-02-01"
AS_OF = "2025-03-01"

# Which event type stands for which source format.
SOURCE_OF_EVENT = {"view": "CSV", "click": "JSON", "purchase": "Parquet", "error": "SEGY", "signup": "SGX"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def parts_of(spark: SparkSession, sf: str, name: str, least: int, part_bytes: int = 8 << 20) -> int:
    """How many parts of about ``part_bytes`` a table has by its files' size, ``least`` at least."""
    size = list_sources(spark, f"{sf.rstrip('/')}/{name}.parquet").agg(F.sum("length")).first()[0] or 0
    return max(least, -(-size // part_bytes))


def event_readings(spark: SparkSession, sf: str) -> DataFrame:
    source = F.lit(None).cast("string")
    for event, fmt in SOURCE_OF_EVENT.items():
        source = F.when(F.col("event_type") == event, fmt).otherwise(source)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("reading_key"),
        F.col("user_id").alias("well_id"),
        (F.col("event_id") % 50).alias("sensor_id"),
        (F.lit(101) + F.col("event_id") % 3).alias("survey_type_id"),
        F.col("ts").alias("timestamp"),
        F.get_json_object("props", "$.k").cast("double").alias("depth_ft"),
        F.col("value").alias("amplitude"),
        F.when(F.col("event_id") % 10 == 0, 0).otherwise(1).alias("quality_flag"),
        source.alias("source_format"),
    )


def customer_wells(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("well_id"),
        F.col("c_name").alias("well_name"),
        F.col("c_nationkey").cast("double").alias("location_lat"),
        F.col("c_acctbal").alias("location_long"),
        F.col("c_mktsegment").alias("operator"),
    )


def part_sensors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("sensor_id"), F.col("p_type").alias("sensor_type"), F.col("p_brand").alias("manufacturer")
    )


def supplier_wells(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("operator"))
    return (
        table(spark, sf, "supplier")
        .join(nations, "s_nationkey")
        .select(
            F.col("s_suppkey").alias("well_id"),
            F.col("s_name").alias("well_name"),
            F.col("s_nationkey").cast("double").alias("location_lat"),
            F.col("s_acctbal").alias("location_long"),
            "operator",
        )
    )


def line_surveys(spark: SparkSession, sf: str) -> DataFrame:
    """Survey types as the readings mention them; one row per reading, for the hub to dedup."""
    survey = F.col("l_linenumber").cast("long")
    return table(spark, sf, "lineitem").select(
        survey.alias("survey_type_id"), F.concat(F.lit("SURVEY-"), survey.cast("string")).alias("survey_type")
    )


def survey_master(spark: SparkSession, sf: str) -> DataFrame:
    return line_surveys(spark, sf).distinct()


def line_readings(spark: SparkSession, sf: str) -> DataFrame:
    open_line = F.col("l_linestatus") == "O"
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("well_id"),
        F.col("l_linenumber").cast("long").alias("survey_type_id"),
        F.when(~open_line, F.col("l_partkey")).alias("sensor_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("depth_ft"),
        F.col("l_extendedprice").alias("amplitude"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("quality_flag"),
        F.when(open_line, "legacy_traces").otherwise("archive_readings").alias("record_source"),
    )


def archive_and_legacy(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The two sources as they arrive: legacy traces have no sensor column at all."""
    rows = line_readings(spark, sf)
    archive = rows.filter(F.col("record_source") == "archive_readings")
    legacy = rows.filter(F.col("record_source") == "legacy_traces").drop("sensor_id")
    return [archive, legacy]


def well_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries of the well master: the second moves some wells to another operator, the third repeats it."""
    wells = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("well_id"), F.col("c_name").alias("well_name"), F.col("c_mktsegment").alias("operator")
    )
    moved = wells.withColumn(
        "operator", F.when(F.col("well_id") % 7 == 0, F.lit("MOVED")).otherwise(F.col("operator"))
    )
    days = [(wells, "2025-01-01"), (moved, "2025-02-01"), (moved, "2025-03-01")]
    parts = [df.withColumn("load_timestamp", F.lit(d).cast("timestamp_ntz")) for df, d in days]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def snapshot_history(mart: DataFrame, now: str = LOADED_AT, versions: int = 5, step: float = 0.05) -> DataFrame:
    """A mart as ``versions`` snapshots a day apart, amplitude scaled by 1 + step * i (a fixture, not a product)."""
    i = F.col("_i")
    stamped = mart.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(versions - 1)))).withColumns(
        {
            "snapshot_id": i.cast("string"),
            "snapshot_timestamp": F.lit(now).cast("timestamp_ntz") - F.make_interval(days=i),
            "avg_amplitude": F.col("avg_amplitude") * (1 + i * step),
        }
    )
    return stamped.drop("_i")
