"""The two whole jobs: warehouse build and daily run."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators import anomaly, marts, star
from wellspring.sources import sinks


@dataclass(frozen=True)
class WarehouseInputs:
    wells: DataFrame
    sensors: DataFrame
    readings: DataFrame
    vault_wells: DataFrame | None = None
    vault_sensors: DataFrame | None = None


def together(calls: Mapping[str, Callable[[], Any]], at_once: int = 8) -> dict[str, Any]:
    """Run independent Spark actions at the same time; the first failure is raised after all have ended."""
    with_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {name: pool.submit(with_session(call)) for name, call in calls.items()}
    return {name: done.result() for name, done in running.items()}


def write_vault(tables: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Write every vault table below ``path``; the tables do not depend on each other."""
    places = {name: f"{path.rstrip('/')}/{name}" for name in tables}
    together({name: lambda n=name: sinks.write_table(tables[n], places[n]) for name in tables})
    return places


def run_warehouse(
    spark: SparkSession,
    inputs: WarehouseInputs,
    path: str,
    effective: str,
    spread_sensors: bool = False,
    degrade_share: float = 0.0,
) -> dict[str, DataFrame]:
    """Dimensions, facts, sensors, anomalies, surveys, marts, in that order, each written once.

    Every stage reads the written tables of the one before, so a lost executor
    costs a re-read and never a rebuild of the chain. Tables of one stage are
    written at the same time.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        place = f"{path.rstrip('/')}/{name}"
        sinks.write_table(df, place)
        return spark.read.parquet(place)

    def stage(tables: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        return together({name: lambda n=name: store(n, tables[n]()) for name in tables})

    built = stage(
        {
            "dim_time": lambda: star.dim_time(spark),
            "dim_data_source": lambda: star.dim_data_source(spark),
            "dim_well": lambda: star.dim_well(inputs.wells, inputs.vault_wells, effective),
            "dim_sensor": lambda: star.dim_sensor(inputs.sensors, inputs.vault_sensors, effective),
        }
    )
    calendar, sources, wells, sensors = (
        built[n] for n in ("dim_time", "dim_data_source", "dim_well", "dim_sensor")
    )
    facts = star.fact_sensor_reading(inputs.readings, wells, calendar, sensors, sources)
    facts = store("fact_loaded", facts)
    if spread_sensors:
        facts = star.assign_sensors(facts, sensors)
    facts = anomaly.detect_anomalies(facts)
    if degrade_share:
        facts = anomaly.degrade_sample(facts, "reading_key", degrade_share)
    facts = built["fact_sensor_reading"] = store("fact_sensor_reading", facts)

    def survey_tables() -> dict[str, DataFrame]:
        surveys = store("fact_survey_event", star.fact_survey_event(facts, wells))
        summary = store("mart_survey_summary", marts.mart_survey_summary(surveys, sources))
        return {"fact_survey_event": surveys, "mart_survey_summary": summary}

    reports = together(
        {
            "surveys": survey_tables,
            "mart_well_performance": lambda: store(
                "mart_well_performance", marts.mart_well_performance(facts, wells, sources)
            ),
            "mart_sensor_analysis": lambda: store(
                "mart_sensor_analysis", marts.mart_sensor_analysis(facts, sensors)
            ),
        }
    )
    return {**built, **reports.pop("surveys"), **reports}


def run_daily(
    measurements: DataFrame,
    wells: DataFrame,
    path: str,
    run_id: str,
    executed_at: str,
    order: list[str],
    jdbc: Mapping[str, str] | None = None,
) -> DataFrame:
    """Analytics per well, then the three loads at the same time, and the report; returns the report row.

    The analytics are written once and read back, so the loads do not compute
    them again. ``jdbc`` (url, table and connection properties) is optional.
    """
    spark = measurements.sparkSession
    root = path.rstrip("/")
    sinks.write_table(marts.well_analytics(measurements, wells, executed_at), f"{root}/well_analytics")
    analytics = spark.read.parquet(f"{root}/well_analytics")
    flagged = anomaly.sigma_flag(measurements, "amplitude")
    loads = {
        "documents": lambda: sinks.to_documents(flagged, f"{root}/documents", order),
        "json": lambda: sinks.to_json(analytics, f"{root}/exports", "well_analytics", executed_at[:10]),
    }
    if jdbc:
        target = dict(jdbc)
        loads["jdbc"] = lambda: sinks.to_jdbc(analytics, target.pop("url"), target.pop("table"), target)
    exported = together(loads)["json"]
    extracted = measurements.agg(F.count(F.lit(1)).alias("measurements")).withColumn(
        "wells", wells.agg(F.count(F.lit(1))).scalar()
    )
    written = spark.read.schema("well_id LONG").json(f"{root}/documents").agg(F.count(F.lit(1))).scalar()
    report = sinks.run_report(analytics, extracted, written, run_id, executed_at, exported)
    sinks.to_json(report, f"{root}/reports", "etl_report", executed_at[:10], one_file=True)
    return report
