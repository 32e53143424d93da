"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs of a step (trace files, damaged files, written vault and facts) are made
before its clock starts, as the published numbers are for the step alone. Every
step is run twice and the second time counts, so that the JVM's start-up does
not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wellspring.operators import marts, quality  # noqa: E402
from wellspring.plans.jobs import WarehouseInputs, run_daily, run_warehouse, write_vault  # noqa: E402
from wellspring.registry import QUERIES  # noqa: E402
from wellspring.registry import bindings as b  # noqa: E402
from wellspring.registry import damage  # noqa: E402
from wellspring.registry import file_queries as files  # noqa: E402
from wellspring.registry.vault_queries import Vault  # noqa: E402
from wellspring.session import build_session, scratch_path  # noqa: E402
from wellspring.sources import repair, traces  # noqa: E402


def line_inputs(spark, sf: str) -> WarehouseInputs:
    """lineitem as readings with a key, so that the star is built at the larger size."""
    rows = b.line_readings(spark, sf).withColumns(
        {
            "reading_key": F.monotonically_increasing_id(),
            "source_format": F.when(F.col("record_source") == "legacy_traces", "SGX").otherwise("Parquet"),
        }
    )
    return WarehouseInputs(b.supplier_wells(spark, sf), b.part_sensors(spark, sf), rows)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    work: dict[str, float] = {}

    def timed(name: str, run, size: float) -> None:
        for _ in range(2):
            start = time.perf_counter()
            run()
            seconds[name] = round(time.perf_counter() - start, 3)
        work[name] = size

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    lines = b.table(spark, sf, "lineitem").count()
    events = b.table(spark, sf, "events").count()

    trace_dir = files._trace_files(spark, sf)
    timed("sgx_ingest", lambda: consume(traces.read_sgx(spark, trace_dir)), lines)

    whole, damaged = scratch_path(spark, "whole"), scratch_path(spark, "damaged")
    b.line_readings(spark, sf).repartition(8).write.parquet(whole)
    consume(damage.damage_parquet(spark, whole, damaged, every=True))
    megabytes = repair.classify_files(spark, damaged).agg(F.sum("original_size")).first()[0] / 1e6
    timed("parquet_repair", lambda: repair.repair_parquet(spark, damaged, scratch_path(spark, "fixed")), megabytes)

    raw = scratch_path(spark, "raw")
    b.table(spark, sf, "documents").select("text").repartition(100).write.text(raw)
    timed(
        "pattern_scan_files",
        lambda: consume(repair.scan_files_for_patterns(spark, raw, "*.txt", files.DOCUMENT_PATTERNS)),
        100,
    )

    vault_dir = scratch_path(spark, "vault")
    places: dict[str, str] = {}
    timed("vault_build", lambda: places.update(write_vault(Vault(spark, sf).tables, vault_dir)), lines)
    stored = {name: spark.read.parquet(place) for name, place in places.items()}
    timed("quality_suite", lambda: quality.run_checks(stored, quality.vault_rules()).collect(), lines)

    star_dir = scratch_path(spark, "star")
    built: dict = {}
    timed("etl_full", lambda: built.update(run_warehouse(spark, line_inputs(spark, sf), star_dir, b.EFFECTIVE)), lines)
    facts, wells, sensors = built["fact_sensor_reading"], built["dim_well"], built["dim_sensor"]

    def kpi() -> None:
        well_mart = marts.mart_well_performance(facts, wells, built["dim_data_source"])
        marts.kpi_stats(well_mart, marts.mart_sensor_analysis(facts, sensors)).collect()

    timed("kpi_query", kpi, lines)

    readings, masters = b.event_readings(spark, sf), b.customer_wells(spark, sf)
    timed("etl_transform", lambda: consume(marts.well_analytics(readings, masters, b.LOADED_AT)), events)
    timed(
        "etl_daily",
        lambda: run_daily(readings, masters, scratch_path(spark, "daily"), "bench", b.LOADED_AT, ["reading_key"]),
        events,
    )

    for name in [
        "mart_well_performance",
        "mart_sensor_analysis",
        "well_analytics",
        "anomaly_combined",
        "link_seismic_reading",
        "sat_seismic_measurements",
        "vault_denormalized",
        "pattern_scan",
    ]:
        timed(name, lambda n=name: consume(QUERIES[n](spark, sf)), lines if "sei" in name or "vault" in name else events)

    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "per_second": {n: round(work[n] / s, 1) for n, s in seconds.items()},
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
