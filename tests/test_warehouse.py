"""Vault, star, marts, snapshots, quality suite and the two jobs on small tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from wellspring.operators import marts, quality, snapshots, star, vault
from wellspring.plans.jobs import WarehouseInputs, run_daily, run_warehouse, write_vault

LOADED = "2025-01-01 00:00:00"


@pytest.fixture
def masters(spark):
    wells = spark.sql(
        """SELECT id AS well_id, concat('Well ', id) AS well_name, id * 1.5D AS location_lat, id * 2.0D AS location_long,
        IF(id % 2 = 0, 'East', 'West') AS operator, DATE'1995-01-01' AS spud_date FROM range(1, 21)"""
    )
    surveys = spark.createDataFrame(
        [(101, "Acoustic_2D"), (102, "Acoustic_3D"), (205, "Acoustic_VS")], "survey_type_id LONG, survey_type STRING"
    )
    sensors = spark.sql(
        "SELECT id AS sensor_id, 'Geophone' AS sensor_type, TIMESTAMP'2020-01-01' AS calibration_date FROM range(1, 51)"
    )
    return wells, surveys, sensors


@pytest.fixture
def readings(spark):
    """600 readings: half archive rows with a sensor and day stamps, half traces without either."""
    archive = spark.sql(
        """SELECT id AS reading_key, id % 20 + 1 AS well_id, element_at(array(101L, 102L, 205L), int(id % 3) + 1) AS survey_type_id,
        id % 50 + 1 AS sensor_id, CAST(date_add(DATE'2024-01-01', int(id % 32)) AS TIMESTAMP_NTZ) AS timestamp,
        id * 1.0D AS depth_ft, IF(id = 7, 500.0D, (id % 17) - 8.0D) AS amplitude, int(id % 10 <> 0) AS quality_flag,
        'Parquet' AS source_format, 'archive_1' AS record_source FROM range(300)"""
    )
    traces = spark.sql(
        """SELECT 1000 + id AS reading_key, id % 20 + 1 AS well_id, 101L AS survey_type_id, id + 1 AS trace_num,
        id * 1.0D AS depth_ft, (id % 13) - 6.0D AS amplitude, 1 AS quality_flag, 'SGX' AS source_format,
        'traces_1' AS record_source FROM range(300)"""
    )
    return vault.union_sources([archive, traces])


def test_vault_counts_and_thirty_checks(spark, masters, readings, tmp_path):
    tables = vault.build_vault(*masters, readings, LOADED)
    assert tables["hub_well"].count() == 20 and tables["hub_survey"].count() == 3 and tables["hub_sensor"].count() == 50
    assert tables["sat_seismic_measurements"].count() == 600
    links = tables["link_seismic_reading"]
    assert links.filter(F.col("sensor_hash_key").isNull()).count() == 300
    places = write_vault(tables, str(tmp_path))
    stored = {n: spark.read.parquet(p) for n, p in places.items()}
    report = quality.run_checks(stored, quality.vault_rules())
    assert report.count() == 30
    assert tuple(quality.success_rate(report).first()) == (30, 30, 0, 100.0)
    quality.gate(report)


def test_double_delivery_adds_no_links(masters, readings):
    once = vault.build_link(readings, None, LOADED)
    twice = vault.build_link(readings.unionByName(readings.withColumn("record_source", F.lit("zz_again"))), None, LOADED)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_wider_grain_keeps_more_links(readings):
    archive = readings.filter("sensor_id IS NOT NULL")
    coarse = vault.build_link(archive, None, LOADED).count()
    fine = vault.build_link(archive, None, LOADED, extra=["depth_ft"]).count()
    assert coarse <= fine == 300


FAULTS = {
    ("uniqueness", "hub_well", "well_id"): ("hub_well", lambda t: t.unionByName(t.filter("well_id = 3"))),
    ("reference", "link_seismic_reading", "well_hash_key"): ("hub_well", lambda t: t.filter("well_id <> 3")),
    ("completeness", "sat_seismic_measurements", "amplitude"): (
        "sat_seismic_measurements", lambda t: t.withColumn("amplitude", F.when(F.col("depth_ft") > 5, F.col("amplitude")))),
    ("format", "hub_survey", "survey_hash_key"): ("hub_survey", lambda t: t.withColumn("survey_hash_key", F.lit(None).cast("string"))),
    ("columns", "hub_sensor", ""): ("hub_sensor", lambda t: t.drop("record_source")),
    ("row_count", "hub_survey", ""): ("hub_survey", lambda t: t.limit(2)),
    ("reference", "sat_seismic_measurements", "link_hash_key"): ("link_seismic_reading", lambda t: t.filter("sensor_hash_key IS NULL")),
}


@pytest.mark.parametrize("fault", list(FAULTS), ids=lambda f: "-".join(f))
def test_each_fault_is_found(masters, readings, fault):
    tables = vault.build_vault(*masters, readings, LOADED)
    name, damage = FAULTS[fault]
    report = quality.run_checks({**tables, name: damage(tables[name])}, quality.vault_rules())
    failed = {tuple(r)[:3] for r in quality.failed_checks(report).collect()}
    assert fault in failed
    with pytest.raises(quality.QualityGateError):
        quality.gate(report, blocking=[fault[0]])


def test_domain_rules_gate_threshold_and_history(spark, masters, readings, tmp_path):
    tables = vault.build_vault(*masters, readings, LOADED)
    report = quality.run_checks(tables, quality.domain_rules())
    assert {r.passed for r in report.collect()} == {True}
    bad = readings.withColumn("quality_flag", F.when(F.col("reading_key") == 5, 7).otherwise(F.col("quality_flag")))
    bad_tables = {"sat_seismic_measurements": vault.build_measurement_satellite(bad, None, LOADED)}
    assert quality.failed_checks(quality.run_checks(bad_tables, quality.domain_rules())).count() == 1
    almost = [quality.Complete("t", "x", minimum=0.99)]
    t = spark.range(1000).select(F.when(F.col("id") > 4, F.col("id")).alias("x"))
    quality.gate(quality.run_checks({"t": t}, almost))
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.run_checks({"t": t.limit(100)}, almost))
    for day in ("2025-01-01", "2025-01-02"):
        quality.append_run(report, str(tmp_path / "history"), f"{day} 00:00:00")
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2


def test_calendar_has_every_day(spark):
    days = star.dim_time(spark)
    assert days.count() == 14_975
    got = {str(r.full_date): tuple(r) for r in days.filter("full_date IN ('1990-01-01','2024-12-29','2030-12-31')").collect()}
    assert got["1990-01-01"][0] == 1 and got["2030-12-31"][0] == 14_975
    assert got["2024-12-29"][2:] == (2024, 4, 12, 29, 6, 52, 1)


def test_dimension_names_by_id_and_unknown_types(spark, masters):
    wells = star.dim_well(masters[0], spark.createDataFrame([(3,), (99,), (99,)], "well_id LONG"), "2025-01-01")
    late = wells.filter("well_id = 99").first()
    assert (late.well_key, late.well_name, late.latitude, late.is_current) == (21, "99", None, 1)
    assert wells.filter("well_id = 3").first().latitude == 4.5
    sensors = star.dim_sensor(masters[2], spark.createDataFrame([(77,)], "sensor_id LONG"), "2025-01-01")
    assert sensors.filter("sensor_id = 77").first().sensor_type == "Unknown"


def test_refresh_keeps_surrogates(spark, masters):
    old = star.dim_well(masters[0].filter("well_id > 5"), None, "2025-01-01")
    new = masters[0].withColumnsRenamed({"location_lat": "latitude", "location_long": "longitude"})
    from wellspring.schemas import DIM_WELL, conform

    out = star.refresh_dimension(old, conform(new, DIM_WELL, {"is_current": 1}), "well_id", "well_key")
    keys = {r.well_id: r.well_key for r in out.collect()}
    assert keys == {**{i: i - 5 for i in range(6, 21)}, **{i: 15 + i for i in range(1, 6)}}


def test_fact_defaults_and_rejects(spark, masters, readings):
    wells = star.dim_well(masters[0].filter("well_id <> 4"), None, "2025-01-01")
    sensors = star.dim_sensor(masters[2], None, "2025-01-01")
    facts = star.fact_sensor_reading(readings, wells, star.dim_time(spark), sensors, star.dim_data_source(spark))
    assert facts.count() + star.fact_rejects(readings, wells).count() == 600
    trace = facts.filter("reading_key = 1000").first()
    assert (trace.sensor_key, trace.source_key, str(trace.timestamp)) == (1, 5, "2024-01-01 00:00:00")
    hit = facts.filter("reading_key = 7").first()
    assert (hit.is_anomaly, hit.data_quality_score, hit.frequency) == (1, 1.0, 0.0)
    assert facts.filter("reading_key = 10").first().data_quality_score == 0.5
    bare = star.fact_sensor_reading(readings.drop("sensor_id", "timestamp", "quality_flag", "source_format"), wells, star.dim_time(spark))
    row = bare.filter("reading_key = 10").first()
    assert (row.sensor_key, row.source_key, row.quality_flag) == (1, 3, 1)


def test_well_analytics_null_nan_and_single_rows(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1), (1, 3.0, None), (1, None, 1), (2, 5.0, 0), (None, 9.0, 1)], "well_id LONG, amplitude DOUBLE, quality_flag INT"
    )
    got = {r.well_id: r for r in marts.well_analytics(df, None, LOADED).collect()}
    assert set(got) == {1, 2}
    one = got[1]
    assert (one.avg_amplitude, one.reading_count, one.well_name) == (2.0, 2, "WELL-1")
    assert one.quality_score == pytest.approx(2 / 3)
    assert got[2].std_amplitude is None


def test_kpi_of_empty_marts(spark):
    wells = spark.createDataFrame(
        [], "well_id LONG, well_name STRING, total_readings LONG, avg_amplitude DOUBLE, data_quality_rate DOUBLE, anomaly_count LONG"
    )
    sensors = spark.createDataFrame([], "sensor_id LONG")
    assert tuple(marts.kpi_stats(wells, sensors).first()) == (0, 0, 0.0, 0, 0, 0.0)
    one = spark.createDataFrame([(1, "a", 10, 2.0, 0.5, 1), (2, "b", 30, 4.0, 1.0, 0)], wells.schema)
    assert tuple(marts.kpi_stats(one, sensors).first()) == (2, 40, 0.75, 1, 1, 3.5)


def test_duplicate_current_wells_merge_like_a_group_by(spark):
    facts = spark.createDataFrame(
        [(1, 1, 3, 2.0, 1, 0), (2, 2, 3, 6.0, 0, 1), (3, 2, 3, None, None, 0)],
        "reading_key LONG, well_key LONG, source_key INT, amplitude DOUBLE, quality_flag INT, is_anomaly INT",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    wells = spark.createDataFrame(
        [(1, 5, "w", 1.0, 1.0, 1), (2, 5, "w", 1.0, 1.0, 1), (3, 6, "x", 1.0, 1.0, 0)],
        "well_key LONG, well_id LONG, well_name STRING, latitude DOUBLE, longitude DOUBLE, is_current INT",
    )
    row = marts.mart_well_performance(facts, wells, star.dim_data_source(spark)).collect()
    assert len(row) == 1
    assert (row[0].total_readings, row[0].avg_amplitude, row[0].anomaly_count) == (3, 4.0, 1)
    assert row[0].data_quality_rate == pytest.approx(1 / 3)


@pytest.fixture
def versions(spark):
    base = spark.createDataFrame(
        [(1, "a", 10, 1.0, 0.5), (2, "b", 20, 3.0, 1.0)],
        "well_id LONG, name STRING, total_readings LONG, avg_amplitude DOUBLE, data_quality_rate DOUBLE",
    )
    later = base.filter("well_id = 1").withColumn("avg_amplitude", F.lit(4.0)).unionByName(
        spark.createDataFrame([(3, "c", 5, None, 1.0)], base.schema)
    )
    return base, later


def test_snapshots_written_listed_and_travelled(spark, versions, tmp_path):
    path = str(tmp_path / "snapshots")
    snapshots.write_snapshot(versions[0], path, "01", "2025-01-01 00:00:00")
    snapshots.write_snapshot(versions[1], path, "02", "2025-01-02 00:00:00")
    snapshots.write_snapshot(versions[0], path, "01", "2025-01-01 00:00:00")
    table = snapshots.read_snapshots(spark, path)
    listed = {r.snapshot_id: r.records_count for r in snapshots.list_snapshots(table).collect()}
    assert listed == {"01": 2, "02": 2}
    summary = snapshots.snapshot_summary(snapshots.read_snapshot(table, "01")).first()
    assert (summary.total_wells, summary.total_readings, summary.avg_amplitude) == (2, 30, 2.0)
    for moment, wanted in [("2025-01-01", "01"), ("2025-01-01 23:59:59", "01"), ("2025-01-02", "02"), ("2026-01-01", "02")]:
        assert {r.snapshot_id for r in snapshots.as_of(table, moment).collect()} == {wanted}
    with pytest.raises(ValueError):
        snapshots.as_of(table, "2024-12-31")
    with pytest.raises(ValueError):
        snapshots.read_snapshot(table, "03")
    with pytest.raises(ValueError):
        snapshots.compare_snapshots(table, "01", "")
    row = snapshots.compare_snapshots(table, "01", "02").first()
    assert (row.wells_diff, row.amplitude_diff, row.amplitude_change_pct) == (0, 2.0, 100.0)
    diff = snapshots.snapshot_diff(table, "01", "02", ["well_id"], ["avg_amplitude"]).collect()
    assert {r.well_id: r.change for r in diff} == {1: "changed", 2: "removed", 3: "added"}


def test_pruning_of_snapshots(spark, versions, tmp_path):
    path = str(tmp_path / "pruned")
    snapshots.write_snapshot(versions[0], path, "a", "2025-01-01 00:00:00")
    snapshots.write_snapshot(versions[1], path, "b", "2025-01-02 00:00:00")
    plan = snapshots.as_of(snapshots.read_snapshots(spark, path), "2025-01-01")
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_whole_warehouse(spark, masters, readings, tmp_path):
    inputs = WarehouseInputs(masters[0], masters[2], readings)
    out = run_warehouse(spark, inputs, str(tmp_path / "star"), "2025-01-01", spread_sensors=True, degrade_share=0.1)
    assert out["fact_sensor_reading"].count() == 600
    per_sensor = {r["count"] for r in out["fact_sensor_reading"].groupBy("sensor_key").count().collect()}
    assert per_sensor == {12}
    assert out["mart_sensor_analysis"].count() == 50
    assert out["mart_well_performance"].agg(F.sum("total_readings")).first()[0] == 600
    again = run_warehouse(spark, inputs, str(tmp_path / "star"), "2025-01-01", spread_sensors=True, degrade_share=0.1)
    assert again["fact_sensor_reading"].count() == 600 and again["fact_survey_event"].count() == 40


def test_daily_run_is_repeatable(spark, masters, readings, tmp_path):
    for _ in range(2):
        report = run_daily(readings, masters[0], str(tmp_path), "run-7", LOADED, ["reading_key"])
    row = report.first()
    assert row.extract.measurements == 600 and row.extract.wells == 20
    assert row.transform.wells_processed == 20 and row.load.mongodb == 600
    folder = tmp_path / "reports" / "etl_report_20250101"
    text = "".join((folder / f).read_text() for f in os.listdir(folder) if f.startswith("part-"))
    assert json.loads(text)["pipeline_run"] == "run-7"
    assert spark.read.json(str(tmp_path / "exports" / "well_analytics_20250101")).count() == 20
