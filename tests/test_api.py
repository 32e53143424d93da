"""The dashboard questions over a written warehouse, and the script verbs."""

import io

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import wellspring
from wellspring import Dashboard, extract_flags, parse_sgx, recover
from wellspring.plans.jobs import together
from wellspring.schemas import MART_SENSOR, MART_WELL
from wellspring.sources import traces


def test_empty_warehouse_answers_with_zeros(spark, tmp_path):
    board = Dashboard(spark, str(tmp_path / "nothing"))
    assert board.well_performance().count() == 0 and board.survey_summary().count() == 0
    assert tuple(board.stats().first()) == (0, 0, 0.0, 0, 0, 0.0)
    assert board.snapshots().count() == 0
    for call in (lambda: board.snapshot("1"), lambda: board.time_travel(""), lambda: board.compare("1", ""),
                 lambda: board.time_travel("2025-01-01")):
        with pytest.raises(ValueError):
            call()


def test_dashboard_over_written_marts(spark, tmp_path):
    wells = spark.createDataFrame(
        [(1, None, 40.0, 50.0, "CSV", 10, 2.0, 0.5, 1), (2, "b", 0.0, 51.0, "CSV", 30, None, 1.0, 0)],
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MART_WELL.fields[:9]),
    )
    sensors = spark.createDataFrame([(5, None)], "sensor_id LONG, sensor_type STRING")
    wells.write.parquet(str(tmp_path / "mart_well_performance"))
    sensors.write.parquet(str(tmp_path / "mart_sensor_analysis"))
    board = Dashboard(spark, str(tmp_path))
    assert {r.well_name for r in board.well_performance().collect()} == {"Unknown", "b"}
    assert board.sensor_analysis().first().sensor_type == "Unknown"
    assert [r.well_id for r in board.wells_map().collect()] == [1]
    assert tuple(board.stats().first()) == (2, 40, 0.75, 1, 1, 0.5)
    board.take_snapshot("1", "2025-01-01 00:00:00")
    wells.withColumn("avg_amplitude", F.lit(3.0)).write.mode("overwrite").parquet(str(tmp_path / "mart_well_performance"))
    board.take_snapshot("2", "2025-01-02 00:00:00")
    assert [r.snapshot_id for r in board.snapshots().collect()] == ["1", "2"]
    assert board.compare("1", "2").first().amplitude_diff == 1.0
    assert board.time_travel("2025-01-01 12:00:00").count() == 2
    assert board.snapshot_summary("2").first().avg_amplitude == 3.0


def test_script_verbs(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    records = np.array([(1, 2.0, 3.0, 1)], traces.record_dtype(traces.LAYOUT))
    (source / "a.sgx").write_bytes(traces.pack_traces(101, records))
    (source / "b.sgx").write_bytes(traces.pack_traces(102, records))
    (source / "c.sgx").write_bytes(b"bad")
    assert parse_sgx(spark, str(source), str(tmp_path / "all")).count() == 2
    split = parse_sgx(spark, str(source), str(tmp_path / "each"), by_file=True)
    assert {r.source_file for r in split.collect()} == {"a.sgx", "b.sgx"}
    out = io.BytesIO()
    pq.write_table(pa.table({"x": [1, 2]}), out)
    (source / "p.parquet").write_bytes(out.getvalue() + b"FLAG{FOUND_IT}")
    log = recover(spark, str(source), str(tmp_path / "fixed")).collect()
    assert [(r.status, r.rows) for r in log] == [("repaired", 2)]
    assert [r.match for r in extract_flags(spark, str(source)).collect()] == ["FLAG{FOUND_IT}"]


def test_failure_of_one_of_several_actions_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        together({"good": lambda: spark.range(1).count(), "bad": lambda: 1 / 0})


def test_public_names_exist():
    for name in wellspring.__all__:
        assert getattr(wellspring, name) is not None
    assert {f.name for f in MART_SENSOR} >= {"sensor_id", "total_readings"}
