"""Trace files, repair, sinks and incremental load on files made here."""

import io
import os
import re
import struct
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from wellspring.operators.vault import build_link, build_measurement_satellite
from wellspring.registry import damage
from wellspring.schemas import MASTER_WELLS
from wellspring.sources import files, repair, sinks, traces
from wellspring.streaming.incremental import incremental_load, load_batch


def trace_bytes(survey, records, layout=traces.LAYOUT):
    return traces.pack_traces(survey, np.array(records, traces.record_dtype(layout)))


@pytest.fixture
def folder(tmp_path):
    def put(name, data):
        (tmp_path / name).write_bytes(data)
        return str(tmp_path)

    return put


def test_bytes_are_the_published_layout():
    data = trace_bytes(101, [(7, 1.5, -2.25, 1)])
    assert data == struct.pack("<8sII", b"CPETRO01", 101, 1) + struct.pack("<IffB", 7, 1.5, -2.25, 1)
    assert len(data) == 16 + 13


def test_good_file(spark, folder):
    path = folder("a.sgx", trace_bytes(205, [(4_000_000_000, 0.1, 2.0, 1), (2, 3.0, -4.5, 0)]) + b"trailing")
    rows = [tuple(r) for r in traces.read_sgx(spark, path).orderBy("trace_num").collect()]
    tenth = float(np.float32(0.1))
    assert rows == [(1, 4_000_000_000, 205, tenth, 2.0, 1, "a.sgx"), (2, 2, 205, 3.0, -4.5, 0, "a.sgx")]
    assert traces.read_sgx(spark, f"{path}/a.sgx").count() == 2
    assert traces.sgx_errors(spark, path).count() == 0


def test_bad_files_strict_skip_and_salvage(spark, folder):
    good = trace_bytes(101, [(i, 1.0, 1.0, 1) for i in range(10)])
    folder("good.sgx", good)
    folder("magic.sgx", b"NOTMAGIC" + good[8:])
    folder("short.sgx", good[: 16 + 13 * 4 + 5])
    folder("tiny.sgx", b"CPET")
    path = folder("zero.sgx", trace_bytes(101, []))
    with pytest.raises(Exception, match="not a trace file|announces|no header"):
        traces.read_sgx(spark, path).collect()
    skipped = traces.read_sgx(spark, path, on_error="skip")
    assert {r.source_file for r in skipped.collect()} == {"good.sgx"}
    salvaged = traces.read_sgx(spark, path, on_error="salvage").groupBy("source_file").count().collect()
    assert {r.source_file: r["count"] for r in salvaged} == {"good.sgx": 10, "short.sgx": 4}
    errors = {os.path.basename(r.path): r.error for r in traces.sgx_errors(spark, path).collect()}
    assert set(errors) == {"magic.sgx", "short.sgx", "tiny.sgx"}
    assert errors["short.sgx"] == "73 bytes where the header announces 146"


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="nothing matches"):
        traces.read_sgx(spark, str(tmp_path)).collect()


def test_one_file_is_split_by_records(spark, folder):
    path = folder("big.sgx", trace_bytes(101, [(i, i / 2, i / 4, i % 2) for i in range(1000)]))
    split = traces.read_sgx(spark, path, task_bytes=13 * 64)
    assert split.rdd.getNumPartitions() == 16
    rows = split.orderBy("trace_num").collect()
    assert [(r.trace_num, r.well_id) for r in rows] == [(i + 1, i) for i in range(1000)]


def test_small_files_share_a_task():
    tasks = traces.plan_slices([(f"f{i}", 16 + 13 * 10) for i in range(100)], 13, 13 * 250)
    assert len(tasks) == 4 and sum(n for t in tasks for *_, n in t.slices) == 1000


def test_extended_layout(spark, folder):
    path = folder("x.sgx", trace_bytes(102, [(1, 2.0, 3.0, 4.0, 1)], traces.EXTENDED_LAYOUT))
    row = traces.read_sgx(spark, path, layout=traces.EXTENDED_LAYOUT).first()
    assert (row.well_id, row.survey_type_id, row.frequency, row.quality_flag) == (1, 102, 4.0, 1)
    with pytest.raises(ValueError):
        traces.parse_layout("a:zz")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.floats(width=32, allow_nan=False, allow_infinity=False),
                          st.floats(width=32, allow_nan=False, allow_infinity=False), st.integers(0, 255)), max_size=30))
def test_any_records_come_back(spark, tmp_path_factory, records):
    path = tmp_path_factory.mktemp("any")
    (path / "r.sgx").write_bytes(trace_bytes(9, records))
    rows = traces.read_sgx(spark, str(path), task_bytes=13 * 7).orderBy("trace_num").collect()
    assert [(r.well_id, r.depth_ft, r.amplitude, r.quality_flag) for r in rows] == records


def test_written_traces_come_back(spark, tmp_path):
    df = spark.range(5000).select(
        (F.col("id") % 3 + 101).alias("survey_type_id"), F.col("id").alias("well_id"), (F.col("id") / 2).alias("depth_ft"),
        F.lit(1.0).alias("amplitude"), F.lit(1).alias("quality_flag"),
    )
    written = traces.write_sgx(df, str(tmp_path / "out"), file_traces=700).collect()
    assert sum(r.traces for r in written) == 5000
    back = traces.read_sgx(spark, str(tmp_path / "out"))
    assert back.select("survey_type_id", "well_id").exceptAll(df.select("survey_type_id", "well_id")).count() == 0
    assert back.count() == 5000


def parquet_bytes(n=50, text="x"):
    out = io.BytesIO()
    pq.write_table(pa.table({"id": list(range(n)), "t": [text] * n}), out)
    return out.getvalue()


def hexed(data):
    digits = data.hex().encode()
    return b"\n".join(digits[i : i + 60] for i in range(0, len(digits), 60)) + b"\n"


@pytest.fixture
def damaged(folder):
    good = parquet_bytes()
    folder("good.parquet", good)
    folder("trailing.parquet", good + b"FLAG{HIDDEN_1}")
    folder("hex.parquet", hexed(good))
    folder("hex_trailing.parquet", hexed(good + b"junk"))
    folder("inner.parquet", parquet_bytes(text="PAR1 inside"))
    folder("none.parquet", b"no such thing here")
    folder("late.parquet", b"junk" + good)
    folder("single.parquet", b"PAR1 and nothing")
    folder("empty.parquet", b"")
    return folder("cut.parquet", good[: len(good) // 2])


def test_repair_directory(spark, damaged, tmp_path_factory):
    rows, manifest = repair.repair_parquet(spark, damaged, str(tmp_path_factory.mktemp("out") / "fixed"))
    got = {os.path.basename(r.path): r for r in manifest.collect()}
    fixed = {n for n, r in got.items() if r.status == "repaired"}
    assert fixed == {"good.parquet", "trailing.parquet", "hex.parquet", "hex_trailing.parquet", "inner.parquet"}
    assert got["hex.parquet"].was_hex and got["hex_trailing.parquet"].message == "cut 4 trailing bytes"
    assert got["trailing.parquet"].cut_at == len(parquet_bytes())
    assert got["none.parquet"].message == "no marker"
    assert got["late.parquet"].message == "first marker not at the start"
    assert rows.count() == 250
    assert {r.status: r.files for r in repair.repair_summary(manifest).collect()} == {"repaired": 5, "failed": 5}


def test_triage_agrees_with_repair(spark, damaged):
    got = {os.path.basename(r.path): r for r in repair.classify_files(spark, damaged).collect()}
    status = {n: r.status for n, r in got.items()}
    assert status == {
        "good.parquet": "whole", "trailing.parquet": "trailing", "hex.parquet": "hex",
        "hex_trailing.parquet": "hex_and_trailing", "inner.parquet": "whole", "none.parquet": "no_marker",
        "late.parquet": "marker_not_first", "single.parquet": "single_marker", "empty.parquet": "no_marker",
        "cut.parquet": "single_marker",
    }
    assert got["trailing.parquet"].cut_at == len(parquet_bytes())


def test_custom_step_before_repair(spark, folder, tmp_path_factory):
    path = folder("reversed.parquet", parquet_bytes()[::-1])
    out = str(tmp_path_factory.mktemp("out"))
    rows, _ = repair.repair_parquet(spark, path, f"{out}/a", pre_steps=[lambda d: d[::-1]])
    assert rows.count() == 50
    with pytest.raises(repair.RepairError):
        repair.repair_parquet(spark, path, f"{out}/b")


def whole_repair(data):
    """The same on a whole file at once: (bytes, was_hex, size, markers, cut, message)."""
    sample = data[:100]
    was_hex = data[:2] in (b"50", b"35") and sample.isascii() and len(re.findall(rb"[0-9A-Fa-f]", sample)) / len(sample) > 0.9
    if was_hex:
        try:
            data = bytes.fromhex(data.decode("ascii"))
        except ValueError as error:
            return None, True, len(data), 0, None, f"hex decoding failed: {error}"
    size, n = len(data), data.count(b"PAR1")
    if n == 0 or n > 1 and not data.startswith(b"PAR1"):
        return None, was_hex, size, n, None, "first marker not at the start" if n else "no marker"
    cut = data.rfind(b"PAR1") + 4 if n > 1 else None
    data = data[:cut]
    try:
        pq.read_table(io.BytesIO(data))
    except Exception:
        return None, was_hex, size, n, cut, "not readable after repair"
    message = "decoded" if was_hex else "read as it is"
    return data, was_hex, size, n, cut, f"cut {size - cut} trailing bytes" if cut is not None and cut < size else message


@pytest.mark.parametrize("chunk", [7, 64, 1000, 1 << 20])
def test_repair_in_chunks_is_that_of_whole_files(monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    good = parquet_bytes(400)
    wide = re.sub(rb"(.{30})", rb"\1" + b" " * 50, good.hex().encode())
    digits = good.hex().encode()
    cases = [
        good, good + b"tail", b"x" + good, good[:200], b"", b"PAR", b"PAR1", hexed(good), hexed(good + b"junk").upper(), wide, digits + b"zz", digits + b"0",
        digits[:301] + b" " + digits[301:], digits[:200] + b"q" + digits[200:] + b"\xe9", digits + b" \n" * 40, hexed(parquet_bytes(text="PAR1 inside")),
        b"50415231" + b"0" + b"50415231" * 3 + b"0", b"5" + b" " * 3, b"PAR1" * 20,
    ]
    for data in cases:
        view, facts = repair.repair_file(pa.BufferReader(data), len(data))
        got = None if view is None else b"".join(view.chunks())
        want = whole_repair(data)
        assert (got, facts["was_hex"], facts["decoded_size"], facts["n_markers"], facts["cut_at"], facts["message"]) == want
        assert facts["original_size"] == len(data) and (facts["rows"] is not None) == (got is not None)
        steps = [lambda d: d[1:]]
        view, facts = repair.repair_file(pa.BufferReader(b"x" + data), len(data) + 1, steps)
        assert (None if view is None else b"".join(view.chunks())) == want[0]


@pytest.mark.parametrize("kind", [k for k, _ in damage.PARQUET_DAMAGE])
def test_damage_and_repair_hold_a_few_chunks(tmp_path, kind):
    """30 MB, and 60 MB as hex text."""
    path = tmp_path / "big.parquet"
    pq.write_table(pa.table({"x": np.random.default_rng(1).random(3_700_000)}), path, use_dictionary=False, compression="none", row_group_size=100_000)
    size = os.path.getsize(path)
    make = dict(damage.PARQUET_DAMAGE)[kind]
    tracemalloc.start()
    with pa.OSFile(str(path)) as whole, open(tmp_path / "damaged", "wb") as out:
        for part in make(damage._chunks(whole, size), size):
            out.write(part)
    with pa.OSFile(str(tmp_path / "damaged")) as handle:
        view, facts = repair.repair_file(handle, handle.size())
        assert facts["rows"] == 3_700_000 and sum(map(len, view.chunks())) == size > 28 << 20
    assert tracemalloc.get_traced_memory()[1] < 24 << 20
    tracemalloc.stop()


def test_repaired_files_of_an_earlier_run_stay_out(spark, tmp_path):
    out = str(tmp_path / "out")
    for name in ("first", "second"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name} a+b%.parquet").write_bytes(parquet_bytes() + b"tail")
        rows, _ = repair.repair_parquet(spark, str(tmp_path / name), out)
        assert rows.count() == 50
    assert sum(n.endswith(".parquet") for n in os.listdir(out)) == 2


def test_patterns_in_files_have_byte_offsets(spark, folder):
    folder("a.parquet", "é".encode() + b"\x00\xffFLAG{ABC_1}FLAG{SECOND}")
    path = folder("b.parquet", b"nothing")
    found = [tuple(r) for r in repair.scan_files_for_patterns(spark, path).collect()]
    assert found == [("a.parquet", 0, "FLAG{ABC_1}", 4)]


def test_master_csv(spark, folder):
    path = folder("w.csv", b"well_id,well_name,location_lat,location_long,operator,spud_date\n1,A,40.5,50.1,Op,1995-01-01\n2,B,,,,\n")
    rows = files.read_master(spark, path, MASTER_WELLS).orderBy("well_id").collect()
    assert (rows[0].location_lat, str(rows[0].spud_date), rows[1].operator) == (40.5, "1995-01-01", None)


def test_dir_scan_keeps_the_file_name(spark, folder):
    folder("one.parquet", parquet_bytes(3))
    folder("skip.txt", b"x")
    path = folder("two.parquet", parquet_bytes(2))
    got = {r.record_source: r["count"] for r in files.read_dir(spark, path).groupBy("record_source").count().collect()}
    assert got == {"one.parquet": 3, "two.parquet": 2}


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    day = spark.range(10).select("id", F.lit("2024-01-01").alias("load_date"))
    for batch in (day.filter("id < 4"), day, day, day.unionByName(day)):
        sinks.append_table(batch, path, ["load_date", "id"])
    sinks.append_table(day.withColumn("load_date", F.lit("2024-01-02")), path, ["load_date", "id"])
    assert spark.read.parquet(path).count() == 20


def test_partition_overwrite_leaves_others(spark, tmp_path):
    path = str(tmp_path / "p")
    both = spark.range(10).select("id", (F.col("id") % 2).alias("year"))
    sinks.write_table(both, path, ["year"])
    sinks.write_table(both.filter("year = 1").withColumn("id", F.col("id") + 100), path, ["year"])
    got = spark.read.parquet(path)
    assert got.filter("year = 0").count() == 5 and got.filter("id >= 100").count() == 5 and got.count() == 10


def test_marts_export_reports_errors_and_goes_on(spark, tmp_path):
    bad = spark.range(1).select(F.array("id").alias("a"))
    out = sinks.export_marts({"bad": bad, "good": spark.range(3)}, str(tmp_path))
    assert out["good"] == "ok" and out["bad"].startswith("error")


def test_documents_are_limited_in_order(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.lit(float("nan")))
    sinks.to_documents(df, str(tmp_path / "all"))
    assert spark.read.json(str(tmp_path / "all")).count() == 100
    sinks.to_documents(df, str(tmp_path / "d"), ["id"], limit=10)
    back = spark.read.json(str(tmp_path / "d"))
    assert sorted(r.id for r in back.collect()) == list(range(10)) and {r.x for r in back.collect()} == {None}


def test_jdbc_sink_truncates_and_overwrites(spark, monkeypatch):
    # No database may be started here, so the call is caught at Spark's writer.
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: calls.append((url, table, mode, properties)))
    sinks.to_jdbc(spark.range(1), "jdbc:x", "analytics", {"user": "u"})
    assert calls == [("jdbc:x", "analytics", "overwrite", {"user": "u"})]


READING = "well_id LONG, survey_type_id LONG, sensor_id LONG, timestamp TIMESTAMP_NTZ, depth_ft DOUBLE, amplitude DOUBLE, quality_flag INT"


def _readings(spark, first, last):
    return spark.range(first, last).selectExpr(
        "id % 7 AS well_id", "101L AS survey_type_id", "id % 5 AS sensor_id",
        "timestampadd(DAY, int(id % 90), TIMESTAMP_NTZ'2024-01-01') AS timestamp", "id * 1.0D AS depth_ft",
        "id * 0.5D AS amplitude", "1 AS quality_flag",
    )


def test_incremental_load_takes_each_reading_once(spark, tmp_path):
    landing, base = tmp_path / "in", str(tmp_path / "vault")

    def load():
        incremental_load(
            spark, str(landing), _readings(spark, 0, 1).schema, f"{base}/link", f"{base}/sat", f"{base}/ck",
            "2025-01-01 00:00:00", files_per_batch=1,
        ).awaitTermination()
        return spark.read.parquet(f"{base}/link").count(), spark.read.parquet(f"{base}/sat").count()

    _readings(spark, 0, 300).coalesce(1).write.parquet(str(landing / "day1"))
    first = load()
    assert first[1] == 300
    assert load() == first
    _readings(spark, 100, 300).coalesce(1).write.parquet(str(landing / "day1_again"))
    assert load() == first
    _readings(spark, 300, 400).coalesce(1).write.parquet(str(landing / "late"))
    assert load()[1] == 400
    link = spark.read.parquet(f"{base}/link")
    assert link.count() == link.select("link_hash_key").distinct().count()


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    batch = _readings(spark, 0, 50).withColumn("record_source", F.lit("f"))
    paths = [str(tmp_path / "l"), str(tmp_path / "s")]
    load_batch(batch, *paths, "2025-01-01 00:00:00")
    before = [spark.read.parquet(p).count() for p in paths]
    load_batch(batch, *paths, "2025-01-02 00:00:00")
    assert [spark.read.parquet(p).count() for p in paths] == before


def test_batches_are_moved_without_their_hashes(spark, tmp_path, monkeypatch):
    batch = _readings(spark, 0, 50).withColumn("record_source", F.lit("f"))
    paths, moved, real = [str(tmp_path / "l"), str(tmp_path / "s")], [], sinks.gathered
    monkeypatch.setattr(sinks, "gathered", lambda df, *by: moved.append(set(df.columns)) or real(df, *by))
    for day in (batch, batch.union(batch.limit(1)), batch.limit(1)):
        load_batch(day, *paths, "2025-01-01 00:00:00")
    assert len(moved) == 6 and not set().union(*moved) & {"hash_diff", "well_hash_key", "survey_hash_key", "sensor_hash_key"}
    link, rows = (spark.read.parquet(p) for p in paths)
    assert rows.count() == 51 and rows.join(link, "link_hash_key", "left_anti").isEmpty()
    plain = build_measurement_satellite(batch, None, "2025-01-01 00:00:00")
    assert rows.select(*plain.columns).exceptAll(plain).count() == 1 and plain.exceptAll(rows.select(*plain.columns)).isEmpty()
    links = build_link(batch, None, "2025-01-01 00:00:00")
    assert sorted(links.collect()) == sorted(link.select(*links.columns).collect())


def test_a_stored_row_with_another_hash_is_no_equal(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "p")], "a long, part string")
    for name in ("one", "two", "two"):
        sinks.append_counted(rows, path, "part", derive=lambda df, name=name: {"hash": F.lit(name)}, columns=["a", "hash", "part"])
    assert sorted(r.hash for r in spark.read.parquet(path).collect()) == ["one", "two"]


def test_links_of_a_batch_are_grouped_once(spark, tmp_path, monkeypatch):
    """By the table's key alone; hash texts are left out where rows move to their partition."""
    batch = _readings(spark, 0, 60).withColumn("record_source", F.lit("f"))
    batch = batch.unionByName(batch.limit(20).withColumn("record_source", F.lit("e")))
    path, moved, real = str(tmp_path / "l"), [], sinks.gathered
    monkeypatch.setattr(sinks, "gathered", lambda df, *by: moved.append(df) or real(df, *by))
    load_batch(batch.filter("well_id < 4"), path, str(tmp_path / "s"), "2025-01-01 00:00:00")
    load_batch(batch, path, str(tmp_path / "s"), "2025-01-01 00:00:00")
    links = [df for df in moved if "_more" not in df.columns]
    assert len(links) == 2 and not any("link_hash_key" in df.columns for df in links)
    text = links[0]._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(") == 1
    stored = spark.read.parquet(path)
    want = build_link(batch, None, "2025-01-01 00:00:00")
    assert sorted(r.link_hash_key for r in stored.collect()) == sorted(r.link_hash_key for r in want.collect())
    assert stored.exceptAll(stored.distinct()).isEmpty() and all(f.endswith(".zstd.parquet") for f in stored.inputFiles())
