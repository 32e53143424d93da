"""Jobs that run load by load: files to the vault, the vault to the star, trace files as a stream."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspring.operators import numbering
from wellspring.plans import file_vault, vault_star
from wellspring.registry import bindings as b
from wellspring.registry import load_queries
from wellspring.sources import files, sinks, traces
from wellspring.streaming.incremental import incremental_traces

AT = "2025-01-01 00:00:00"
ARCHIVE = "well_id LONG, survey_type_id LONG, sensor_id LONG, timestamp TIMESTAMP_NTZ, depth_ft DOUBLE, amplitude DOUBLE, quality_flag INT"


def sgx(path, survey, rows):
    """A trace file of (well, depth, amplitude, flag) rows."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(traces.pack_traces(survey, np.array(rows, traces.record_dtype(traces.LAYOUT))))


def archive(spark, path, first, last, sensor=3):
    spark.range(first, last).selectExpr(
        "id % 5 AS well_id", "101L AS survey_type_id", f"{sensor}L AS sensor_id",
        "timestampadd(DAY, int(id), TIMESTAMP_NTZ'2024-01-01') AS timestamp", "id * 1.0D AS depth_ft", "id * 0.5D AS amplitude", "1 AS quality_flag",
    ).coalesce(1).write.parquet(path)


def masters(spark, root, delivery, wells):
    sinks.to_csv(spark.createDataFrame(wells, "well_id LONG, well_name STRING, location_lat DOUBLE, location_long DOUBLE, operator STRING, spud_date DATE").coalesce(1), f"{root}/wells/{delivery}")
    if delivery == 1:
        sinks.to_csv(spark.createDataFrame([(101, "2D"), (102, "3D")], "survey_type_id LONG, survey_type STRING"), f"{root}/surveys/1")
        sinks.to_csv(spark.createDataFrame([(3, "geophone", None)], "sensor_id LONG, sensor_type STRING, calibration_date TIMESTAMP"), f"{root}/sensors/1")


def landing(root):
    return file_vault.Landing(*[f"{root}/{k}" for k in ("wells", "surveys", "sensors", "archive", "traces")])


def wells(n, operator="a"):
    return [(i, f"w{i}", 1.0, 2.0, operator, None) for i in range(n)]


def counts(spark, root):
    return {n: t.count() for n, t in file_vault.read_file_vault(spark, root).items()}


def test_a_run_takes_only_files_it_has_not_seen(spark, tmp_path):
    place, root = str(tmp_path / "in"), str(tmp_path / "vault")
    assert file_vault.load_files(spark, landing(place), root, AT) is None  # nothing has arrived at all
    masters(spark, place, 1, wells(3))
    archive(spark, f"{place}/archive/1", 0, 20)
    sgx(f"{place}/traces/a.sgx", 102, [(1, 10.0, 1.5, 1), (1, 10.0, 1.5, 1), (2, 11.0, 2.5, 0)])
    assert file_vault.load_files(spark, landing(place), root, AT) == 1
    before = counts(spark, root)
    assert before["sat_seismic_measurements"] == 23 and before["link_seismic_reading"] == 23 and before["hub_well"] == 3
    assert file_vault.load_files(spark, landing(place), root, AT) is None
    assert counts(spark, root) == before

    masters(spark, place, 2, wells(3)[:2] + [(2, "w2", 1.0, 2.0, "moved", None), (9, "w9", 1.0, 2.0, "a", None)])
    archive(spark, f"{place}/archive/2", 20, 25)
    sgx(f"{place}/traces/b.sgx", 102, [(1, 12.0, 1.5, 1)])  # the key of a known trace
    sgx(f"{place}/traces/bad.sgx", 102, [(1, 12.0, 1.5, 1)])
    with open(f"{place}/traces/bad.sgx", "r+b") as f:
        f.truncate(20)
    assert file_vault.load_files(spark, landing(place), root, AT) == 2
    tables = file_vault.read_file_vault(spark, root)
    assert tables["sat_seismic_measurements"].count() == 29
    assert tables["link_seismic_reading"].count() == 28
    assert sorted(r.well_id for r in tables["hub_well"].filter("load_id = 2").collect()) == [9]
    assert sorted(r.well_id for r in tables["sat_well_details"].filter("load_id = 2").collect()) == [2, 9]
    ledger = tables[file_vault.LEDGER]
    assert [(os.path.basename(r.path), r.load_id) for r in ledger.filter("status = 'bad'").collect()] == [("bad.sgx", 2)]
    assert file_vault.load_files(spark, landing(place), root, AT) is None  # a bad file is not tried again as it is
    sgx(f"{place}/traces/bad.sgx", 102, [(7, 1.0, 1.0, 1)])
    assert file_vault.load_files(spark, landing(place), root, AT) == 3
    assert file_vault.read_file_vault(spark, root)["sat_seismic_measurements"].filter("load_id = 3").count() == 1


def test_an_interrupted_load_is_invisible_and_made_good(spark, tmp_path, monkeypatch):
    place, root = str(tmp_path / "in"), str(tmp_path / "vault")
    masters(spark, place, 1, wells(2))
    archive(spark, f"{place}/archive/1", 0, 10)
    file_vault.load_files(spark, landing(place), root, AT)
    archive(spark, f"{place}/archive/2", 10, 14)
    masters(spark, place, 2, wells(4))

    def broken(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(file_vault, "commit", broken)
        with pytest.raises(OSError):
            file_vault.load_files(spark, landing(place), root, AT)
    assert counts(spark, root)["sat_seismic_measurements"] == 10 and counts(spark, root)["hub_well"] == 2
    for f in os.listdir(f"{place}/wells/2"):  # the master is withdrawn: what the failed run wrote of it must go
        os.rename(f"{place}/wells/2/{f}", f"{place}/wells/2/_{f}")
    assert file_vault.load_files(spark, landing(place), root, AT) == 2
    assert counts(spark, root)["sat_seismic_measurements"] == 14 and counts(spark, root)["hub_well"] == 2


def test_star_keys_last_over_loads(spark, tmp_path):
    place, root, star_root = (str(tmp_path / n) for n in ("in", "vault", "star"))
    assert vault_star.load_star(spark, root, star_root, "2025-01-01") is None
    masters(spark, place, 1, [w for w in wells(5) if w[0] != 1])  # well 1 comes late
    archive(spark, f"{place}/archive/1", 0, 20)
    file_vault.load_files(spark, landing(place), root, AT)
    assert vault_star.load_star(spark, root, star_root, "2025-01-01") == 1
    assert vault_star.load_star(spark, root, star_root, "2025-01-01") is None
    first = vault_star.read_star(spark, star_root)
    old = {r.reading_key: r for r in first[vault_star.FACTS].drop("star_load").collect()}
    old_wells = {r.well_id: r.well_key for r in first["dim_well"].collect()}
    waiting = {r.reading_key for r in first[vault_star.REJECTS].collect()}
    assert len(old) == 16 and len(waiting) == 4 and sorted([*old, *waiting]) == list(range(1, 21))

    masters(spark, place, 2, [(1, "w1", 1.0, 2.0, "b", None), (0, "renamed", 1.0, 2.0, "b", None)])
    archive(spark, f"{place}/archive/2", 20, 30)
    sgx(f"{place}/traces/a.sgx", 102, [(4, 10.0, 60.0, 1), (4, 10.0, 60.0, 1)])
    file_vault.load_files(spark, landing(place), root, AT)
    assert vault_star.load_star(spark, root, star_root, "2025-02-01") == 2
    now = vault_star.read_star(spark, star_root)
    facts = {r.reading_key: r for r in now[vault_star.FACTS].drop("star_load").collect()}
    assert all(facts[k] == v for k, v in old.items())  # earlier facts are as they were
    assert waiting <= set(facts) and now[vault_star.REJECTS].count() == 0
    assert sorted(facts) == list(range(1, 33))
    new_wells = {r.well_id: (r.well_key, r.well_name, str(r.effective_date)) for r in now["dim_well"].collect()}
    assert all(new_wells[w][0] == k for w, k in old_wells.items())
    assert new_wells[1][0] == max(old_wells.values()) + 1 and new_wells[1][2] == "2025-02-01"
    assert new_wells[0][1:] == ("renamed", "2025-01-01")
    assert {(r.source_key, r.is_anomaly) for r in facts.values() if r.amplitude == 60.0} == {(5, 1)}


def test_keys_are_handed_out_without_a_shuffle(spark):
    df = spark.range(1000).repartition(7)
    found = numbering.hand_out_keys(df, "k", 50)
    assert sorted(r.k for r in found.collect()) == list(range(51, 1051))
    assert numbering.hand_out_keys(spark.range(0), "k", 50).count() == 0


def test_one_large_trace_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [(i % 9, float(i), float(i) / 2, i % 2) for i in range(5000)]
    sgx(f"{tmp_path}/in/a.sgx", 7, rows)
    listed = files.list_sources(spark, str(tmp_path / "in"), "*.sgx")
    assert listed.columns == ["path", "length", "modified"]
    read = traces.read_trace_files(listed, range_bytes=1300)
    assert len({r[0] for r in read.select(F.spark_partition_id()).distinct().collect()}) > 1
    got = sorted((r.trace_num, r.well_id, r.depth_ft, r.amplitude, r.quality_flag) for r in read.collect())
    assert got == [(i + 1, *r) for i, r in enumerate(rows)]
    with pytest.raises(ValueError):
        traces.read_trace_files(listed, on_error="never")


def test_trace_files_are_cut_by_traces_not_by_batches(spark, tmp_path):
    df = spark.range(25_000).selectExpr("id % 3 AS well_id", "5L AS survey_type_id", "id * 1.0D AS depth_ft", "1.0D AS amplitude", "1 AS quality_flag").coalesce(1)
    written = traces.write_sgx(df, str(tmp_path / "out"), file_traces=10_000).collect()
    assert sorted(r.traces for r in written) == [5_000, 10_000, 10_000]
    read = traces.read_sgx(spark, str(tmp_path / "out"))
    assert read.count() == 25_000 and read.filter("depth_ft <> trace_num - 1 AND source_file LIKE '%00001.sgx'").count() == 0


def test_incremental_traces_equal_a_full_build(spark, tmp_path):
    """Three deliveries, one late, one a repetition; equal measurements in a file and in two files all stay."""
    place, base = str(tmp_path / "in"), str(tmp_path / "vault")
    same = [(1, 10.0, 1.5, 1)] * 3
    deliveries = [{"d/a.sgx": same, "d/b.sgx": same[:1] + [(2, 5.0, 2.5, 0)]}, {"late/c.sgx": [(3, 1.0, 1.0, 1)] * 2}, {"again/a.sgx": same}]
    for delivery in deliveries:
        for name, rows in delivery.items():
            sgx(f"{place}/{name}", 101, rows)
            if name.startswith("late"):
                os.utime(f"{place}/{name}", (1_600_000_000, 1_600_000_000))
        incremental_traces(spark, place, f"{base}/link", f"{base}/sat", f"{base}/ck", AT).awaitTermination()
    got = Counter((r.record_source, r.trace_num, r.well_id, r.depth_ft, r.amplitude, r.quality_flag) for r in spark.read.parquet(f"{base}/sat").collect())
    want = Counter((name[-5:], i + 1, *r) for d in deliveries[:2] for name, rows in d.items() for i, r in enumerate(rows))
    assert got == want
    assert spark.read.parquet(f"{base}/link").count() == len({(well, at) for _, at, well, *_ in want})


def test_multisets_are_merged_by_count(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "part STRING, x INT, y STRING, source STRING"

    def append(rows):
        sinks.append_counted(spark.createDataFrame(rows, schema), path, "part", ["source"])
        return Counter((r.part, r.x, r.y) for r in spark.read.schema(schema).parquet(path).collect())

    a, b = ("p", 1, None, "f1"), ("q", 2, "z", "f1")
    assert append([a, a, b]) == {("p", 1, None): 2, ("q", 2, "z"): 1}
    assert append([a, a, b]) == {("p", 1, None): 2, ("q", 2, "z"): 1}
    assert append([("p", 1, None, "f2")] * 3) == {("p", 1, None): 3, ("q", 2, "z"): 1}
    assert append([a, ("q", None, None, "f3")]) == {("p", 1, None): 3, ("q", 2, "z"): 1, ("q", None, None): 1}



def test_parts_grow_with_the_files_of_a_table(spark, tmp_path):
    (tmp_path / "lineitem.parquet").mkdir()
    for i in range(3):
        (tmp_path / "lineitem.parquet" / f"part-{i}.parquet").write_bytes(b"x" * 1000)
    assert [b.parts_of(spark, str(tmp_path), "lineitem", 4, size) for size in (100, 999, 3000)] == [30, 4, 4]


def test_buckets_follow_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(b, "parts_of", lambda *a: 11)
    stored = load_queries._bucketed(spark, "/root/testdata/sf0.001")
    path = {f.rsplit("/", 1)[0] for f in stored["link_seismic_reading"].inputFiles()}
    buckets = {f.rsplit("_", 1)[1] for f in stored["link_seismic_reading"].inputFiles()}
    assert len(path) == 1 and len(buckets) == 11


def test_trace_batches_meet_only_what_their_files_brought(spark, tmp_path, monkeypatch):
    from wellspring.streaming import incremental

    place, base, semis, held, real = str(tmp_path / "in"), str(tmp_path / "vault"), [], [], sinks.gathered

    def gathered(df, *by):
        if "_more" in df.columns:
            semis.append([line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in line])
        return real(df, *by)

    def load_batch(rows, *args, **kinds):
        held.append(rows.storageLevel.useMemory)
        return load(rows, *args, **kinds)

    load = incremental.load_batch
    monkeypatch.setattr(sinks, "gathered", gathered)
    monkeypatch.setattr(incremental, "load_batch", load_batch)
    rows = [(1, 10.0, 1.5, 1)] * 2
    for i, name in enumerate(["a", "b", "c"]):
        sgx(f"{place}/{name}/{name}.sgx", 101, rows)
        if i:
            sgx(f"{place}/again{i}/a.sgx", 101, rows + rows[:i])
        incremental_traces(spark, place, f"{base}/link", f"{base}/sat", f"{base}/ck", AT).awaitTermination()
    got = Counter((r.record_source, r.trace_num) for r in spark.read.parquet(f"{base}/sat").collect())
    assert got == {(f"{n}.sgx", t): 1 for n in "abc" for t in (1, 2)} | {("a.sgx", 3): 1, ("a.sgx", 4): 1}
    assert held == [True] * 3 and [len(s) for s in semis] == [0, 1, 1] and all("record_source" in s[0] for s in semis[1:])
