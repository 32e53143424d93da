"""Numbering, quantiles, joins and history against brute force on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspring.functions.keys import hash_diff
from wellspring.operators import anomaly, history, joins, numbering, quality, snapshots
from wellspring.operators.anomaly import detect_anomalies, iqr_outliers, sigma_flag, z_score
from wellspring.operators.quantiles import group_quantiles, rounded_to


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_surrogate_key_is_dense_in_key_order(spark, n):
    ids = random.Random(1).sample(range(10_000_000), n)
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id LONG, name STRING").repartition(5)
    found = [(r.k, r.id, r.name) for r in numbering.surrogate_key(df, "id", "k", start=10).collect()]
    assert sorted(found) == [(10 + i, v, str(v)) for i, v in enumerate(sorted(ids), 1)]


def test_surrogate_key_is_dense_for_any_number_of_ranges(spark):
    df = spark.range(500)
    found = numbering.surrogate_key(df, "id", "k", ranges=3).collect()
    assert sorted((r.k, r.id) for r in found) == [(i + 1, i) for i in range(500)]


def test_number_rows_over_many_partitions(spark):
    values = [(random.Random(i).random(), i) for i in range(3000)]
    df = spark.createDataFrame(values, "x DOUBLE, id INT").repartition(6)
    found = {r.id: r.n for r in numbering.number_rows(df, ["x", "id"], "n", partitions=7).collect()}
    assert found == {i: n for n, (_, i) in enumerate(sorted(values), 1)}


@pytest.mark.parametrize("rows,groups", [(10_820, 50), (10, 3), (2, 5)])
def test_spread_blocks_leaves_the_remainder_alone(spark, rows, groups):
    df = spark.range(rows).select(F.col("id").alias("reading_key"), F.lit(1).alias("sensor_key"))
    sensors = spark.range(1, groups + 1).select(F.col("id").alias("sensor_key"))
    out = numbering.spread_blocks(df, ["reading_key"], sensors, "sensor_key")
    block = rows // groups
    want = {i: i // block + 1 if block and i < block * groups else 1 for i in range(rows)}
    assert {r.reading_key: r.sensor_key for r in out.collect()} == want
    if rows == 10_820:
        sizes = out.groupBy("sensor_key").count().collect()
        assert sorted(r["count"] for r in sizes) == [216] * 49 + [236]


def test_slices(spark):
    df = spark.range(1000).repartition(4)
    assert sorted(r.id for r in numbering.slice_rows(df, ["id"], 100, 20).collect()) == list(range(100, 120))
    assert numbering.slice_rows(df, ["id"], 995, 20).count() == 5


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, float("nan")), (None, 3.0)], "g long, x double")
    for flagged in (
        anomaly.threshold_flag(df, "x", 100.0, "o"),
        anomaly.sigma_flag(df, "x", 2.0, "o"),
        iqr_outliers(df, ["g"], "x", name="o"),
        anomaly.detect_anomalies(df, ["g"], "x").withColumnRenamed("is_anomaly", "o"),
    ):
        assert [r.o for r in flagged.filter(F.isnan("x")).collect()] == [0]


def test_small_doubles_have_their_own_text(spark):
    df = spark.createDataFrame([(1e-11,), (2e-11,), (0.0,), (-0.0,), (12345678.5,)], "x double")
    found = [r[0] for r in df.select(hash_diff(df, ["x"])).collect()]
    assert len(set(found)) == 4 and found[2] == found[3]


def _groups(seed=0):
    rng = random.Random(seed)
    out = {"hot": [round(rng.gauss(0, 100), 2) for _ in range(1500)], "one": [3.5], "same": [2.0] * 40,
           "ties": [float(rng.choice([1, 2, 2, 2, 9])) for _ in range(300)]}
    out["wide"] = [10.0 ** rng.randint(-200, 200) for _ in range(250)]
    return out


def test_group_quantiles_are_exact(spark):
    data = _groups()
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("hot", None), ("one", float("nan"))]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE").repartition(4)
    found = {r.g: r.q for r in group_quantiles(df, ["g"], "x", [0.25, 0.5, 0.9]).collect()}
    for g, values in data.items():
        np.testing.assert_allclose(found[g], np.quantile(values, [0.25, 0.5, 0.9]), rtol=1e-9, err_msg=g)


def test_global_quantiles(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    assert group_quantiles(df, [], "x", [0.25, 0.75]).first().q == [250.75, 750.25]


def test_quantiles_of_odd_groups_in_one_lazy_plan(spark):
    inf = float("inf")
    data = {
        None: [5.0, 1.0, 3.0],
        "ends": [-inf, -1.0, 0.0, -0.0, 1e-320, 1.7e308, inf],
        "near": [1.0 + i * 2.0**-52 for i in range(40)],  # apart in the last bits only
        "signs": [-(2.0**i) for i in range(-30, 30)] + [2.0**i for i in range(-30, 30)],
        "large": [1.5e300 * (1 + i * 2.0**-40) for i in range(60)],
    }
    rows = [(g, v) for g, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE").repartition(3)
    tracker = spark.sparkContext.statusTracker()
    jobs = set(tracker.getJobIdsForGroup())
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    plan = group_quantiles(df, ["g"], "x", shares)
    assert set(tracker.getJobIdsForGroup()) == jobs
    found = {r.g: r.q for r in plan.collect()}
    assert set(found) == set(data)
    for g, values in data.items():
        s = sorted(values)
        for share, got in zip(shares, found[g]):
            place = (len(s) - 1) * share
            low, high = s[int(place)], s[min(int(place) + 1, len(s) - 1)]
            want = low if low == high or place == int(place) else low + (high - low) * (place - int(place))
            assert got == pytest.approx(want, rel=1e-12, nan_ok=True), (g, share)


@pytest.mark.parametrize("bits", [18, 22, 36])
def test_rounding_keeps_the_order(spark, bits):
    rng = random.Random(bits)
    values = sorted({rng.uniform(-1, 1) * 2.0 ** rng.randint(-1070, 1020) for _ in range(3000)} | {float("inf"), -float("inf"), 0.0})
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").select("x", rounded_to(F.col("x"), bits).alias("r"))
    rounded = [r.r for r in df.orderBy("x").collect()]
    assert all(a <= b for a, b in zip(rounded, rounded[1:]))
    assert all(v == r or abs(v - r) <= abs(v) * 2.0 ** (1 - bits) for v, r in zip(values, rounded) if 1e-300 < abs(v) < 1e300)


def test_anomaly_rules_against_numpy(spark):
    data = _groups(3)
    data.pop("wide")
    rows = [(i, g, v) for i, (g, v) in enumerate((g, v) for g, vs in data.items() for v in vs)]
    df = spark.createDataFrame(rows, "id INT, g STRING, x DOUBLE").repartition(3)
    x = np.array([r[2] for r in rows])
    mean, std = x.mean(), x.std(ddof=1)
    got = {r.id: (r.s, r.z) for r in z_score(sigma_flag(df, "x", name="s"), "x", "z").collect()}
    assert [got[i][0] for i in range(len(x))] == list((abs(x - mean) > 2 * std).astype(int))
    np.testing.assert_allclose([got[i][1] for i in range(len(x))], abs((x - mean) / std))

    fence = {}
    for g, v in data.items():
        q1, q3 = np.quantile(v, [0.25, 0.75])
        fence[g] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    outside = [int(v < fence[g][0] or v > fence[g][1]) for _, g, v in rows]
    got = {r.id: r.o for r in iqr_outliers(df, ["g"], "x", name="o").collect()}
    assert [got[i] for i in range(len(x))] == outside
    both = {r.id: r.is_anomaly for r in detect_anomalies(df, ["g"], "x").collect()}
    assert [both[i] for i in range(len(x))] == [int(o or abs((v - mean) / std) > 2.5) for o, v in zip(outside, x)]


def test_anomaly_rules_on_nothing_and_on_equal_values(spark):
    empty = spark.createDataFrame([], "g STRING, x DOUBLE")
    assert detect_anomalies(empty, ["g"], "x").count() == 0
    flat = spark.createDataFrame([("a", 1.0)] * 5 + [("a", None)], "g STRING, x DOUBLE")
    assert {r.is_anomaly for r in detect_anomalies(flat, ["g"], "x").collect()} == {0}
    assert {r.z_score for r in z_score(flat, "x").collect()} == {None}


def test_lookup_required_default_and_rejects(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id INT, k STRING")
    dim = spark.createDataFrame([("a", 10)], "k STRING, key INT")
    assert rows(joins.lookup_key(facts, dim, "k", "key"), "id", "key") == [(1, 10)]
    assert rows(joins.lookup_key(facts, dim, "k", "key", default=1), "id", "key") == [(1, 10), (2, 1), (3, 1)]
    assert rows(joins.rejects(facts, dim, "k"), "id") == [(2,), (3,)]


def test_rows_without_a_key_are_spread(spark):
    """With shuffled joins, rows with a null key end up in many partitions and still match nothing."""
    facts = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"))
    dim = spark.createDataFrame([(i, i * 10) for i in range(5)], "k LONG, key LONG")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.left_join(facts, dim, "k")
        parts = out.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        found = {(r.id, r.key) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 1000
    assert found == {(i, i % 5 * 10 if i % 3 == 0 else None) for i in range(4000)}


def test_orphans_and_reference_counts(spark, rows):
    child = spark.createDataFrame([("a",)] * 5 + [("x",)] * 2 + [(None,)], "k STRING")
    parent = spark.createDataFrame([("a",), ("b",)], "k STRING")
    assert joins.orphans(child, parent, "k").count() == 3
    assert joins.orphans(child, parent, "k", nullable=True).count() == 2
    assert tuple(joins.reference_counts(child, parent, "k").first()) == (8, 5, 2, 1)
    assert tuple(joins.reference_counts(child.limit(0), parent, "k").first()) == (0, 0, 0, 0)


def test_insert_ignore_and_upsert(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "id INT, v STRING")
    incoming = spark.createDataFrame([(2, "new"), (3, "b"), (3, "a")], "id INT, v STRING")
    assert rows(joins.insert_ignore(target, incoming, "id")) == [(1, "old"), (2, "old"), (3, "a")]
    assert rows(joins.upsert(target, incoming, "id")) == [(1, "old"), (2, "new"), (3, "a")]
    again = joins.insert_ignore(joins.insert_ignore(target, incoming, "id"), incoming, "id")
    assert again.count() == 3


def test_flag_where_in(spark, rows):
    df = spark.createDataFrame([(1, 1), (2, 1)], "id INT, q INT")
    keys = spark.createDataFrame([(2,), (2,)], "id INT")
    assert rows(joins.flag_where_in(df, keys, "id", {"q": 0})) == [(1, 1), (2, 0)]


def test_dedup_first_breaks_ties_by_the_other_columns(spark, rows):
    df = spark.createDataFrame([("k", "f2", 1), ("k", "f1", 9), ("k", "f1", 3), ("m", None, 1)], "k STRING, src STRING, v INT")
    assert rows(history.dedup_first(df, "k", ["src"])) == [("k", "f1", 3), ("m", None, 1)]


def _brute_lag(data):
    seen, out = {}, {}
    for key, day, value in sorted(data):
        out[(key, day)] = seen.get(key)
        seen[key] = value
    return out


def test_neighbour_value_equals_a_plain_lag(spark):
    rng = random.Random(2)
    data = list({(rng.choice("ab"), f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"): rng.choice([1, 2, None])
                 for _ in range(150)}.items())
    data = [(k, d, v) for (k, d), v in data]
    df = spark.createDataFrame(data, "k STRING, d STRING, v INT").withColumn("d", F.to_date("d"))
    month = F.date_trunc("month", F.col("d"))
    lag = history.neighbour_value(df, ["k"], ["d"], "v", "p", month)
    assert {(r.k, str(r.d)): r.p for r in lag.collect()} == _brute_lag(data)
    lead = history.neighbour_value(df, ["k"], ["d"], "v", "n", month, ahead=True)
    by_key = {}
    for k, d, v in sorted(data, reverse=True):
        by_key.setdefault(k, []).append((d, v))
    want = {(k, d): (vs[i - 1][1] if i else None) for k, vs in by_key.items() for i, (d, _) in enumerate(vs)}
    assert {(r.k, str(r.d)): r.n for r in lead.collect()} == want


def test_changed_rows_latest_and_validity(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "a"), (1, "2024-01-02", "a"), (1, "2024-03-01", "b"), (1, "2024-04-01", "a"), (2, "2024-01-01", "z")],
        "id INT, t STRING, hash_diff STRING",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    kept = history.changed_rows(df, "id", "t")
    assert [(r.id, str(r.t)[:10]) for r in kept.orderBy("id", "t").collect()] == [
        (1, "2024-01-01"), (1, "2024-03-01"), (1, "2024-04-01"), (2, "2024-01-01")]
    assert rows(history.latest_version(df, "id", "t"), "id", "hash_diff") == [(1, "a"), (2, "z")]
    spans = history.validity(kept, "id", "t").orderBy("id", "effective_date").collect()
    assert [(r.id, str(r.expiration_date)[:10], r.is_current) for r in spans] == [
        (1, "2024-03-01", 0), (1, "2024-04-01", 0), (1, "None", 1), (2, "None", 1)]


def test_scd2_opens_closes_and_is_repeatable(spark, rows):
    none = spark.createDataFrame(
        [], "id LONG, name STRING, effective_date DATE, expiration_date DATE, is_current INT"
    )
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id LONG, name STRING")
    second = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id LONG, name STRING")
    one = history.scd2(none, first, "id", ["name"], "2024-01-01")
    two = history.scd2(one, second, "id", ["name"], "2024-02-01")
    shown = sorted((r.id, r.name or "", str(r.effective_date), str(r.expiration_date), r.is_current) for r in two.collect())
    assert shown == [
        (1, "a", "2024-01-01", "None", 1),
        (2, "B", "2024-02-01", "None", 1),
        (2, "b", "2024-01-01", "2024-02-01", 0),
        (3, "", "2024-01-01", "None", 1),
        (4, "d", "2024-02-01", "None", 1),
    ]
    again = history.scd2(two, second, "id", ["name"], "2024-03-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, two.collect()))


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id INT, v STRING")
    assert rows(quality.duplicated_rows(df, "id"), "v") == [("a",), ("b",)]
    assert tuple(quality.duplicate_counts(df, "id").first()) == (3, 2, 1, 2)
    assert tuple(quality.duplicate_counts(df.limit(0), "id").first()) == (0, 0, 0, 0)


def test_slices_equal_a_whole_sort(spark):
    rng = random.Random(1)
    odd = [float("inf"), -float("inf"), float("nan"), 0.0, 1e-300]
    rows = [
        (None if rng.random() < 0.05 else rng.choice([*odd, rng.gauss(0, 1e5)]), None if rng.random() < 0.1 else "".join(rng.choice("aéZ") for _ in range(rng.randrange(9))), i)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "x DOUBLE, s STRING, i INT").withColumn("d", F.expr("date_add('2024-01-01', i % 40)"))
    for order, cuts in ((["x", "i"], [(0, 5), (150, 30), (390, 50)]), (["s", "i"], [(100, 30), (0, 400)]), (["d", "i"], [(77, 3), (5, 0)])):
        whole = [r.i for r in df.orderBy(*order).collect()]
        for offset, limit in cuts:
            got = [r.i for r in numbering.slice_rows(df, order, offset, limit).orderBy(*order).collect()]
            assert got == whole[offset : offset + limit], (order, offset)
    assert numbering.slice_rows(df.limit(0), ["x"], 0, 3).count() == 0
    assert numbering.slice_rows(df, ["i"], 1000, 3).count() == 0


def test_completeness_rule_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x DOUBLE")
    row = quality.run_checks({"t": df}, [quality.Complete("t", "x"), quality.Unique("t", "x")]).filter("check_name = 'completeness'").first()
    assert row.details["null_count"] == "2" and not row.passed
    assert quality.completeness(df, ["x"]).first().null_count == 2


def test_compiled_rules_on_empty_and_unmatched_tables(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k INT, v STRING")
    child = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k INT")
    rules = [quality.Unique("parent", "k"), quality.References("child", "k", "parent"), quality.MinRows("none", 1), quality.OneOf("parent", "v", ("a", "b"))]
    found = {r.check_name: r for r in quality.run_checks({"parent": parent, "child": child, "none": child.limit(0)}, rules).collect()}
    assert found["uniqueness"].details == {"total_records": "4", "unique_keys": "2", "duplicates": "2"}
    assert found["reference"].details == {"records": "4", "valid_references": "2", "orphaned_references": "1", "null_references": "1"}
    assert found["row_count"].details["actual_count"] == "0" and not found["row_count"].passed
    assert found["domain"].details["invalid"] == "1"


def test_snapshot_store_goes_by_its_manifest(spark, tmp_path, monkeypatch):
    store = snapshots.SnapshotStore(spark, str(tmp_path / "store"))
    assert store.list().count() == 0
    with pytest.raises(ValueError):
        store.as_of("2024-01-01")
    df = spark.range(10).withColumnRenamed("id", "x")
    store.write(df, "a", "2024-01-01 00:00:00")
    store.write(df.limit(4), "b", "2024-02-01 00:00:00")
    assert {(r.snapshot_id, r.records_count) for r in store.list().collect()} == {("a", 10), ("b", 4)}
    before = store.read("a")
    store.write(df.limit(7), "a", "2024-01-01 00:00:00")  # replaced; who reads the former folder still can
    assert store.read("a").count() == 7 and before.count() == 10
    assert store.as_of("2024-01-15").count() == 7 and store.as_of("2024-02-01 00:00:00").count() == 4
    assert len(store.as_of("2024-02-02").inputFiles()) == store.list().filter("snapshot_id = 'b'").first().files

    def broken(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "run_time", broken)
        with pytest.raises(OSError):
            store.write(df, "c", "2024-03-01 00:00:00")
    assert {r.snapshot_id for r in store.list().collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        store.read("c")
