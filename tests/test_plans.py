"""What the physical plans must and must not hold."""

import re

import pytest

from wellspring import registry
from wellspring.registry import bindings as b
from wellspring.registry.star_queries import Star
from wellspring.registry.vault_queries import Vault

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(mode)


def test_no_cross_join_anywhere(spark):
    for name in ["kpi_stats", "snapshot_compare", "anomaly_combined", "anomaly_sigma", "run_report", "dq_star",
                 "mart_well_performance", "column_summary"]:
        text = plan(registry.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_marts_stay_in_the_jvm(spark):
    for name in ["mart_well_performance", "well_analytics", "link_seismic_reading", "fact_sensor_reading", "sat_delta"]:
        text = plan(registry.QUERIES[name](spark, SF))
        assert not re.search(r"ArrowEvalPython|MapInPandas|BatchEvalPython|FlatMapGroups", text), name


def test_scan_prunes_columns_and_pushes_filters(spark):
    text = plan(registry.QUERIES["scan_parquet"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint,value:double>" in text
    assert "GreaterThan(value,20.0)" in text


def test_mart_aggregates_before_it_joins_names(spark):
    """The rows that meet the descriptive columns are already one per key pair."""
    s = Star(spark, SF)
    text = plan(s.well_mart, "simple")
    top = text.index("partial_count(reading_key")
    assert text.index("well_name") < top  # names are joined above (printed before) the first aggregation


def test_hot_keys_are_combined_before_the_shuffle(spark):
    for df in (Vault(spark, SF)["link_seismic_reading"], b_hub(spark)):
        text = plan(df, "simple")
        assert "partial_min" in text and "Window" not in text


def b_hub(spark):
    from wellspring.operators import vault

    return vault.build_hub(b.line_readings(spark, SF), "WELL", "well_id", None, b.LOADED_AT)


def test_satellite_is_a_single_pass(spark):
    text = plan(Vault(spark, SF)["sat_seismic_measurements"], "simple")
    assert "Exchange" not in text and "Join" not in text


def test_unpartitioned_windows_see_summaries_only(spark):
    """Windows without a partition column run over per-range counts, never over rows of a table."""
    for df in (Star(spark, SF).wells, Star(spark, SF).facts):
        for line in plan(df, "simple").splitlines():
            if "Window [" in line and not re.search(r"\], \[\w", line):
                assert "_rows#" in line, line


def test_statistics_come_in_as_subqueries(spark):
    text = plan(registry.QUERIES["anomaly_sigma"](spark, SF), "simple")
    main = text.split("Subquery subquery")[0]
    assert "Join" not in main and "Exchange" not in main


@pytest.mark.parametrize("name", ["fact_sensor_reading", "mart_well_performance"])
def test_only_bounded_tables_are_hinted_for_broadcast(spark, name):
    """With automatic broadcast off, the wells and sensors are joined by shuffle; calendar and sources still broadcast."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.QUERIES[name](spark, SF), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        if adaptive is not None:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)
    assert re.search(r"SortMergeJoin \[well_id", text)
    assert re.search(r"BroadcastHashJoin \[full_date", text) and re.search(r"BroadcastHashJoin \[source_format", text)


def test_bucketed_tables_join_without_a_shuffle(spark):
    """Also after an append, where a bucket has several files, and for tables registered anew over the files."""
    from wellspring.operators import vault
    from wellspring.registry.load_queries import _bucketed
    from wellspring.sources.buckets import open_bucketed

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        link, measures = _bucketed(spark, SF, 4).values()
        joined = vault.link_with_measurements(link, measures)
        text = plan(joined, "simple")
        assert "SortMergeJoin" in text and "Exchange" not in text
        files = {f.rsplit("/", 2)[-2] for f in link.inputFiles()}
        place = link.inputFiles()[0].rsplit("/", 1)[0]
        assert len(files) == 1 and len(link.inputFiles()) > 4
        again = open_bucketed(spark, "opened_link", place, link.schema, "link_hash_key", 4)
        text = plan(vault.link_with_measurements(again, measures), "simple")
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert again.count() == link.count() == link.select("link_hash_key").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE IF EXISTS opened_link")


def test_the_suite_scans_every_table_once(spark, tmp_path):
    from wellspring.operators import quality
    from wellspring.plans.jobs import write_vault

    places = write_vault(Vault(spark, SF).tables, str(tmp_path))
    stored = {n: spark.read.parquet(p) for n, p in places.items()}
    text = plan(quality.run_checks(stored, quality.vault_rules()), "simple")
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == len(stored)
    assert "Join" not in text


def test_link_and_measurements_are_shuffled_before_they_are_hashed(spark):
    """Three shuffles, of plain columns: the links' dedup, and both tables by key for the join or for their buckets."""
    from wellspring.registry.load_queries import _bucketed

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = registry.QUERIES["link_sat"](spark, SF)
        text = plan(joined, "simple")
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning(") == 3
        moved = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan(joined))
        assert len(moved) == 3 and "hash" not in " ".join(moved)
        assert sorted(joined.collect(), key=str) == sorted(_plain_link_sat(spark).collect(), key=str)
        assert all(f.endswith(".zstd.parquet") for t in _bucketed(spark, SF, 4).values() for f in t.inputFiles())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _plain_link_sat(spark):
    from wellspring.operators import vault

    v = Vault(spark, SF)
    return vault.link_with_measurements(v["link_seismic_reading"], v["sat_seismic_measurements"])


def test_rows_placed_by_key_are_the_same(spark):
    from wellspring.operators import vault

    rows = [(w, s, n, t, i % 3, float(i), 1, src) for i, (w, s, n, t, src) in enumerate(
        [(1, 1, 5, 1, "b"), (1, 1, 5, 1, "a"), (1, 1, 5, None, "a"), (1, 1, None, None, "c"), (None, None, None, None, "d"), (None, None, None, None, None)] * 3)]
    schema = "well_id long, survey_type_id long, sensor_id long, t int, trace_num int, depth_ft double, quality_flag int, record_source string"
    df = spark.createDataFrame(rows, schema).selectExpr("* except (t)", "timestamp_seconds(t) AS timestamp", "depth_ft AS amplitude")
    for name in ("build_link", "build_measurement_satellite"):
        build = getattr(vault, name)
        want = sorted(build(df, None, b.LOADED_AT).collect(), key=str)
        for place in (True, 3):
            assert sorted(build(df, None, b.LOADED_AT, place=place).collect(), key=str) == want and len(want) >= 5
