import hashlib
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wellspring.functions import (
    as_documents,
    extract_patterns,
    fill_defaults,
    from_hex,
    hash_diff,
    hash_key,
    hex_share,
    marker_positions,
    pct_change,
    quality_band,
    reading_key,
)
from wellspring.operators.anomaly import in_sample
from wellspring.schemas import DIM_WELL, conform, missing_columns


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_hash_key_is_md5_of_joined_parts(spark):
    df = spark.createDataFrame([(7,)], "well_id LONG")
    assert df.select(hash_key(df, "WELL", "well_id")).first()[0] == md5("WELL|7")


def test_hash_key_does_not_depend_on_the_number_type(spark):
    kinds = ["LONG", "INT", "DOUBLE", "FLOAT", "DECIMAL(10,2)"]
    df = spark.sql("SELECT " + ", ".join(f"CAST(20 AS {k}) AS c{i}" for i, k in enumerate(kinds)))
    found = {df.select(hash_key(df, "WELL", f"c{i}")).first()[0] for i in range(len(kinds))}
    assert found == {md5("WELL|20")}


def test_canonical_text_of_awkward_numbers(spark):
    df = spark.createDataFrame(
        [(0.0,), (-0.0,), (1e7,), (12345678.5,), (0.25,), (1e-5,), (float("nan"),), (1e30,), (None,)], "x DOUBLE"
    )
    from wellspring.functions import canonical_text

    texts = [r[0] for r in df.select(canonical_text(df, "x")).collect()]
    assert texts == ["0", "0", "10000000", "12345678.5", "0.25", "0.00001", "NaN", "1.0E30", ""]


def test_hash_diff_separates_values(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a STRING, b STRING")
    first, second = [r[0] for r in df.select(hash_diff(df, ["a", "b"])).collect()]
    assert first != second
    joined = [r[0] for r in df.select(hash_diff(df, ["a", "b"], separator="")).collect()]
    assert joined[0] == joined[1] == md5("123")


def test_reading_key_with_and_without_sensor(spark):
    df = spark.sql(
        """SELECT 1L AS well_id, 101L AS survey_type_id, CAST(NULL AS LONG) AS sensor_id,
        CAST(NULL AS TIMESTAMP_NTZ) AS timestamp, 5L AS trace_num
        UNION ALL SELECT 1L, 101L, 9L, TIMESTAMP_NTZ'2024-01-02 03:04:05', 5L"""
    )
    keys = [r[0] for r in df.select(reading_key(df)).collect()]
    assert keys == [md5("READING|1|101|NO_SENSOR|5"), md5("READING|1|101|9|2024-01-02 03:04:05.000000")]
    traces = df.select("well_id", "survey_type_id", "trace_num")
    assert traces.select(reading_key(traces)).first()[0] == md5("READING|1|101|NO_SENSOR|5")
    bare = df.select("well_id", "survey_type_id")
    assert bare.select(reading_key(bare)).first()[0] == md5("READING|1|101|NO_SENSOR|")


def test_pct_change_keeps_the_sign_and_guards_zero(spark):
    df = spark.createDataFrame([(10.0, 15.0), (-10.0, -15.0), (0.0, 3.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(pct_change(F.col("a"), F.col("b"))).collect()] == [50.0, 50.0, 0.0]


def test_quality_band_edges(spark):
    df = spark.createDataFrame([(0.95,), (0.9,), (0.7,), (0.69,), (None,)], "q DOUBLE")
    assert [r[0] for r in df.select(quality_band("q")).collect()] == ["good", "fair", "fair", "poor", None]


def test_documents_hold_no_nan_and_no_native_times(spark):
    df = spark.sql(
        """SELECT DOUBLE('NaN') AS x, 1.5D AS y, TIMESTAMP_NTZ'2024-01-02 03:04:05.678' AS t, DATE'2024-01-02' AS d,
        CAST(NULL AS TIMESTAMP_NTZ) AS missing"""
    )
    assert tuple(as_documents(df).first()) == (None, 1.5, "2024-01-02T03:04:05.678000", "2024-01-02", None)


def test_fill_defaults_passes_over_absent_columns(spark):
    df = spark.createDataFrame([(None, 1)], "name STRING, n INT")
    assert tuple(fill_defaults(df, {"name": "Unknown", "other": 3}).first()) == ("Unknown", 1)


def test_conform_adds_casts_and_orders(spark):
    df = spark.createDataFrame([("7", 1.5)], "well_id STRING, latitude FLOAT")
    out = conform(df, DIM_WELL, {"operator": "none", "is_current": 1})
    assert out.schema.fieldNames() == DIM_WELL.fieldNames()
    row = out.first()
    assert (row.well_id, row.latitude, row.operator, row.basin, row.is_current) == (7, 1.5, "none", None, 1)
    assert missing_columns(df, ["latitude", "z", "a"]) == ["z", "a"]


def test_patterns_first_match_offset_and_repeats(spark):
    df = spark.createDataFrame(
        [(1, "x FLAG{A_1} FLAG{B} flag{low}"), (2, "nothing"), (3, "CTF{same} CTF{same}"), (4, None)], "id INT, t STRING"
    )
    found = extract_patterns(df, "t", keep=["id"]).collect()
    assert [tuple(r) for r in found] == [(1, 0, "FLAG{A_1}", 2), (1, 1, "flag{low}", 20), (3, 2, "CTF{same}", 0)]
    twice = extract_patterns(df, "t", [r"CTF\{[^}]+\}", r"[A-Z]+\{same\}"], keep=["id"]).collect()
    assert [tuple(r) for r in twice] == [(3, 0, "CTF{same}", 0)]


def test_marker_positions_with_overlaps(spark):
    df = spark.createDataFrame([("aaaa",), ("PAR1xPAR1",), ("",), (None,)], "t STRING")
    assert [r[0] for r in df.select(marker_positions("t", "aa")).collect()] == [[0, 1, 2], [], [], None]
    assert [r[0] for r in df.select(marker_positions("t", "PAR1")).collect()] == [[], [0, 5], [], None]


def test_hex_helpers(spark):
    df = spark.createDataFrame([("50 41\n52 31", "xyzz"), ("zz", "AbZ9")], "h STRING, s STRING")
    found = df.select(from_hex("h"), hex_share("s"), hex_share("s", 2)).collect()
    assert bytes(found[0][0]) == b"PAR1" and found[1][0] is None
    assert [r[1] for r in found] == [0.0, 0.75] and found[1][2] == 1.0


def test_sample_is_repeatable_and_near_its_share(spark):
    df = spark.range(20_000)
    one = {r[0] for r in df.filter(in_sample("id", 0.1, 3)).collect()}
    two = {r[0] for r in df.repartition(7).filter(in_sample("id", 0.1, 3)).collect()}
    assert one == two and 1800 < len(one) < 2200
    assert df.filter(in_sample("id", 0.0)).count() == 0 and df.filter(in_sample("id", 1.0)).count() == 20_000


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(100, 105)), min_size=1, max_size=20), st.randoms())
def test_keys_do_not_depend_on_row_or_column_order(spark, pairs, rng: random.Random):
    df = spark.createDataFrame(pairs, "well_id LONG, survey_type_id LONG")
    shuffled = pairs[:]
    rng.shuffle(shuffled)
    other = spark.createDataFrame([(s, float(w)) for w, s in shuffled], "survey_type_id LONG, well_id DOUBLE")
    a = sorted(r[0] for r in df.select(reading_key(df)).collect())
    b = sorted(r[0] for r in other.select(reading_key(other)).collect())
    assert a == b
