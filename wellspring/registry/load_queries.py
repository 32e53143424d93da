"""Jobs that run load by load: files to the vault, the vault to the star, trace files as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators import vault
from wellspring.plans import file_vault, vault_star
from wellspring.registry import bindings as b
from wellspring.registry import damage
from wellspring.registry.checks import MEASURE_HASH, READING_KEY, key_sql, number_text, query, vault_sql
from wellspring.session import scratch_path
from wellspring.sources import files, repair, sinks, traces
from wellspring.sources.buckets import write_vault_buckets
from wellspring.streaming.incremental import incremental_traces

FILE_TRACES = 4000
# an order in which no two trace rows of a survey tie
_ORDER = ["l_orderkey", "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate"]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").withColumn("delivery", F.when(F.col("l_orderkey") % 2 == 1, 1).otherwise(2))


def _archive(lines: DataFrame) -> DataFrame:
    return lines.filter("l_linestatus <> 'O'").select(
        F.col("l_suppkey").alias("well_id"),
        F.col("l_linenumber").cast("long").alias("survey_type_id"),
        F.col("l_partkey").alias("sensor_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("depth_ft"),
        F.col("l_extendedprice").alias("amplitude"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("quality_flag"),
    )


def _write_traces(lines: DataFrame, path: str) -> None:
    """The legacy rows as trace files, each survey in one order, ``FILE_TRACES`` a file."""
    rows = lines.filter("l_linestatus = 'O'").select(
        F.col("l_suppkey").alias("well_id"),
        F.col("l_linenumber").cast("long").alias("survey_type_id"),
        F.col("l_quantity").alias("depth_ft"),
        F.col("l_extendedprice").alias("amplitude"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("quality_flag"),
        *_ORDER,
    )
    ordered = rows.repartition(4, "survey_type_id").sortWithinPartitions("survey_type_id", *_ORDER)
    traces.write_sgx(ordered, path, file_traces=FILE_TRACES).write.format("noop").mode("overwrite").save()


def _deliver(spark: SparkSession, sf: str, root: str, delivery: int) -> None:
    """What arrives with a delivery: masters (some wells only with the second), archive Parquet and trace files."""
    lines = _lines(spark, sf).filter(F.col("delivery") == delivery)
    wells = b.supplier_wells(spark, sf)
    sinks.to_csv(wells.filter("well_id % 5 <> 0") if delivery == 1 else wells, f"{root}/wells/{delivery}")
    if delivery == 1:
        sinks.to_csv(b.survey_master(spark, sf), f"{root}/surveys/1")
        sinks.to_csv(b.part_sensors(spark, sf), f"{root}/sensors/1")
    _archive(lines).write.parquet(f"{root}/archive/{delivery}")
    _write_traces(lines, f"{root}/traces/{delivery}")


def _landing(spark: SparkSession, sf: str, root: str) -> file_vault.Landing:
    schemas = {
        "wells": b.supplier_wells(spark, sf).schema,
        "surveys": b.survey_master(spark, sf).schema,
        "sensors": b.part_sensors(spark, sf).schema,
    }
    return file_vault.Landing(*[f"{root}/{k}" for k in ("wells", "surveys", "sensors", "archive", "traces")], schemas=schemas)


_FLOAT = "CAST(CAST({} AS FLOAT) AS DOUBLE)"
DELIVERED = f"""
lines AS (
  SELECT *, CASE WHEN l_orderkey % 2 = 1 THEN 1 ELSE 2 END AS load_id FROM lineitem),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY load_id, l_linenumber ORDER BY {', '.join(_ORDER)}) - 1 AS place
  FROM lines WHERE l_linestatus = 'O'),
taken AS (
  SELECT l_suppkey AS well_id, CAST(l_linenumber AS BIGINT) AS survey_type_id, l_partkey AS sensor_id,
         l_shipdate AS "timestamp", CAST(NULL AS BIGINT) AS trace_num, l_quantity AS depth_ft,
         l_extendedprice AS amplitude, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS quality_flag,
         'archive' AS record_source, load_id
  FROM lines WHERE l_linestatus <> 'O'
  UNION ALL
  SELECT l_suppkey, CAST(l_linenumber AS BIGINT), NULL, NULL, place % {FILE_TRACES} + 1, {_FLOAT.format('l_quantity')},
         {_FLOAT.format('l_extendedprice')}, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END,
         'survey' || l_linenumber || '-' || lpad(CAST(place // {FILE_TRACES} + 1 AS VARCHAR), 5, '0') || '.sgx', load_id
  FROM placed),
measured AS (
  SELECT *, CASE WHEN trace_num IS NULL THEN {READING_KEY} ELSE
           md5(concat_ws('|', 'READING', CAST(well_id AS VARCHAR), CAST(survey_type_id AS VARCHAR), 'NO_SENSOR',
               CAST(trace_num AS VARCHAR))) END AS link_hash_key, {MEASURE_HASH} AS hash_diff
  FROM taken),
master_load AS (SELECT s_suppkey AS well_id, CASE WHEN s_suppkey % 5 <> 0 THEN 1 ELSE 2 END AS load_id FROM supplier)"""


def loads_sql(body: str) -> str:
    return f"{vault_sql('')},{DELIVERED}\n{body}"


def _rows_sql(table: str, source: str, key: str, other: str, load: str, record_source: str = "record_source", measures: str = "NULL, NULL", diff: str = "NULL") -> str:
    return (
        f"SELECT '{table}' AS table_name, {key} AS hash_key, {other} AS other, {record_source} AS record_source, "
        f"CAST({load} AS BIGINT) AS load_id, {measures.split(', ')[0]}::DOUBLE AS depth_ft, {measures.split(', ')[1]}::DOUBLE AS amplitude, "
        f"CAST({diff} AS VARCHAR) AS hash_diff FROM {source}"
    )


_SENSOR_KEY = key_sql("SENSOR", "sensor_id")
FILES_TO_VAULT = " UNION ALL ".join(
    [
        _rows_sql("hub_well", "hub_well JOIN master_load USING (well_id)", "well_hash_key", "CAST(well_id AS VARCHAR)", "load_id"),
        _rows_sql("hub_survey", "hub_survey", "survey_hash_key", "CAST(survey_type_id AS VARCHAR)", "1"),
        _rows_sql("hub_sensor", "hub_sensor", "sensor_hash_key", "CAST(sensor_id AS VARCHAR)", "1"),
        _rows_sql(
            "sat_well_details",
            "wells JOIN master_load USING (well_id)",
            key_sql("WELL", "well_id"),
            "well_name || operator",
            "load_id",
            "'master_wells'",
            diff=f"md5(concat_ws('|', CAST(well_id AS VARCHAR), well_name, {number_text('location_lat')}, {number_text('location_long')}, operator))",
        ),
        _rows_sql("sat_survey_details", "surveys", key_sql("SURVEY", "survey_type_id"), "survey_type", "1", "'master_surveys'",
                  diff="md5(concat_ws('|', CAST(survey_type_id AS VARCHAR), survey_type))"),
        _rows_sql("sat_sensor_details", "sensors", key_sql("SENSOR", "sensor_id"), "sensor_type || manufacturer", "1", "'master_sensors'",
                  diff="md5(concat_ws('|', CAST(sensor_id AS VARCHAR), sensor_type, manufacturer))"),
        _rows_sql(
            "link_seismic_reading",
            f"""(SELECT link_hash_key, min(load_id) AS load_id, min_by(record_source, (load_id, record_source)) AS record_source,
                {key_sql('WELL', 'any_value(well_id)')} || {key_sql('SURVEY', 'any_value(survey_type_id)')} ||
                CASE WHEN any_value(sensor_id) IS NULL THEN '-' ELSE {key_sql('SENSOR', 'any_value(sensor_id)')} END AS other
                FROM measured GROUP BY link_hash_key)""",
            "link_hash_key",
            "other",
            "load_id",
        ),
        _rows_sql(
            "sat_seismic_measurements",
            "measured",
            "link_hash_key",
            """concat_ws('|', well_id, survey_type_id, coalesce(CAST(sensor_id AS VARCHAR), '-'), coalesce(CAST(trace_num AS VARCHAR), '-'),
               coalesce(strftime("timestamp", '%Y-%m-%d %H:%M:%S'), '-'), quality_flag)""",
            "load_id",
            measures="depth_ft, amplitude",
            diff="CASE WHEN trace_num IS NULL THEN hash_diff END",
        ),
    ]
)


def _plain_source() -> F.Column:
    """Names of archive parts and the task number in trace file names depend on the writing job, not on the data."""
    source = F.col("record_source")
    return F.when(source.endswith(".parquet"), "archive").otherwise(F.regexp_replace(source, r"^(survey\d+)-\d+-", "$1-"))


def _vault_rows(tables: dict[str, DataFrame]) -> DataFrame:
    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("-"))

    moment = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("-"))
    parts = [text(c) for c in ("well_id", "survey_type_id", "sensor_id", "trace_num")]
    other = {
        "hub_well": ("well_hash_key", text("well_id")),
        "hub_survey": ("survey_hash_key", text("survey_type_id")),
        "hub_sensor": ("sensor_hash_key", text("sensor_id")),
        "sat_well_details": ("well_hash_key", F.concat("well_name", "operator")),
        "sat_survey_details": ("survey_hash_key", F.col("survey_type")),
        "sat_sensor_details": ("sensor_hash_key", F.concat("sensor_type", "manufacturer")),
        file_vault.LINK: ("link_hash_key", F.concat(*[text(f"{k}_hash_key") for k in ("well", "survey", "sensor")])),
        file_vault.MEASURES: ("link_hash_key", F.concat_ws("|", *parts, moment, text("quality_flag"))),
    }
    found = []
    for name, (key, shown) in other.items():
        rows = tables[name]
        measures = name == file_vault.MEASURES
        diff = F.col("hash_diff") if "hash_diff" in rows.columns else F.lit(None).cast("string")
        found.append(
            rows.select(
                F.lit(name).alias("table_name"),
                F.col(key).alias("hash_key"),
                shown.alias("other"),
                _plain_source().alias("record_source"),
                F.col("load_id").cast("long").alias("load_id"),
                *[(F.col(c) if measures else F.lit(None).cast("double")).alias(c) for c in ("depth_ft", "amplitude")],
                (F.when(F.col("trace_num").isNull(), diff) if measures else diff).alias("hash_diff"),
            )
        )
    return vault.union_sources(found)


@query("files_to_vault", loads_sql(FILES_TO_VAULT))
def files_to_vault(spark, sf):
    """Two deliveries of files, a run with nothing new between them and after: all rows of the eight tables."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "file-vault")
    for delivery in (1, 2):
        _deliver(spark, sf, landing, delivery)
        places = _landing(spark, sf, landing)
        for _ in range(2):
            file_vault.load_files(spark, places, root, b.LOADED_AT)
    return _vault_rows(file_vault.read_file_vault(spark, root))


@query(
    "vault_to_star",
    loads_sql(
        """, well_keys AS (SELECT well_id, load_id, row_number() OVER (ORDER BY load_id, well_id) AS well_key FROM master_load),
        sensor_keys AS (SELECT sensor_id, row_number() OVER (ORDER BY sensor_id) AS sensor_key FROM sensors),
        dated AS (SELECT *, coalesce("timestamp", TIMESTAMP '2024-01-01') AS moment FROM taken)
        SELECT CAST(greatest(t.load_id, w.load_id) AS BIGINT) AS star_load, CAST(t.load_id AS BIGINT) AS key_load, well_key,
          coalesce(sensor_key, 1) AS sensor_key, date_diff('day', DATE '1990-01-01', CAST(moment AS DATE)) + 1 AS time_key,
          CASE WHEN record_source = 'archive' THEN 3 ELSE 5 END AS source_key, moment AS "timestamp", depth_ft AS depth, amplitude,
          quality_flag, CASE WHEN abs(amplitude) > 50 THEN 1 ELSE 0 END AS is_anomaly, (SELECT count(*) FROM taken) AS distinct_keys
        FROM dated t JOIN well_keys w USING (well_id) LEFT JOIN sensor_keys USING (sensor_id)"""
    ),
)
def vault_to_star(spark, sf):
    """The same deliveries taken on to the star: keys of the first load stay, readings of a late well come with it."""
    landing, root, star_root = scratch_path(spark, "landing"), scratch_path(spark, "file-vault"), scratch_path(spark, "star")
    for delivery in (1, 2):
        _deliver(spark, sf, landing, delivery)
        file_vault.load_files(spark, _landing(spark, sf, landing), root, b.LOADED_AT)
        for _ in range(2):
            vault_star.load_star(spark, root, star_root, b.EFFECTIVE)
    found = vault_star.read_star(spark, star_root)
    first = spark.read.parquet(f"{star_root}/{vault_star.COMMITS}").filter("star_load = 1").select("high_water").scalar()
    facts = found[vault_star.FACTS]
    return facts.select(
        F.col("star_load").cast("long").alias("star_load"),
        F.when(F.col("reading_key") <= first, 1).otherwise(2).cast("long").alias("key_load"),
        "well_key", "sensor_key", "time_key", "source_key", "timestamp", "depth", "amplitude", "quality_flag", "is_anomaly",
        facts.agg(F.count_distinct("reading_key")).scalar().alias("distinct_keys"),
    )


@query(
    "incremental_traces",
    loads_sql(
        """SELECT 'link' AS table_name, link_hash_key, min(record_source) AS record_source, NULL::BIGINT AS trace_num, NULL::DOUBLE AS depth_ft,
        NULL::DOUBLE AS amplitude, NULL::INTEGER AS quality_flag, count(*) - count(*) + 1 AS n FROM measured WHERE trace_num IS NOT NULL
        GROUP BY link_hash_key
        UNION ALL
        SELECT 'satellite', link_hash_key, record_source, trace_num, depth_ft, amplitude, quality_flag, count(*)
        FROM measured WHERE trace_num IS NOT NULL GROUP BY ALL"""
    ),
)
def incremental_trace_files(spark, sf):
    """Trace files in three deliveries, one late and one with files that came before: links and all measurements."""
    ready, landing, base = (scratch_path(spark, n) for n in ("traces-ready", "traces-landing", "increment"))
    lines = _lines(spark, sf)
    _write_traces(lines.filter("delivery = 2"), f"{landing}/new")

    def load() -> None:
        incremental_traces(
            spark, landing, f"{base}/link", f"{base}/satellite", f"{base}/checkpoint", b.LOADED_AT, range_bytes=1 << 14
        ).awaitTermination()

    load()
    del ready
    _write_traces(lines.filter("delivery = 1"), f"{landing}/late")
    load()
    _write_traces(lines.filter("delivery = 1"), f"{landing}/again")
    load()

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{base}/{name}").withColumn("record_source", _plain_source())

    link = read("link").select(
        F.lit("link").alias("table_name"), "link_hash_key", "record_source",
        *[F.lit(None).cast(t).alias(c) for c, t in (("trace_num", "long"), ("depth_ft", "double"), ("amplitude", "double"), ("quality_flag", "int"))],
    )
    columns = ["table_name", "link_hash_key", "record_source", "trace_num", "depth_ft", "amplitude", "quality_flag"]
    satellite = read("satellite").withColumn("table_name", F.lit("satellite")).select(*columns)
    return link.union(satellite).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


# --- stored in buckets -----------------------------------------------------

_KEYS = {file_vault.LINK: "link_hash_key", file_vault.MEASURES: "link_hash_key"}


def _bucketed(spark: SparkSession, sf: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Link and measurements of two loads, the second appended to the first, in as many buckets as the readings ask for."""
    buckets = buckets or b.parts_of(spark, sf, "lineitem", 8)
    prefix, path = f"t{uuid.uuid4().hex[:12]}_", scratch_path(spark, "buckets")
    tables = vault.build_vault(
        b.supplier_wells(spark, sf), b.survey_master(spark, sf), b.part_sensors(spark, sf), b.line_readings(spark, sf), b.LOADED_AT,
        place=buckets,
    )
    early = F.col("link_hash_key") < "8"
    buckets_of = {}
    for part, append in ((early, False), (~early, True)):
        buckets_of = write_vault_buckets({n: tables[n].filter(part) for n in _KEYS}, _KEYS, prefix, path, buckets, append)
    return buckets_of


@query(
    "vault_bucketed",
    vault_sql(
        """SELECT l.*, s.well_id, s.survey_type_id, s.sensor_id, s."timestamp", s.depth_ft, s.amplitude,
        s.quality_flag, s.hash_diff FROM link l LEFT JOIN sat s USING (link_hash_key)"""
    ),
)
def vault_bucketed(spark, sf):
    """Every link with its measurements, from tables stored in buckets of their key."""
    stored = _bucketed(spark, sf)
    return vault.link_with_measurements(stored[file_vault.LINK], stored[file_vault.MEASURES])


# --- damaged files ---------------------------------------------------------

_RECORD = traces.record_dtype(traces.LAYOUT).itemsize
_HALF = f"least(n, ({_RECORD} * n // 2) // {_RECORD})"  # whole records of a file cut in its middle


@query(
    "trace_errors",
    loads_sql(
        f""", files AS (SELECT record_source, load_id, count(*) AS n FROM taken WHERE trace_num IS NOT NULL GROUP BY ALL),
        kinds AS (SELECT unnest(['none', 'magic', 'short', 'extra', 'header']) AS kind)
        SELECT kind, record_source, CASE WHEN kind IN ('none', 'extra') THEN 'ok' ELSE 'bad' END AS status,
          CASE WHEN kind IN ('magic', 'header') THEN 0 ELSE n END AS trace_count,
          CASE kind WHEN 'magic' THEN 0 WHEN 'header' THEN 0 WHEN 'short' THEN {_HALF} ELSE n END AS whole_traces,
          CASE kind WHEN 'magic' THEN 0 WHEN 'header' THEN 0 WHEN 'short' THEN {_HALF} ELSE n END AS salvaged,
          CASE WHEN kind IN ('none', 'extra') THEN n ELSE 0 END AS kept
        FROM files, kinds WHERE load_id = 1"""
    ),
)
def trace_errors(spark, sf):
    """Trace files with every kind of damage: the header's verdict, and what salvaging and skipping read keep."""
    path, damaged = scratch_path(spark, "traces"), scratch_path(spark, "traces-damaged")
    _write_traces(_lines(spark, sf).filter("delivery = 1"), path)
    damage.damage_traces(spark, path, damaged).write.format("noop").mode("overwrite").save()
    counts = [
        traces.read_sgx(spark, damaged, on_error=mode).groupBy("source_file").agg(F.count(F.lit(1)).alias(name))
        for mode, name in (("salvage", "salvaged"), ("skip", "kept"))
    ]
    found = traces.sgx_headers(spark, damaged)
    for count in counts:
        found = found.join(count, "source_file", "left")
    return found.withColumn("record_source", F.regexp_extract("source_file", "^[a-z]+-(.*)$", 1)).select(
        F.regexp_extract("source_file", "^([a-z]+)-", 1).alias("kind"),
        _plain_source().alias("record_source"),
        "status",
        "trace_count",
        "whole_traces",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("salvaged", "kept")],
    )


@query(
    "traces_of_surveys",
    loads_sql(
        """SELECT trace_num, well_id, survey_type_id, depth_ft, amplitude, quality_flag, record_source FROM taken
        WHERE trace_num IS NOT NULL AND survey_type_id IN (2, 5) AND load_id = 1"""
    ),
)
def traces_of_surveys(spark, sf):
    """Two surveys out of a folder of trace files, listed by Spark; of the other files only headers are read."""
    path = scratch_path(spark, "traces")
    _write_traces(_lines(spark, sf).filter("delivery = 1"), path)
    rows = traces.read_trace_files(files.list_sources(spark, path, "*.sgx"), range_bytes=1 << 14, surveys=[2, 5])
    rows = rows.withColumnRenamed("source_file", "record_source").withColumn("record_source", _plain_source())
    return rows.select("trace_num", "well_id", "survey_type_id", "depth_ft", "amplitude", "quality_flag", "record_source")


@query(
    "repair_kinds",
    """SELECT kind, kind IN ('hex', 'hex_and_trailing') AS was_hex, 'repaired' AS status, 8 AS files, count(*) AS rows,
    CASE WHEN kind IN ('trailing', 'hex_and_trailing') THEN 8 ELSE 0 END AS cut_files
    FROM lineitem, (SELECT unnest(['none', 'hex', 'trailing', 'hex_and_trailing']) AS kind) GROUP BY kind""",
)
def repair_kinds(spark, sf):
    """The repair log over all readings, each file with every kind of damage."""
    whole, damaged = scratch_path(spark, "whole"), scratch_path(spark, "damaged")
    b.line_readings(spark, sf).repartition(8).write.parquet(whole)
    damage.damage_parquet(spark, whole, damaged, every=True).write.format("noop").mode("overwrite").save()
    log = repair.repair_dir(spark, damaged, scratch_path(spark, "repaired"))
    kind = F.regexp_extract("path", "([a-z_]+)-part-[^/]*$", 1).alias("kind")
    return log.groupBy(kind, "was_hex", "status").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").alias("rows"),
        F.count_if(F.col("cut_at") < F.col("decoded_size")).alias("cut_files"),
    )
