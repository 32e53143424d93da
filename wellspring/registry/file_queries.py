"""Sources, sinks, repair, text patterns and incremental load.

The files these read are written by Spark from the given tables, into the
shared scratch folder of the session.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions import patterns as text
from wellspring.plans.jobs import run_daily
from wellspring.registry import bindings as b
from wellspring.registry import damage
from wellspring.registry.checks import query, r6, readings_sql, rounded, vault_sql
from wellspring.schemas import TRACE, conform
from wellspring.session import scratch_path
from wellspring.sources import files, ranges, repair, sinks, traces
from wellspring.streaming.incremental import incremental_load

# --- scans -----------------------------------------------------------------

_READINGS = "SELECT * FROM readings"


@query("scan_parquet", readings_sql("SELECT well_id, COUNT(*) AS n, MAX(amplitude) AS top FROM readings WHERE amplitude > 20 GROUP BY well_id"))
def scan_parquet(spark, sf):
    """Two columns and a filter reach the scan."""
    rows = files.read_table(spark, f"{sf.rstrip('/')}/events.parquet").filter(F.col("value") > 20)
    return rows.groupBy(F.col("user_id").alias("well_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )


@query(
    "scan_table",
    """SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT user_id) AS wells, MIN(value) AS low, MAX(value) AS high, MIN(ts) AS first, MAX(ts) AS last
    FROM events GROUP BY event_type""",
)
def scan_table(spark, sf):
    """The whole table: every row, without a filter."""
    rows = files.read_table(spark, f"{sf.rstrip('/')}/events.parquet")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("user_id").alias("wells"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
    )


@query(
    "scan_csv",
    """SELECT c_custkey AS well_id, c_name AS well_name, CAST(c_nationkey AS DOUBLE) AS location_lat,
       c_acctbal AS location_long, c_mktsegment AS operator FROM customer""",
)
def scan_csv(spark, sf):
    wells = b.customer_wells(spark, sf)
    path = scratch_path(spark, "wells-csv")
    sinks.to_csv(wells, path)
    return files.read_master(spark, path, wells.schema)


@query(
    "scan_dir_lineage",
    vault_sql("SELECT COUNT(*) AS readings, SUM(CAST(amplitude AS DECIMAL(18, 2)))::DOUBLE AS amplitude FROM readings"),
)
def scan_dir_lineage(spark, sf):
    """Rows whose source is a file of the folder, over all files."""
    path = scratch_path(spark, "readings-dir")
    b.line_readings(spark, sf).drop("record_source").repartition(b.parts_of(spark, sf, "lineitem", 4)).write.parquet(path)
    rows = files.read_dir(spark, path).filter(F.col("record_source").rlike(r"^part-.*\.parquet$"))
    return rows.agg(
        F.count(F.lit(1)).alias("readings"), F.sum(F.col("amplitude").cast("decimal(18,2)")).cast("double").alias("amplitude")
    )


# --- sinks -----------------------------------------------------------------

@query("sink_parquet", readings_sql(_READINGS))
def sink_parquet(spark, sf):
    path = scratch_path(spark, "table")
    sinks.write_table(b.event_readings(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "sink_partitioned",
    vault_sql(
        """SELECT year("timestamp") AS year, COUNT(*) AS readings, COUNT(sensor_id) AS with_sensor FROM readings
        WHERE year("timestamp") >= 2000 GROUP BY 1"""
    ),
)
def sink_partitioned(spark, sf):
    """Readings partitioned by year; the filter prunes folders."""
    path = scratch_path(spark, "by-year")
    sinks.write_table(b.line_readings(spark, sf).withColumn("year", F.year("timestamp")), path, ["year"])
    kept = spark.read.parquet(path).filter(F.col("year") >= 2000)
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("readings"), F.count("sensor_id").alias("with_sensor"))


@query("sink_partitioned_table", vault_sql("""SELECT *, year("timestamp") AS year FROM readings"""))
def sink_partitioned_table(spark, sf):
    """All rows and columns of the readings, written by year and read back."""
    path = scratch_path(spark, "by-year")
    sinks.write_table(b.line_readings(spark, sf).withColumn("year", F.year("timestamp")), path, ["year"])
    return spark.read.parquet(path)


@query(
    "sink_append_idempotent",
    """SELECT event_id AS reading_key, strftime(ts, '%Y-%m-%d') AS load_date, value AS amplitude FROM events""",
)
def sink_append_idempotent(spark, sf):
    """Two overlapping loads, the second one twice: every key is there once."""
    path = scratch_path(spark, "appended")
    rows = b.event_readings(spark, sf).select(
        "reading_key", F.date_format("timestamp", "yyyy-MM-dd").alias("load_date"), "amplitude"
    )
    key = ["load_date", "reading_key"]
    sinks.append_table(rows.filter("amplitude < 50"), path, key)
    sinks.append_table(rows, path, key)
    sinks.append_table(rows, path, key)
    return spark.read.schema(rows.schema).parquet(path)


@query("sink_csv", readings_sql(_READINGS))
def sink_csv(spark, sf):
    rows = b.event_readings(spark, sf)
    folder = scratch_path(spark, "marts-csv")
    sinks.export_marts({"readings": rows}, folder)
    return files.read_master(spark, f"{folder}/readings", rows.schema)


@query(
    "sink_json",
    readings_sql(
        """SELECT reading_key, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", depth_ft, amplitude
        FROM readings"""
    ),
)
def sink_json(spark, sf):
    rows = b.event_readings(spark, sf).select("reading_key", "timestamp", "depth_ft", "amplitude")
    path = sinks.to_json(rows, scratch_path(spark, "exports"), "readings", b.EFFECTIVE)
    shown = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType) for f in rows.schema]
    )
    return spark.read.schema(shown).json(path)


@query(
    "run_daily",
    readings_sql(
        """, stats AS (SELECT AVG(amplitude) AS m, STDDEV_SAMP(amplitude) AS s FROM readings)
        SELECT 'run-1' AS pipeline_run, (SELECT COUNT(*) FROM readings) AS extract_measurements,
        (SELECT COUNT(*) FROM customer) AS extract_wells, COUNT(DISTINCT well_id) AS transform_wells_processed,
        COUNT(*) FILTER (WHERE amplitude < m - 2 * s OR amplitude > m + 2 * s) AS transform_anomalies_found,
        COUNT(DISTINCT well_id) AS load_postgresql, (SELECT COUNT(*) FROM readings) AS load_mongodb
        FROM readings, stats"""
    ),
)
def daily(spark, sf):
    """The whole daily job with its file targets, and its report."""
    report = run_daily(
        b.event_readings(spark, sf), b.customer_wells(spark, sf), scratch_path(spark, "daily"), "run-1", b.LOADED_AT,
        ["reading_key"],
    )
    return sinks.flat(report).drop("execution_time", "load_json")


# --- trace files -----------------------------------------------------------

def _trace_files(spark, sf, layout: str = traces.LAYOUT) -> str:
    """All readings of lineitem as trace files; returns their folder."""
    path = scratch_path(spark, "traces")
    rows = b.line_readings(spark, sf).withColumn("frequency", F.col("depth_ft") / 2)
    written = traces.write_sgx(rows, path, layout)
    written.write.format("noop").mode("overwrite").save()
    return path


_TRACES = """SELECT well_id, survey_type_id, CAST(CAST(depth_ft AS FLOAT) AS DOUBLE) AS depth_ft,
    CAST(CAST(amplitude AS FLOAT) AS DOUBLE) AS amplitude, quality_flag FROM readings"""


@query("sgx_ingest", vault_sql(_TRACES))
def sgx_ingest(spark, sf):
    """Readings written to the legacy format and read back, in record ranges of 64 KiB."""
    rows = traces.read_sgx(spark, _trace_files(spark, sf), task_bytes=1 << 16)
    return rows.select("well_id", "survey_type_id", "depth_ft", "amplitude", "quality_flag")


@query(
    "sgx_layout",
    vault_sql(
        """SELECT well_id, survey_type_id, CAST(CAST(depth_ft AS FLOAT) AS DOUBLE) AS depth_ft,
        CAST(CAST(amplitude AS FLOAT) AS DOUBLE) AS amplitude, CAST(CAST(depth_ft / 2 AS FLOAT) AS DOUBLE) AS frequency,
        quality_flag FROM readings"""
    ),
)
def sgx_layout(spark, sf):
    """The extended record with one more float field."""
    path = _trace_files(spark, sf, traces.EXTENDED_LAYOUT)
    rows = traces.read_sgx(spark, path, layout=traces.EXTENDED_LAYOUT)
    return rows.select("well_id", "survey_type_id", "depth_ft", "amplitude", "frequency", "quality_flag")


@query(
    "sgx_statistics",
    vault_sql(
        """SELECT survey_type_id, COUNT(*) AS traces, COUNT(DISTINCT well_id) AS wells,
        MIN(CAST(CAST(depth_ft AS FLOAT) AS DOUBLE)) AS min_depth, MAX(CAST(CAST(amplitude AS FLOAT) AS DOUBLE))
        AS max_amplitude FROM readings GROUP BY survey_type_id"""
    ),
)
def sgx_statistics(spark, sf):
    rows = conform(traces.read_sgx(spark, _trace_files(spark, sf)), TRACE)
    return rows.groupBy("survey_type_id").agg(
        F.count(F.lit(1)).alias("traces"),
        F.count_distinct("well_id").alias("wells"),
        F.min("depth_ft").alias("min_depth"),
        F.max("amplitude").alias("max_amplitude"),
    )


@query("sgx_ingest_errors")
def sgx_ingest_errors(spark, sf):
    """Sound files next to damaged copies of them: what is wrong with which, and what a salvage keeps."""
    path = _trace_files(spark, sf)
    damaged = scratch_path(spark, "traces-damaged")
    damage.damage_traces(spark, path, damaged).write.format("noop").mode("overwrite").save()
    headers = traces.sgx_headers(spark, damaged)
    kept = (
        traces.read_sgx(spark, damaged, on_error="salvage")
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("salvaged"))
    )
    return headers.join(kept, "source_file", "left").select(
        "source_file", "status", "error", "trace_count", "whole_traces", F.coalesce("salvaged", F.lit(0)).alias("salvaged")
    )


# --- damaged Parquet -------------------------------------------------------

def _damaged_readings(spark, sf) -> str:
    """lineitem as Parquet files, each damaged in one of the known ways; returns their folder."""
    whole = scratch_path(spark, "whole")
    # One file per four thousand rows or so at test size; file sizes follow the table.
    b.line_readings(spark, sf).repartition(8).write.parquet(whole)
    damaged = scratch_path(spark, "damaged")
    damage.damage_parquet(spark, whole, damaged).write.format("noop").mode("overwrite").save()
    return damaged


@query("parquet_repair", vault_sql(_READINGS))
def parquet_repair(spark, sf):
    """Hex text and trailing junk undone, all rows back."""
    rows, _ = repair.repair_parquet(spark, _damaged_readings(spark, sf), scratch_path(spark, "repaired"))
    return rows


@query("repair_manifest")
def repair_manifest(spark, sf):
    manifest = repair.repair_dir(spark, _damaged_readings(spark, sf), scratch_path(spark, "repaired"))
    return manifest.drop("path", "output")


@query("file_triage")
def file_triage(spark, sf):
    found = repair.classify_files(spark, _damaged_readings(spark, sf))
    return found.groupBy("status", "was_hex").agg(
        F.count(F.lit(1)).alias("files"), F.sum("original_size").alias("bytes"), F.sum("n_markers").alias("markers")
    )


@query(
    "triage_ranges",
    """SELECT doc_id % 4 AS form, COUNT(*) AS files, SUM(CASE WHEN doc_id % 4 IN (1, 3) THEN 1 ELSE 0 END)::BIGINT AS hex_files,
    SUM(2 + (length(text) - length(replace(text, 'PAR1', ''))) / 4 * CASE WHEN doc_id % 4 = 3 THEN 2 ELSE 1 END)::BIGINT AS markers,
    SUM(CASE WHEN doc_id % 4 = 3 THEN 8 + 2 * strlen(text) ELSE 8 + strlen(text) END)::BIGINT AS cut_at
    FROM documents WHERE text IS NOT NULL GROUP BY 1""",
)
def triage_ranges(spark, sf):
    """Every document as a raw file between two markers: as it is, as hex, with a tail, and as hex of twice the text; read in ranges of 700 bytes."""
    path = scratch_path(spark, "raw-files")
    body = F.concat(F.lit("PAR1"), F.col("text"), F.when(F.col("doc_id") % 4 == 3, F.col("text")).otherwise(""), F.lit("PAR1")).cast("binary")
    lined = F.regexp_replace(F.hex(body), "(.{64})", "$1\n").cast("binary")
    form = F.col("doc_id") % 4
    content = F.when(form.isin(1, 3), lined).when(form == 2, F.concat(body, F.lit("tail").cast("binary"))).otherwise(body)
    rows = b.table(spark, sf, "documents").filter("text IS NOT NULL")
    damage.write_files(rows.select(F.concat_ws("-", form, "doc_id").alias("name"), content.alias("content")), path).write.format("noop").mode("overwrite").save()
    found = ranges.triage_files(spark, path, "*", 700)
    form = F.regexp_extract("path", r"([0-3])-[0-9]+$", 1).cast("long").alias("form")
    return found.groupBy(form).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("was_hex").alias("hex_files"),
        F.sum("n_markers").alias("markers"),
        F.sum("cut_at").alias("cut_at"),
    )


# --- text ------------------------------------------------------------------

# Patterns looked for in the documents, after the published flag patterns.
EMAIL = r"\b[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]+"
LINK_PATTERN = r"https?://[A-Za-z0-9./_-]+"
NUMBER = r"\b[0-9][0-9][0-9]-[0-9]+"
DOCUMENT_PATTERNS = [*text.DEFAULT_PATTERNS, EMAIL, LINK_PATTERN, NUMBER]


def _pattern_sql(i: int, pattern: str) -> str:
    return f"SELECT doc_id, {i} AS pattern_no, regexp_extract(text, '{pattern}', 0) AS m, text FROM documents"


@query(
    "pattern_scan",
    f"""WITH hits AS ({' UNION ALL '.join(_pattern_sql(i, p) for i, p in enumerate(DOCUMENT_PATTERNS))})
    SELECT doc_id, MIN(pattern_no) AS pattern_no, m AS "match", MIN(strpos(text, m) - 1) AS "offset"
    FROM hits WHERE m <> '' GROUP BY doc_id, m""",
)
def pattern_scan(spark, sf):
    return text.extract_patterns(b.table(spark, sf, "documents"), "text", DOCUMENT_PATTERNS, keep=["doc_id"])


def _matches_sql(i: int, pattern: str) -> str:
    """All matches of one pattern: pieces between matches, their running lengths, and the matches themselves."""
    return f"""SELECT doc_id, {i} AS pattern_no, m AS "match",
        CAST(SUM(length(piece)) OVER w + coalesce(SUM(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{pattern}')) AS m,
                     unnest(regexp_split_to_array(text, '{pattern}')[:-2]) AS piece,
                     generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS i FROM documents)
        WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""


@query(
    "pattern_scan_all",
    f"""SELECT doc_id, MIN(pattern_no) AS pattern_no, "match", "offset"
    FROM ({' UNION ALL '.join(_matches_sql(i, p) for i, p in enumerate(DOCUMENT_PATTERNS))}) GROUP BY doc_id, "match", "offset\"""",
)
def pattern_scan_all(spark, sf):
    """Every match of every pattern in every document, with its place."""
    return text.extract_all(b.table(spark, sf, "documents"), "text", DOCUMENT_PATTERNS, keep=["doc_id"])


@query("pattern_scan_files")
def pattern_scan_files(spark, sf):
    """The same patterns in raw files: the documents written out as text files."""
    path = scratch_path(spark, "raw")
    b.table(spark, sf, "documents").select("text").repartition(8).write.text(path, lineSep="\n\n")
    return repair.scan_files_for_patterns(spark, path, "*.txt", DOCUMENT_PATTERNS)


@query(
    "scan_ranges",
    f"""SELECT doc_id, MIN(pattern_no) AS pattern_no, "match", octet_length(encode("before"))::BIGINT AS "offset"
    FROM (SELECT h.*, substr(text, 1, "offset") AS "before"
          FROM ({' UNION ALL '.join(_matches_sql(i, p) for i, p in enumerate(DOCUMENT_PATTERNS))}) h JOIN documents USING (doc_id))
    GROUP BY doc_id, "match", "before\"""",
)
def scan_ranges(spark, sf):
    """Every match in every document written as a file of its own, searched in ranges of 500 bytes."""
    path = scratch_path(spark, "raw-files")
    rows = b.table(spark, sf, "documents").filter("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("name"), F.col("text").cast("binary").alias("content"))
    damage.write_files(rows, path).write.format("noop").mode("overwrite").save()
    found = ranges.scan_files(spark, path, "*", DOCUMENT_PATTERNS, 500)
    return found.select(F.col("source_file").cast("long").alias("doc_id"), "pattern_no", "match", "offset")


MARKER = "the"


@query(
    "marker_positions",
    f"""WITH pieces AS (SELECT doc_id, unnest(string_split(text, '{MARKER}')) AS piece,
                         generate_subscripts(string_split(text, '{MARKER}'), 1) AS i FROM documents),
      ends AS (SELECT doc_id, i, SUM(length(piece) + {len(MARKER)}) OVER (PARTITION BY doc_id ORDER BY i)
               - {len(MARKER)} AS place, COUNT(*) OVER (PARTITION BY doc_id) AS n FROM pieces)
    SELECT doc_id, CAST(place AS BIGINT) AS position FROM ends WHERE i < n""",
)
def marker_positions(spark, sf):
    rows = b.table(spark, sf, "documents")
    return rows.select("doc_id", F.explode(text.marker_positions("text", MARKER)).alias("position"))


@query(
    "hex_share",
    f"""SELECT doc_id, {r6("length(regexp_replace(text, '[^0-9A-Fa-f]', '', 'g')) / length(text)::DOUBLE")} AS share
    FROM documents""",
)
def hex_share(spark, sf):
    rows = b.table(spark, sf, "documents").select("doc_id", text.hex_share("text").alias("share"))
    return rounded(rows, "share")


@query("hex_roundtrip", "SELECT doc_id, strlen(text) AS bytes, md5(text) AS digest FROM documents")
def hex_roundtrip(spark, sf):
    """Texts as hex with a break every 64 digits, decoded again."""
    broken = F.regexp_replace(F.hex(F.col("text").cast("binary")), "(.{64})", "$1\n")
    decoded = text.from_hex(broken)
    return b.table(spark, sf, "documents").select(
        "doc_id", F.length(decoded).cast("long").alias("bytes"), F.md5(decoded).alias("digest")
    )


# --- incremental load ------------------------------------------------------

@query(
    "incremental_load",
    vault_sql(
        """SELECT 'link' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT link_hash_key) AS keys FROM link
        UNION ALL SELECT 'satellite', COUNT(*), COUNT(DISTINCT link_hash_key)
        FROM sat"""
    ),
)
def incremental(spark, sf):
    """Two deliveries, the second repeating the first: the vault holds every link once and every measurement as often as it was made."""
    rows = b.line_readings(spark, sf)
    delivered = rows.drop("record_source")
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "increment")
    load = partial(
        incremental_load, spark, landing, delivered.schema, f"{base}/link", f"{base}/satellite", f"{base}/checkpoint",
        b.LOADED_AT,
    )
    delivered.filter(F.col("sensor_id").isNotNull()).write.parquet(f"{landing}/first")
    load().awaitTermination()
    delivered.write.parquet(f"{landing}/second")
    load().awaitTermination()

    def counted(name: str) -> DataFrame:
        return spark.read.parquet(f"{base}/{name}").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(F.unhex("link_hash_key")).alias("keys"),  # 16 bytes to shuffle, not 32
        )

    return counted("link").unionByName(counted("satellite"))
