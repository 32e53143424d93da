"""From files to the vault: one job over master CSVs, the reading archive and trace files.

A ledger names every file that was ever taken: kind, path, length, time, status
and load. A run lists the folders through Spark's file index, takes the files
that the ledger does not hold, and adds what they bring to the eight tables. A
file that changed (length or time) counts as a new one; a damaged trace file is
entered as bad and read again only when it changes.

Every load writes its rows to a folder of its own in each table, then the
ledger, and last one commit row. Readers see committed loads only, and a run
after a failure has the same load number, so it overwrites what the failed one
left. No file is taken twice and none half.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from wellspring.operators import vault
from wellspring.plans.jobs import together
from wellspring.schemas import MASTER_SENSORS, MASTER_SURVEYS, MASTER_WELLS, VAULT_READING
from wellspring.sources import files, traces
from wellspring.sources.traces import LAYOUT

LOAD = "load_id"
COMMITS, LEDGER = "load_commits", "load_ledger"
HUBS = {"hub_well": "well_hash_key", "hub_survey": "survey_hash_key", "hub_sensor": "sensor_hash_key"}
DETAILS = {
    "sat_well_details": "well_hash_key",
    "sat_survey_details": "survey_hash_key",
    "sat_sensor_details": "sensor_hash_key",
}
LINK, MEASURES = "link_seismic_reading", "sat_seismic_measurements"
TABLES = [*HUBS, *DETAILS, LINK, MEASURES]
GLOBS = {"wells": "*.csv", "surveys": "*.csv", "sensors": "*.csv", "archive": "*.parquet", "traces": "*.sgx"}
MASTERS = {"wells": "hub_well", "surveys": "hub_survey", "sensors": "hub_sensor"}


@dataclass(frozen=True)
class Landing:
    """Where files arrive: a folder or file per kind; a kind may be absent."""

    wells: str | None = None
    surveys: str | None = None
    sensors: str | None = None
    archive: str | None = None
    traces: str | None = None
    layout: str = LAYOUT
    schemas: Mapping[str, T.StructType] = field(
        default_factory=lambda: {"wells": MASTER_WELLS, "surveys": MASTER_SURVEYS, "sensors": MASTER_SENSORS}
    )


# --- committed loads -------------------------------------------------------

def last_commit(spark: SparkSession, root: str, log: str = COMMITS, number: str = LOAD) -> dict | None:
    """The newest commit row of a table root, or None before the first."""
    try:
        commits = spark.read.parquet(f"{root.rstrip('/')}/{log}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    newest = commits.orderBy(F.desc(number)).first()
    return newest.asDict() if newest else None


def commit(spark: SparkSession, root: str, row: DataFrame, number: int, log: str = COMMITS, name: str = LOAD) -> None:
    """One row in one file: the load is visible with it, or not at all."""
    row.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{log}/{name}={number}")


def read_loads(spark: SparkSession, root: str, name: str, upto: int, above: int = 0) -> DataFrame | None:
    """Rows that loads ``above`` + 1 to ``upto`` brought; only their folders are read. None where the table has no load yet."""
    try:
        table = spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return table.filter((F.col(LOAD) > above) & (F.col(LOAD) <= upto))


def read_file_vault(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables as of the last commit, each with ``load_id``."""
    newest = last_commit(spark, root)
    upto = newest[LOAD] if newest else 0
    tables = {name: read_loads(spark, root, name, upto) for name in [*TABLES, LEDGER]}
    return {name: table for name, table in tables.items() if table is not None}


# --- listing ---------------------------------------------------------------

def list_landing(spark: SparkSession, landing: Landing) -> DataFrame:
    """(kind, path, length, modified) of all files of the landing."""
    found = []
    for kind, glob in GLOBS.items():
        place = getattr(landing, kind)
        if place is None:
            continue
        try:
            listed = files.list_sources(spark, place, glob)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(listed.select(F.lit(kind).alias("kind"), "path", "length", "modified"))
    if not found:
        return spark.createDataFrame([], "kind STRING, path STRING, length BIGINT, modified TIMESTAMP")
    return vault.union_sources(found)


def unseen_files(listing: DataFrame, ledger: DataFrame | None) -> DataFrame:
    if ledger is None:
        return listing
    return listing.join(ledger.select(*listing.columns), listing.columns, "left_anti")


def _paths(new: DataFrame, kind: str) -> list[str]:
    """Paths of one kind in this delivery, for a reader that plans with a file list."""
    return [r[0] for r in new.filter(F.col("kind") == kind).select("path").orderBy("path").collect()]


# --- the load --------------------------------------------------------------

def _readings(spark: SparkSession, landing: Landing, new: DataFrame, sound: DataFrame) -> DataFrame | None:
    parts = []
    if archive := _paths(new, "archive"):
        parts.append(spark.read.parquet(*archive).withColumn("record_source", F.col("_metadata.file_name")))
    if landing.traces:
        rows = traces.read_trace_files(sound, landing.layout)
        parts.append(rows.withColumnRenamed("source_file", "record_source"))
    if not parts:
        return None
    rows = vault.union_sources(parts)
    extra = [F.col(c) for c in rows.columns if c not in VAULT_READING.names]
    # every load has the declared columns in their declared types, whatever arrived
    declared = rows.withColumns(
        {f.name: (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType) for f in VAULT_READING}
    )
    return declared.select(*VAULT_READING.names, *extra)


def _changed_details(rows: DataFrame, held: DataFrame | None, key: str) -> DataFrame:
    """Rows that are no version of their key's newest load."""
    if held is None:
        return rows
    newest = held.groupBy(key).agg(F.max(LOAD).alias(LOAD))
    current = held.select(key, "hash_diff", LOAD).join(newest, [key, LOAD], "left_semi")
    return rows.join(current, [key, "hash_diff"], "left_anti")


def _new_keys(rows: DataFrame, held: DataFrame | None, key: str) -> DataFrame:
    return rows if held is None else rows.join(held.select(key), key, "left_anti")


def _tables(spark: SparkSession, landing: Landing, new: DataFrame, sound: DataFrame, root: str, upto: int, loaded_at: str) -> dict[str, DataFrame]:
    """What this delivery adds to each table; a table it has nothing for is left out."""
    out: dict[str, DataFrame] = {}

    def held(name: str) -> DataFrame | None:
        return read_loads(spark, root, name, upto) if upto else None

    for kind, (entity, business_key) in {
        "wells": (vault.WELL, "well_id"),
        "surveys": (vault.SURVEY, "survey_type_id"),
        "sensors": (vault.SENSOR, "sensor_id"),
    }.items():
        if not (paths := _paths(new, kind)):
            continue
        master = files.read_master(spark, paths, landing.schemas[kind])
        source = f"master_{kind}"
        hub = MASTERS[kind]
        details = hub.replace("hub", "sat") + "_details"
        rows = vault.build_hub(master, entity, business_key, source, loaded_at)
        out[hub] = _new_keys(rows, held(hub), HUBS[hub])
        rows = vault.build_satellite(master, entity, business_key, source, loaded_at)
        out[details] = _changed_details(rows, held(details), DETAILS[details])
    readings = _readings(spark, landing, new, sound)
    if readings is not None:
        out[LINK] = _new_keys(vault.build_link(readings, None, loaded_at), held(LINK), "link_hash_key")
        out[MEASURES] = vault.build_measurement_satellite(readings, None, loaded_at)
    return out


def load_files(spark: SparkSession, landing: Landing, root: str, loaded_at: str) -> int | None:
    """Take all unseen files of ``landing`` into the vault at ``root``; returns the load's number, or None if there was nothing new."""
    root = root.rstrip("/")
    newest = last_commit(spark, root)
    upto = newest[LOAD] if newest else 0
    load = upto + 1
    listing = list_landing(spark, landing)
    new = unseen_files(listing, read_loads(spark, root, LEDGER, upto) if upto else None)
    # The delivery is fixed by what is written here; files that arrive meanwhile wait for the next run.
    place = f"{root}/{LEDGER}/{LOAD}={load}"
    heads = traces.check_trace_files(new.filter(F.col("kind") == "traces"), landing.layout)
    entered = new.join(heads.select("path", "error"), "path", "left").select(
        "kind",
        "path",
        "length",
        "modified",
        F.when(F.col("error").isNull(), "loaded").otherwise("bad").alias("status"),
        "error",
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
    )
    entered.write.mode("overwrite").parquet(place)
    taken = spark.read.parquet(place)
    if taken.isEmpty():
        return None
    sound = taken.filter((F.col("kind") == "traces") & (F.col("status") == "loaded"))
    tables = _tables(spark, landing, taken, sound, root, upto, loaded_at)
    for name in TABLES:  # what a failed run of this load wrote to a table that this one has nothing for
        left = None if name in tables else read_loads(spark, root, name, load, upto)
        if left is not None and not left.isEmpty():
            tables[name] = spark.createDataFrame([], left.drop(LOAD).schema)
    together({n: lambda n=n: tables[n].write.mode("overwrite").parquet(f"{root}/{n}/{LOAD}={load}") for n in tables})
    counted = taken.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") == "bad").alias("bad_files"),
        F.sum("length").alias("bytes"),
    )
    commit(spark, root, counted.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz")), load)
    return load

