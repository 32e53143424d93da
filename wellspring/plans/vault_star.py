"""From a written vault to the star, load by load, with surrogates that last.

A run takes the satellite rows of the vault loads that the star has not seen.
Facts get their keys above the stored high-water mark, in ranges handed out per
task, so earlier facts are neither read nor renumbered. Wells and sensors keep
their surrogates; new ones go on top. A reading whose well is unknown waits
among the rejects, under its key, until a load brings the well. As in the vault, a load writes folders of
its own and becomes visible with its commit row; a run after a failure has the
same numbers and overwrites what was left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators import star
from wellspring.operators.history import latest_version
from wellspring.operators.numbering import hand_out_keys
from wellspring.plans.file_vault import LOAD, MEASURES, commit, last_commit, read_loads

COMMITS, NUMBER = "star_commits", "star_load"
FACTS, REJECTS = "fact_sensor_reading", "fact_rejects"


def _dimension(spark: SparkSession, root: str, name: str, load: int) -> DataFrame:
    """A dimension as load ``load`` left it; dimensions are rewritten whole with every load."""
    return spark.read.parquet(f"{root}/{name}/{NUMBER}={load}")


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Facts of all committed loads (with ``star_load``) and the dimensions of the last one."""
    root = root.rstrip("/")
    newest = last_commit(spark, root, COMMITS, NUMBER)
    if newest is None:
        return {}
    upto = newest[NUMBER]
    found = {n: _dimension(spark, root, n, upto) for n in ("dim_well", "dim_sensor", "dim_time", "dim_data_source")}
    found[FACTS] = spark.read.parquet(f"{root}/{FACTS}").filter(F.col(NUMBER) <= upto)
    found[REJECTS] = _dimension(spark, root, REJECTS, upto)
    return found


def _newest(spark: SparkSession, vault_root: str, name: str, key: str, upto: int) -> DataFrame | None:
    rows = read_loads(spark, vault_root, name, upto)
    return None if rows is None else latest_version(rows.drop("hash_diff", "load_timestamp", "record_source"), key, LOAD).drop(LOAD)


def _merged(existing: DataFrame | None, incoming: DataFrame, key: str, surrogate: str) -> DataFrame:
    if existing is None:
        return incoming
    # the first effective date of a known row stays
    begun = existing.select(key, F.col("effective_date").alias("_begun"))
    rows = incoming.drop(surrogate).join(begun, key, "left")
    rows = rows.withColumn("effective_date", F.coalesce("_begun", "effective_date")).drop("_begun")
    return star.refresh_dimension(existing, rows.select(*[c for c in existing.columns if c != surrogate]), key, surrogate)


def load_star(spark: SparkSession, vault_root: str, root: str, effective: str) -> int | None:
    """Take the vault's new loads into the star at ``root``; returns the star load's number, or None if there was nothing new."""
    root = root.rstrip("/")
    held = last_commit(spark, vault_root)
    if held is None:
        return None
    upto = held[LOAD]
    newest = last_commit(spark, root, COMMITS, NUMBER) or {NUMBER: 0, "vault_load": 0, "high_water": 0}
    if newest["vault_load"] >= upto:
        return None
    load = newest[NUMBER] + 1

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}/{NUMBER}={load}")
        return _dimension(spark, root, name, load)

    def before(name: str) -> DataFrame | None:
        return _dimension(spark, root, name, newest[NUMBER]) if newest[NUMBER] else None

    calendar = store("dim_time", star.dim_time(spark))
    sources = store("dim_data_source", star.dim_data_source(spark))
    dims = {}
    for name, build, hub, details, key, surrogate in (
        ("dim_well", star.dim_well, "hub_well", "sat_well_details", "well_id", "well_key"),
        ("dim_sensor", star.dim_sensor, "hub_sensor", "sat_sensor_details", "sensor_id", "sensor_key"),
    ):
        masters = _newest(spark, vault_root, details, key, upto)
        hubs = read_loads(spark, vault_root, hub, upto)
        ids = spark.createDataFrame([], f"{key} long") if hubs is None else hubs.select(key)
        rows = build(ids.limit(0) if masters is None else masters, ids, effective)
        dims[name] = store(name, _merged(before(name), rows, key, surrogate))
    readings = read_loads(spark, vault_root, MEASURES, upto, newest["vault_load"])
    if readings is None:
        readings = spark.createDataFrame([], "well_id long, sensor_id long, timestamp timestamp_ntz, depth_ft double, amplitude double, quality_flag long")
    fresh = hand_out_keys(readings.drop(LOAD, "hash_diff", "load_timestamp"), "reading_key", newest["high_water"])
    keyed = fresh.withColumn("source_format", _format_of(fresh))
    # readings that waited for their well keep the key they got then
    waiting = before(REJECTS)
    if waiting is not None:
        keyed = keyed.unionByName(waiting, allowMissingColumns=True)
    facts = star.fact_sensor_reading(keyed, dims["dim_well"], calendar, dims["dim_sensor"], sources)
    store(FACTS, facts)
    store(REJECTS, star.fact_rejects(keyed, dims["dim_well"]))
    done = fresh.agg(
        F.lit(upto).alias("vault_load"),
        F.coalesce(F.max("reading_key"), F.lit(newest["high_water"])).cast("long").alias("high_water"),
        F.count(F.lit(1)).alias("readings"),
    )
    commit(spark, root, done, load, COMMITS, NUMBER)
    return load


def _format_of(rows: DataFrame):
    """The source format by the extension of the file that a reading came from."""
    if "record_source" not in rows.columns:
        return F.lit(None).cast("string")
    found = F.lit(None).cast("string")
    for _, name, _, extension in star.DATA_SOURCES:
        found = F.when(F.lower("record_source").endswith(extension), name).otherwise(found)
    return found
