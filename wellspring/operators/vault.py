"""Data Vault builders: hubs, satellites, the reading link and its measurements."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions.keys import hash_diff, hash_key, reading_key, reading_key_parts
from wellspring.functions.scalars import with_audit
from wellspring.operators.history import dedup_first
from wellspring.operators.joins import left_join

# Entity names that enter the hash keys.
WELL, SURVEY, SENSOR = "WELL", "SURVEY", "SENSOR"

AUDIT_COLUMNS = ["load_timestamp", "record_source"]
LINK_COLUMNS = ["well_hash_key", "survey_hash_key", "sensor_hash_key", "link_hash_key", *AUDIT_COLUMNS]


def _key_name(entity: str) -> str:
    return f"{entity.lower()}_hash_key"


def build_hub(df: DataFrame, entity: str, business_key: str, source: str | Column | None, loaded_at: str) -> DataFrame:
    """One row per business key, the first by record source.

    Repeats go before anything is hashed: the (key, source) pairs are few, also
    where the rows are all readings.
    """
    pairs = df.select(F.col(business_key), _as_column(df, source).alias("record_source")).distinct()
    first = dedup_first(pairs, business_key, ["record_source"])
    key = _key_name(entity)
    rows = with_audit(
        first.withColumn(key, hash_key(first, entity, business_key)), F.col("record_source"), loaded_at
    )
    return rows.select(key, business_key, *AUDIT_COLUMNS)


def build_satellite(
    df: DataFrame,
    entity: str,
    business_key: str,
    source: str | Column | None,
    loaded_at: str,
    attributes: Sequence[str] | None = None,
    separator: str = "|",
) -> DataFrame:
    """Every master column plus hash key, audit columns and hash_diff. No dedup."""
    key = _key_name(entity)
    columns = list(attributes) if attributes else [c for c in df.columns if c not in AUDIT_COLUMNS]
    if business_key not in columns:
        columns = [business_key, *columns]
    rows = df.withColumns(
        {key: hash_key(df, entity, business_key), "hash_diff": hash_diff(df, columns, separator)}
    )
    rows = with_audit(rows, _source(rows, source), loaded_at)
    return rows.select(*columns, key, *AUDIT_COLUMNS, "hash_diff")


def _source_column(df: DataFrame, source: str | Column) -> list[Column]:
    return [F.col("record_source")] if "record_source" in df.columns and source is None else []


def _as_column(df: DataFrame, source: str | Column | None) -> Column:
    source = _source(df, source)
    return F.lit(source) if isinstance(source, str) else source


def _source(df: DataFrame, source: str | Column | None) -> str | Column:
    """A given source, or the lineage column the rows already carry."""
    if source is not None:
        return source
    if "record_source" not in df.columns:
        raise ValueError("rows carry no record_source; name a source")
    return F.col("record_source")


def build_link(
    readings: DataFrame,
    source: str | Column | None,
    loaded_at: str,
    extra: Sequence[str] = (),
    carry: Sequence[str] = (),
    place: bool | int = False,
) -> DataFrame:
    """One link per reading key (well, survey, sensor or none, moment), first by record source.

    Rows are deduplicated on the plain key columns; only what is left is
    hashed. ``extra`` widens the grain, for instance by ``depth_ft``; ``carry``
    keeps columns that follow from the key, such as a partition column.
    ``place`` is as in ``placed``.
    """
    links = link_rows(readings, source, extra, carry, place)
    links = with_audit(links.withColumns(link_hashes(links)), F.col("record_source"), loaded_at)
    return links.select(*LINK_COLUMNS, *carry)


def placed(rows: DataFrame, extra: Sequence[str], place: bool | int) -> DataFrame:
    """Plain readings or links brought to the task of their ``link_hash_key``, in the usual number of tasks or ``place`` ones.

    What is hashed after that is not shuffled: a join on the key, or a write in
    as many buckets, finds both tables where they are. A key with very many
    readings stays in one task, which Spark's own shuffle for a join may split.
    """
    if not place:
        return rows
    key = reading_key(rows, extra)
    return rows.repartition(key) if place is True else rows.repartition(place, key)


def link_rows(
    readings: DataFrame, source: str | Column | None, extra: Sequence[str] = (), carry: Sequence[str] = (), place: bool | int = False, once: bool = True
) -> DataFrame:
    """The rows of ``build_link`` with their plain key columns and ``link_hash_key``; ``link_hashes`` has the others.

    Without ``once`` a key's rows are all there, for a target that takes the first of each.
    """
    parts = reading_key_parts(readings, extra)
    rows = readings.select(*parts, *carry, _as_column(readings, source).alias("record_source"))
    if "timestamp" in parts and "trace_num" in parts:
        # where there is a timestamp the trace number is no part of the key
        rows = rows.withColumn("trace_num", F.when(F.col("timestamp").isNull(), F.col("trace_num")))
    first = placed(dedup_first(rows, parts, ["record_source"]) if once else rows, extra, place)
    return first.withColumn("link_hash_key", reading_key(first, extra))


def link_hashes(links: DataFrame) -> dict[str, Column]:
    """Hash keys of the well, the survey and the sensor, if there is one."""
    sensor = F.lit(None).cast("string")
    if "sensor_id" in links.columns:
        sensor = F.when(F.col("sensor_id").isNotNull(), hash_key(links, SENSOR, "sensor_id"))
    return {
        "well_hash_key": hash_key(links, WELL, "well_id"),
        "survey_hash_key": hash_key(links, SURVEY, "survey_type_id"),
        "sensor_hash_key": sensor,
    }


def build_measurement_satellite(
    readings: DataFrame, source: str | Column | None, loaded_at: str, extra: Sequence[str] = (), place: bool | int = False
) -> DataFrame:
    """Every reading with its link key and a hash over depth, amplitude and quality. Keeps all rows. ``place`` is as in ``placed``."""
    rows = with_audit(placed(readings, extra, place), _source(readings, source), loaded_at)
    return rows.withColumns(measurement_hashes(rows, extra)).select(*measurement_columns(readings))


def measurement_hashes(readings: DataFrame, extra: Sequence[str] = ()) -> dict[str, Column]:
    """What ``build_measurement_satellite`` adds to plain readings."""
    return {
        "link_hash_key": reading_key(readings, extra),
        "hash_diff": hash_diff(readings, ["depth_ft", "amplitude", "quality_flag"]),
    }


def measurement_columns(readings: DataFrame) -> list[str]:
    columns = [c for c in readings.columns if c not in AUDIT_COLUMNS]
    return [*columns, "link_hash_key", *AUDIT_COLUMNS, "hash_diff"]


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Readings of differing schemas in one table; a column a source lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def build_vault(
    wells: DataFrame,
    surveys: DataFrame,
    sensors: DataFrame,
    readings: DataFrame,
    loaded_at: str,
    sources: Sequence[str] = ("master_wells", "master_surveys", "master_sensors"),
    place: bool | int = False,
) -> dict[str, DataFrame]:
    """All vault tables as lazy DataFrames. ``readings`` carry their own record_source. ``place`` is as in ``placed``."""
    return {
        "hub_well": build_hub(wells, WELL, "well_id", sources[0], loaded_at),
        "hub_survey": build_hub(surveys, SURVEY, "survey_type_id", sources[1], loaded_at),
        "hub_sensor": build_hub(sensors, SENSOR, "sensor_id", sources[2], loaded_at),
        "sat_well_details": build_satellite(wells, WELL, "well_id", sources[0], loaded_at),
        "sat_survey_details": build_satellite(surveys, SURVEY, "survey_type_id", sources[1], loaded_at),
        "sat_sensor_details": build_satellite(sensors, SENSOR, "sensor_id", sources[2], loaded_at),
        "link_seismic_reading": build_link(readings, None, loaded_at, place=place),
        "sat_seismic_measurements": build_measurement_satellite(readings, None, loaded_at, place=place),
    }


def hub_with_details(hub: DataFrame, satellite: DataFrame, key: str) -> DataFrame:
    """Hub rows with their descriptive columns."""
    keep = [c for c in satellite.columns if c not in hub.columns and c != "hash_diff"]
    return hub.select(key, *[c for c in hub.columns if c not in (key, *AUDIT_COLUMNS)]).join(
        satellite.select(key, *keep), key
    )


def link_with_measurements(link: DataFrame, satellite: DataFrame) -> DataFrame:
    """Every link, with its measurements where it has some."""
    keep = [c for c in satellite.columns if c not in link.columns or c == "link_hash_key"]
    return link.join(satellite.select(*keep), "link_hash_key", "left")


def traverse(link: DataFrame, satellite: DataFrame, wells: DataFrame) -> DataFrame:
    """Measurements of the wells in ``wells`` (well_hash_key), found through the link."""
    wanted = link.join(wells.select("well_hash_key"), "well_hash_key", "left_semi").select(
        "well_hash_key", "link_hash_key"
    )
    keep = [c for c in satellite.columns if c not in AUDIT_COLUMNS]
    return wanted.join(satellite.select(*keep), "link_hash_key")


def denormalise(link: DataFrame, hub_well: DataFrame, hub_sensor: DataFrame, satellite: DataFrame) -> DataFrame:
    """Readings with business keys; readings without a sensor keep a null sensor."""
    named = link.select("well_hash_key", "sensor_hash_key", "link_hash_key").join(
        hub_well.select("well_hash_key", "well_id"), "well_hash_key"
    )
    sensors = hub_sensor.select("sensor_hash_key", "sensor_id")
    return (
        left_join(named, sensors, "sensor_hash_key")
        .join(satellite.select("link_hash_key", "depth_ft", "amplitude", "quality_flag"), "link_hash_key")
    )


def lineage(table: DataFrame) -> DataFrame:
    """First load of every record source."""
    return table.groupBy("record_source").agg(F.min("load_timestamp").alias("first_load"))
