"""Data Vault, history and data quality over the given tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.keys import hash_diff
from wellspring.operators import history, joins, marts, quality, vault
from wellspring.plans.jobs import WarehouseInputs, run_warehouse, write_vault
from wellspring.registry import bindings as b
from wellspring.registry.checks import VAULT, day_text, key_sql, number_text, query, star_sql, vault_sql, versions_sql
from wellspring.session import scratch_path


@dataclass
class Vault:
    """The vault over one data folder; every table is a lazy DataFrame."""

    spark: SparkSession
    sf: str
    place: bool = False  # readings and links by their key, for a join of all of them

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return vault.build_vault(
            b.supplier_wells(self.spark, self.sf),
            b.survey_master(self.spark, self.sf),
            b.part_sensors(self.spark, self.sf),
            b.line_readings(self.spark, self.sf),
            b.LOADED_AT,
            place=self.place,
        )

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def good_wells(self) -> DataFrame:
        """Hub of the wells in credit only; links to the others are orphans."""
        good = b.supplier_wells(self.spark, self.sf).filter("location_long >= 0").select("well_id")
        return self["hub_well"].join(good, "well_id", "left_semi")

    @property
    def faulty(self) -> dict[str, DataFrame]:
        """The vault with that hub in place of the full one."""
        return {**self.tables, "hub_well": self.good_wells}


LINK, MEASURES = "link_seismic_reading", "sat_seismic_measurements"


@query("hub_well", vault_sql("SELECT * FROM hub_well"))
def hub_well(spark, sf):
    return Vault(spark, sf)["hub_well"]


@query("hub_survey", vault_sql("SELECT * FROM hub_survey"))
def hub_survey(spark, sf):
    return vault.build_hub(b.line_surveys(spark, sf), vault.SURVEY, "survey_type_id", "master_surveys", b.LOADED_AT)


@query("hub_sensor", vault_sql("SELECT * FROM hub_sensor"))
def hub_sensor(spark, sf):
    return Vault(spark, sf)["hub_sensor"]


@query(
    "hub_dedup",
    vault_sql(
        f"""SELECT {key_sql('WELL', 'well_id')} AS well_hash_key, well_id,
        TIMESTAMP '2025-01-01 00:00:00' AS load_timestamp, MIN(record_source) AS record_source
        FROM readings GROUP BY well_id"""
    ),
)
def hub_dedup(spark, sf):
    """The well hub from the readings themselves: many rows per well, first source kept."""
    return vault.build_hub(b.line_readings(spark, sf), vault.WELL, "well_id", None, b.LOADED_AT)


def _sat_sql(source: str, entity: str, key: str, master: str, texts: list[str]) -> str:
    return vault_sql(
        f"""SELECT *, {key_sql(entity, key)} AS {entity.lower()}_hash_key,
        TIMESTAMP '2025-01-01 00:00:00' AS load_timestamp, '{master}' AS record_source,
        md5(concat_ws('|', {', '.join(texts)})) AS hash_diff FROM {source}"""
    )


@query(
    "sat_well_details",
    _sat_sql(
        "wells", "WELL", "well_id", "master_wells",
        ["CAST(well_id AS VARCHAR)", "well_name", number_text("location_lat"), number_text("location_long"), "operator"],
    ),
)
def sat_well_details(spark, sf):
    return Vault(spark, sf)["sat_well_details"]


@query(
    "sat_survey_details",
    _sat_sql("surveys", "SURVEY", "survey_type_id", "master_surveys", ["CAST(survey_type_id AS VARCHAR)", "survey_type"]),
)
def sat_survey_details(spark, sf):
    return Vault(spark, sf)["sat_survey_details"]


@query(
    "sat_sensor_details",
    _sat_sql(
        "sensors", "SENSOR", "sensor_id", "master_sensors",
        ["CAST(sensor_id AS VARCHAR)", "sensor_type", "manufacturer"],
    ),
)
def sat_sensor_details(spark, sf):
    return Vault(spark, sf)["sat_sensor_details"]


@query(LINK, vault_sql("SELECT * FROM link"))
def link_seismic_reading(spark, sf):
    return Vault(spark, sf)[LINK]


@query(MEASURES, vault_sql("SELECT * FROM sat"))
def sat_seismic_measurements(spark, sf):
    return Vault(spark, sf)[MEASURES]


@query(
    "sat_hash_diff",
    vault_sql("SELECT link_hash_key, hash_diff, COUNT(*) AS copies FROM sat GROUP BY link_hash_key, hash_diff"),
)
def sat_hash_diff(spark, sf):
    return Vault(spark, sf)[MEASURES].groupBy("link_hash_key", "hash_diff").agg(F.count(F.lit(1)).alias("copies"))


@query("link_dedup", vault_sql("SELECT * FROM link"))
def link_dedup(spark, sf):
    """Every source delivered twice: the links are those of one delivery."""
    twice = vault.union_sources([*b.archive_and_legacy(spark, sf), *b.archive_and_legacy(spark, sf)])
    return vault.build_link(twice, None, b.LOADED_AT)


@query(
    "link_grain",
    vault_sql(
        f"""SELECT md5(concat_ws('|', 'READING', CAST(well_id AS VARCHAR), CAST(survey_type_id AS VARCHAR),
          COALESCE(CAST(sensor_id AS VARCHAR), 'NO_SENSOR'), strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f'),
          {number_text('depth_ft')})) AS link_hash_key, MIN(record_source) AS record_source
        FROM readings GROUP BY 1"""
    ),
)
def link_grain(spark, sf):
    """The link with the depth as an extra key part."""
    links = vault.build_link(b.line_readings(spark, sf), None, b.LOADED_AT, ["depth_ft"])
    return links.select("link_hash_key", "record_source")


@query("union_sources", vault_sql("SELECT * FROM readings"))
def union_sources(spark, sf):
    """Archive readings and sensor-less traces in one table."""
    return vault.union_sources(b.archive_and_legacy(spark, sf))


@query(
    "lineage",
    vault_sql("SELECT record_source, MIN(load_timestamp) AS first_load FROM sat GROUP BY record_source"),
)
def lineage(spark, sf):
    return vault.lineage(Vault(spark, sf)[MEASURES])


# --- reading the vault -----------------------------------------------------

@query(
    "hub_sat",
    vault_sql(
        f"""SELECT h.well_hash_key, h.well_id, w.well_name, w.location_lat, w.location_long, w.operator
        FROM hub_well h JOIN wells w ON {key_sql('WELL', 'w.well_id')} = h.well_hash_key"""
    ),
)
def hub_sat(spark, sf):
    v = Vault(spark, sf)
    return vault.hub_with_details(v["hub_well"], v["sat_well_details"], "well_hash_key")


@query(
    "link_sat",
    vault_sql(
        """SELECT l.*, s.well_id, s.survey_type_id, s.sensor_id, s."timestamp", s.depth_ft, s.amplitude,
        s.quality_flag, s.hash_diff FROM link l LEFT JOIN sat s USING (link_hash_key)"""
    ),
)
def link_sat(spark, sf):
    v = Vault(spark, sf, place=True)
    return vault.link_with_measurements(v[LINK], v[MEASURES])


@query(
    "link_traversal",
    vault_sql(
        f"""SELECT l.link_hash_key, l.well_hash_key, s.well_id, s.survey_type_id, s.sensor_id, s."timestamp",
        s.depth_ft, s.amplitude, s.quality_flag, s.hash_diff
        FROM link l JOIN sat s USING (link_hash_key)
        WHERE l.well_hash_key IN (SELECT {key_sql('WELL', 'well_id')} FROM wells WHERE operator = 'NATION_7')"""
    ),
)
def link_traversal(spark, sf):
    """Readings of one operator's wells."""
    v = Vault(spark, sf)
    wells = v["sat_well_details"].filter(F.col("operator") == "NATION_7")
    return vault.traverse(v[LINK], v[MEASURES], wells)


@query(
    "vault_denormalized",
    vault_sql(
        """SELECT link_hash_key, l.well_hash_key, l.sensor_hash_key, h.well_id, p.sensor_id, s.depth_ft, s.amplitude,
        s.quality_flag
        FROM link l JOIN hub_well h USING (well_hash_key) LEFT JOIN hub_sensor p USING (sensor_hash_key)
        JOIN sat s USING (link_hash_key)"""
    ),
)
def vault_denormalized(spark, sf):
    v = Vault(spark, sf)
    return vault.denormalise(v[LINK], v["hub_well"], v["hub_sensor"], v[MEASURES])


# --- versions --------------------------------------------------------------

def _versions(spark, sf) -> DataFrame:
    rows = b.well_versions(spark, sf)
    return rows.withColumn("hash_diff", hash_diff(rows, ["well_name", "operator"]))


@query(
    "sat_delta",
    versions_sql(
        """SELECT * EXCLUDE (p) FROM (SELECT *, lag(hash_diff) OVER (PARTITION BY well_id ORDER BY load_timestamp) AS p
        FROM versions) WHERE p IS NULL OR p <> hash_diff"""
    ),
)
def sat_delta(spark, sf):
    return history.changed_rows(_versions(spark, sf), "well_id", "load_timestamp")


@query(
    "sat_current",
    versions_sql(
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY load_timestamp DESC)
        AS rn FROM versions) WHERE rn = 1"""
    ),
)
def sat_current(spark, sf):
    return history.latest_version(_versions(spark, sf), "well_id", "load_timestamp")


@query(
    "version_history",
    versions_sql(
        """SELECT *, lag(operator) OVER (PARTITION BY well_id ORDER BY load_timestamp) AS previous_operator
        FROM versions ORDER BY well_id, load_timestamp"""
    ),
)
def version_history(spark, sf):
    return history.version_history(_versions(spark, sf), "well_id", "load_timestamp", "operator", "previous_operator")


@query(
    "scd2_well",
    """WITH v AS (SELECT c_custkey AS well_id, c_name AS well_name, c_mktsegment AS operator,
                         c_custkey % 7 = 0 AS moved FROM customer)
       SELECT well_id, well_name, operator, '2025-01-01' AS effective_date,
              CASE WHEN moved THEN '2025-02-01' END AS expiration_date, CASE WHEN moved THEN 0 ELSE 1 END AS is_current
       FROM v
       UNION ALL SELECT well_id, well_name, 'MOVED', '2025-02-01', NULL, 1 FROM v WHERE moved""",
)
def scd2_well(spark, sf):
    """First delivery into an empty dimension, second delivery merged on top."""
    deliveries = b.well_versions(spark, sf)

    def delivery(day: str) -> DataFrame:
        return deliveries.filter(F.col("load_timestamp") == F.lit(day).cast("timestamp_ntz")).drop("load_timestamp")

    empty = delivery(b.EFFECTIVE).limit(0).selectExpr(
        "well_id", "well_name", "operator", "CAST(NULL AS DATE) AS effective_date",
        "CAST(NULL AS DATE) AS expiration_date", "1 AS is_current",
    )
    first = history.scd2(empty, delivery(b.EFFECTIVE), "well_id", ["well_name", "operator"], b.EFFECTIVE)
    both = history.scd2(first, delivery(b.SECOND_DELIVERY), "well_id", ["well_name", "operator"], b.SECOND_DELIVERY)
    return day_text("effective_date", "expiration_date")(both)


@query(
    "scd2_validity",
    versions_sql(
        """, changed AS (SELECT * EXCLUDE (p) FROM (SELECT *, lag(hash_diff) OVER (PARTITION BY well_id
            ORDER BY load_timestamp) AS p FROM versions) WHERE p IS NULL OR p <> hash_diff),
        v AS (SELECT well_id, operator, load_timestamp AS effective_date,
              lead(load_timestamp) OVER (PARTITION BY well_id ORDER BY load_timestamp) AS expiration_date FROM changed)
        SELECT *, CASE WHEN expiration_date IS NULL THEN 1 ELSE 0 END AS is_current FROM v"""
    ),
)
def scd2_validity(spark, sf):
    """The same dimension straight from the full version list."""
    changed = history.changed_rows(_versions(spark, sf), "well_id", "load_timestamp")
    return history.validity(changed.select("well_id", "operator", "load_timestamp"), "well_id", "load_timestamp")


@query(
    "dim_refresh",
    """WITH known AS (SELECT c_custkey AS well_id, row_number() OVER (ORDER BY c_custkey) AS well_key FROM customer
                      WHERE c_acctbal >= 0),
       fresh AS (SELECT c_custkey AS well_id, row_number() OVER (ORDER BY c_custkey) + (SELECT COUNT(*) FROM known)
                 AS well_key FROM customer WHERE c_acctbal < 0)
       SELECT k.well_key, well_id, 'NEW' AS operator FROM (SELECT * FROM known UNION ALL SELECT * FROM fresh) k""",
)
def dim_refresh(spark, sf):
    """A type 1 reload keeps the surrogates of known wells and numbers the others on top."""
    from wellspring.operators.numbering import surrogate_key
    from wellspring.operators.star import refresh_dimension

    wells = b.customer_wells(spark, sf)
    known = surrogate_key(wells.filter("location_long >= 0").select("well_id", "operator"), "well_id", "well_key")
    incoming = wells.select("well_id", F.lit("NEW").alias("operator"), F.lit(None).cast("long").alias("well_key"))
    return refresh_dimension(known, incoming, "well_id", "well_key")


# --- data quality ----------------------------------------------------------

@query(
    "dq_orphans",
    vault_sql(
        """, pairs AS (
          SELECT 'link -> hub_well' AS relation, l.well_hash_key AS k, h.well_hash_key AS p FROM link l
            LEFT JOIN good_hub_well h ON h.well_hash_key = l.well_hash_key
          UNION ALL SELECT 'link -> hub_survey', l.survey_hash_key, h.survey_hash_key FROM link l
            LEFT JOIN hub_survey h ON h.survey_hash_key = l.survey_hash_key
          UNION ALL SELECT 'link -> hub_sensor', l.sensor_hash_key, h.sensor_hash_key FROM link l
            LEFT JOIN hub_sensor h ON h.sensor_hash_key = l.sensor_hash_key
          UNION ALL SELECT 'satellite -> link', s.link_hash_key, l.link_hash_key FROM sat s
            LEFT JOIN link l ON l.link_hash_key = s.link_hash_key)
        SELECT relation, COUNT(*) AS child_rows, COUNT(p) AS valid_references,
        COUNT(*) FILTER (WHERE p IS NULL AND k IS NOT NULL) AS orphaned_references,
        COUNT(*) - COUNT(k) AS null_references FROM pairs GROUP BY relation"""
    ),
)
def dq_orphans(spark, sf):
    v = Vault(spark, sf)
    t = v.faulty
    relations = [
        ("link -> hub_well", t[LINK], t["hub_well"], "well_hash_key"),
        ("link -> hub_survey", t[LINK], t["hub_survey"], "survey_hash_key"),
        ("link -> hub_sensor", t[LINK], t["hub_sensor"], "sensor_hash_key"),
        ("satellite -> link", t[MEASURES], t[LINK], "link_hash_key"),
    ]
    parts = [
        joins.reference_counts(child, parent, key).select(F.lit(name).alias("relation"), "*")
        for name, child, parent, key in relations
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "dq_orphan_rows",
    vault_sql(
        """SELECT link_hash_key, well_hash_key FROM link
        WHERE well_hash_key NOT IN (SELECT well_hash_key FROM good_hub_well)"""
    ),
)
def dq_orphan_rows(spark, sf):
    v = Vault(spark, sf)
    return joins.orphans(v[LINK], v.good_wells, "well_hash_key").select("link_hash_key", "well_hash_key")


def _duplicates_sql(name: str, key: str, source: str) -> str:
    return f"""SELECT '{name}' AS key_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows, COUNT(*) AS unique_keys,
        CAST(COALESCE(SUM(n), 0) AS BIGINT) - COUNT(*) AS duplicates,
        CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicated_rows
        FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {key})"""


_KEYS = [("hub_well", "well_hash_key"), ("hub_well", "well_id"), ("hub_survey", "survey_hash_key"),
         ("hub_survey", "survey_type_id"), ("hub_sensor", "sensor_hash_key"), ("hub_sensor", "sensor_id")]


@query(
    "dq_duplicates",
    vault_sql(
        " UNION ALL ".join(
            [_duplicates_sql(f"{t}.{k}", k, t) for t, k in _KEYS]
            + [_duplicates_sql("satellite.link_hash_key", "link_hash_key", "sat")]
        )
    ),
)
def dq_duplicates(spark, sf):
    """Hub keys are unique; the satellite holds several rows per link."""
    t = Vault(spark, sf).tables
    checked = [(f"{n}.{k}", t[n], k) for n, k in _KEYS] + [("satellite.link_hash_key", t[MEASURES], "link_hash_key")]
    parts = [quality.duplicate_counts(df, key).select(F.lit(n).alias("key_name"), "*") for n, df, key in checked]
    return reduce(DataFrame.unionByName, parts)


@query(
    "dq_duplicated_rows",
    vault_sql(
        """SELECT well_id, link_hash_key, hash_diff FROM sat
        WHERE link_hash_key IN (SELECT link_hash_key FROM sat GROUP BY 1 HAVING COUNT(*) > 1)"""
    ),
)
def dq_duplicated_rows(spark, sf):
    rows = Vault(spark, sf)[MEASURES].select("well_id", "link_hash_key", "hash_diff")
    return quality.duplicated_rows(rows, "link_hash_key")


def _complete_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({column}) AS null_count,
        ROUND(COUNT({column}) * 100.0::DOUBLE / COUNT(*), 2) AS completeness_pct FROM sat"""


_MEASURED = ["depth_ft", "amplitude", "quality_flag", "sensor_id"]


@query("dq_completeness", vault_sql(" UNION ALL ".join(_complete_sql(c) for c in _MEASURED)))
def dq_completeness(spark, sf):
    return quality.completeness(Vault(spark, sf)[MEASURES], _MEASURED)


@query(
    "dq_metadata",
    vault_sql(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS table_name, '' AS missing_columns, COUNT(*) AS total_rows,
            COUNT(*) - COUNT(load_timestamp) AS null_load_timestamp, COUNT(*) - COUNT(record_source) AS null_record_source
            FROM {src}"""
            for n, src in [("hub_well", "hub_well"), ("hub_survey", "hub_survey"), ("hub_sensor", "hub_sensor"),
                           (LINK, "link"), (MEASURES, "sat")]
        )
    ),
)
def dq_metadata(spark, sf):
    """Audit columns are there, and filled."""
    t = Vault(spark, sf).tables
    parts = []
    for name in ["hub_well", "hub_survey", "hub_sensor", LINK, MEASURES]:
        lacking = quality.missing_columns(t[name], vault.AUDIT_COLUMNS)
        parts.append(
            t[name].agg(
                F.lit(name).alias("table_name"),
                F.lit(",".join(lacking)).alias("missing_columns"),
                F.count(F.lit(1)).alias("total_rows"),
                *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in vault.AUDIT_COLUMNS],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _rules_report(spark, sf, kinds) -> DataFrame:
    rules = [r for r in quality.vault_rules() + quality.domain_rules() if isinstance(r, kinds)]
    return quality.run_checks(Vault(spark, sf).faulty, rules)


def _detail(report: DataFrame, *keys: str) -> DataFrame:
    return report.select(
        "table_name", "column_name", "passed", *[F.col("details")[k].cast("long").alias(k) for k in keys]
    )


@query(
    "dq_row_counts",
    vault_sql(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS table_name, '' AS column_name, COUNT(*) >= {k} AS passed, {k} AS expected_minimum,
            COUNT(*) AS actual_count FROM {src}"""
            for n, src, k in [("hub_well", "good_hub_well", 1), ("hub_survey", "hub_survey", 3),
                              ("hub_sensor", "hub_sensor", 1), (LINK, "link", 100), (MEASURES, "sat", 100)]
        )
    ),
)
def dq_row_counts(spark, sf):
    return _detail(_rules_report(spark, sf, quality.MinRows), "expected_minimum", "actual_count")


@query(
    "dq_hash_format",
    vault_sql(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE NOT ok) = 0 AS passed,
            COUNT(*) AS total_records, COUNT(*) FILTER (WHERE NOT ok) AS invalid
            FROM (SELECT COALESCE(regexp_matches({c}, '^[a-f0-9]{{32}}$'), false) AS ok FROM {src})"""
            for n, c, src in [("hub_well", "well_hash_key", "good_hub_well"),
                              ("hub_survey", "survey_hash_key", "hub_survey"),
                              ("hub_sensor", "sensor_hash_key", "hub_sensor"), (LINK, "link_hash_key", "link")]
        )
    ),
)
def dq_hash_format(spark, sf):
    return _detail(_rules_report(spark, sf, quality.Matches), "total_records", "invalid")


@query(
    "dq_domain",
    vault_sql(
        f"""SELECT 'quality_flag' AS column_name, COUNT(*) AS total_records,
          COUNT(*) FILTER (WHERE quality_flag NOT IN (0, 1)) AS invalid, '{MEASURES}' AS table_name, true AS passed
          FROM sat
        UNION ALL SELECT 'load_timestamp', COUNT(*), COUNT(*) - COUNT(load_timestamp), '{MEASURES}', true FROM sat
        UNION ALL SELECT 'sensor_id', COUNT(*), COUNT(*) FILTER (WHERE record_source LIKE 'archive%' AND
          sensor_id IS NULL), '{MEASURES}', true FROM sat"""
    ),
)
def dq_domain(spark, sf):
    return _detail(_rules_report(spark, sf, (quality.OneOf, quality.Valid)), "total_records", "invalid")


@query(
    "dq_report",
    vault_sql(
        """SELECT 30 AS total_checks, 30 - n AS passed_checks, n AS failed_checks,
        (30 - n) * 100.0::DOUBLE / 30 AS success_pct
        FROM (SELECT CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END AS n FROM link
              WHERE well_hash_key NOT IN (SELECT well_hash_key FROM good_hub_well))"""
    ),
)
def dq_report(spark, sf):
    """All thirty checks of a vault whose well hub is incomplete."""
    return quality.success_rate(quality.run_checks(Vault(spark, sf).faulty, quality.vault_rules()))


@query(
    "dq_failed",
    vault_sql(
        f"""SELECT 'reference' AS check_name, '{LINK}' AS table_name, 'well_hash_key' AS column_name,
        COUNT(*) || ' rows without a match in hub_well' AS message
        FROM link WHERE well_hash_key NOT IN (SELECT well_hash_key FROM good_hub_well) HAVING COUNT(*) > 0"""
    ),
)
def dq_failed(spark, sf):
    report = quality.run_checks(Vault(spark, sf).faulty, quality.vault_rules())
    return quality.failed_checks(report).select("check_name", "table_name", "column_name", "message")


# --- whole jobs ------------------------------------------------------------

@query(
    "vault_summary",
    f"""WITH {VAULT}
    SELECT 'hub_well' AS table_name, COUNT(*) AS row_count FROM hub_well
    UNION ALL SELECT 'hub_survey', COUNT(*) FROM hub_survey
    UNION ALL SELECT 'hub_sensor', COUNT(*) FROM hub_sensor
    UNION ALL SELECT 'sat_well_details', COUNT(*) FROM wells
    UNION ALL SELECT 'sat_survey_details', COUNT(*) FROM surveys
    UNION ALL SELECT 'sat_sensor_details', COUNT(*) FROM sensors
    UNION ALL SELECT '{LINK}', COUNT(*) FROM link
    UNION ALL SELECT '{MEASURES}', COUNT(*) FROM sat""",
)
def vault_summary(spark, sf):
    """The vault built and written; row counts of the written tables."""
    places = write_vault(Vault(spark, sf).tables, scratch_path(spark, "vault"))
    return marts.table_counts({name: spark.read.parquet(place) for name, place in places.items()})


@query(
    "warehouse_summary",
    star_sql(
        """SELECT 'dim_time' AS table_name, COUNT(*) AS row_count FROM dim_time
        UNION ALL SELECT 'dim_data_source', COUNT(*) FROM dim_data_source
        UNION ALL SELECT 'dim_well', COUNT(*) FROM dim_well
        UNION ALL SELECT 'dim_sensor', COUNT(*) FROM dim_sensor
        UNION ALL SELECT 'fact_sensor_reading', COUNT(*) FROM fact
        UNION ALL SELECT 'fact_survey_event', COUNT(*) FROM survey_event
        UNION ALL SELECT 'mart_well_performance', COUNT(*) FROM well_mart
        UNION ALL SELECT 'mart_sensor_analysis', COUNT(*) FROM sensor_mart
        UNION ALL SELECT 'mart_survey_summary', COUNT(DISTINCT source_key) FROM survey_event"""
    ),
)
def warehouse_summary(spark, sf):
    inputs = WarehouseInputs(b.customer_wells(spark, sf), b.part_sensors(spark, sf), b.event_readings(spark, sf))
    return marts.table_counts(run_warehouse(spark, inputs, scratch_path(spark, "warehouse"), b.EFFECTIVE))
