"""Data-quality suite: rules as data, one aggregation per table, one report table."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions.scalars import nan_to_null, run_time
from wellspring.operators.vault import AUDIT_COLUMNS
from wellspring.schemas import missing_columns

# Fixed value: what a hash key looks like.
MD5_PATTERN = "^[a-f0-9]{32}$"


@dataclass(frozen=True)
class Unique:
    table: str
    column: str


@dataclass(frozen=True)
class Complete:
    table: str
    column: str
    minimum: float = 1.0


@dataclass(frozen=True)
class Matches:
    table: str
    column: str
    pattern: str = MD5_PATTERN


@dataclass(frozen=True)
class OneOf:
    table: str
    column: str
    allowed: tuple = (0, 1)


@dataclass(frozen=True)
class MinRows:
    table: str
    minimum: int


@dataclass(frozen=True)
class HasColumns:
    table: str
    columns: tuple = tuple(AUDIT_COLUMNS)


@dataclass(frozen=True)
class Valid:
    """Any row condition, given as a SQL expression; null counts as a failure."""

    table: str
    column: str
    condition: str


@dataclass(frozen=True)
class References:
    table: str
    column: str
    parent: str
    nullable: bool = False


Rule = Unique | Complete | Matches | OneOf | MinRows | HasColumns | Valid | References

HUBS = [("hub_well", "well_hash_key", "well_id"), ("hub_survey", "survey_hash_key", "survey_type_id"),
        ("hub_sensor", "sensor_hash_key", "sensor_id")]
VAULT_TABLES = ["hub_well", "hub_survey", "hub_sensor", "sat_well_details", "sat_survey_details",
                "sat_sensor_details", "link_seismic_reading", "sat_seismic_measurements"]


def vault_rules() -> list[Rule]:
    """The standard thirty checks of a built vault."""
    link, measures = "link_seismic_reading", "sat_seismic_measurements"
    rules: list[Rule] = [Unique(table, key) for table, key, _ in HUBS]
    rules += [Unique(table, business) for table, _, business in HUBS]
    rules += [References(link, key, table, nullable=table == "hub_sensor") for table, key, _ in HUBS]
    rules += [References(measures, "link_hash_key", link)]
    rules += [Complete(measures, c) for c in ("depth_ft", "amplitude", "quality_flag")]
    rules += [HasColumns(table) for table in VAULT_TABLES]
    # The least number of rows expected per table.
    least = {"hub_well": 1, "hub_survey": 3, "hub_sensor": 1, link: 100, measures: 100}
    rules += [MinRows(table, n) for table, n in least.items()]
    rules += [Matches(table, key) for table, key, _ in HUBS] + [Matches(link, "link_hash_key")]
    return rules


def domain_rules() -> list[Rule]:
    """Documented extra checks: flag domain, and a sensor wherever the source delivers sensors."""
    return [
        OneOf("sat_seismic_measurements", "quality_flag"),
        Valid("sat_seismic_measurements", "load_timestamp", "try_cast(load_timestamp AS timestamp_ntz) IS NOT NULL"),
        Valid("sat_seismic_measurements", "sensor_id", "record_source NOT LIKE 'archive%' OR sensor_id IS NOT NULL"),
    ]


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """All rules as rows: check_name, table_name, column_name, passed, message, details.

    The rules are compiled to one job that scans every table once. A row of a
    table becomes a row of counters for the table's own rules and one (family,
    key) row for every key that a rule compares; a family holds a parent's key
    and all that refer to it, with a counter per side. One grouping by family
    and key, shared by all tables and combined before the shuffle, answers
    uniqueness and references together; a hot key is one row a task.
    """
    wanted = _Counters()
    results = [_compiled(wanted, tables, rule) for rule in rules]
    return wanted.row(tables).select(F.inline(F.array(*results)))


class _Counters:
    """What the rules need counted, per table, and the names under which the counts come back."""

    def __init__(self):
        self.measures: dict[str, list[Column]] = defaultdict(list)  # table -> row conditions; the first is "any row"
        self.families: dict[tuple[str, str], list[tuple[str, str]]] = {}  # (parent, column) -> sides (table, column)

    def rows(self, table: str) -> Column:
        if not self.measures[table]:
            self.measures[table].append(F.lit(True))
        return _named(f"{table}.0")

    def count(self, table: str, condition: Column) -> Column:
        self.rows(table)
        self.measures[table].append(condition)
        return _named(f"{table}.{len(self.measures[table]) - 1}")

    def side(self, parent: str, column: str, table: str) -> str:
        """Prefix of the counts of ``table``'s rows by their key among those of ``parent``."""
        sides = self.families.setdefault((parent, column), [(parent, column)])
        if (table, column) not in sides:
            sides.append((table, column))
        return f"{parent}.{column}.{sides.index((table, column))}"

    def row(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """One row with all counts."""
        names = sorted({t for sides in self.families.values() for t, _ in sides} | set(self.measures))
        families = list(self.families)
        width = max([len(m) for m in self.measures.values()], default=0)
        sides = max([len(s) for s in self.families.values()], default=0)
        parts = [self._emitted(tables[name], name, names.index(name), families, width) for name in names]
        rows = reduce(DataFrame.union, parts)
        by_key = rows.groupBy("family", "key").agg(
            *[F.count_if(F.col("side") == j).alias(f"s{j}") for j in range(sides)],
            *[F.sum(f"m{i}").alias(f"m{i}") for i in range(width)],
        )
        known, held = F.col("key").isNotNull(), F.col("s0") > 0 if sides else F.lit(False)
        totals = []
        for j in range(sides):
            totals += [
                F.sum(f"s{j}").alias(f"rows{j}"),
                F.sum(F.when(known & held, F.col(f"s{j}"))).alias(f"valid{j}"),
                F.sum(F.when(~known, F.col(f"s{j}"))).alias(f"null{j}"),
            ]
        of_family = by_key.groupBy("family").agg(
            F.count_if(known & held).alias("keys"), *totals, *[F.sum(f"m{i}").alias(f"m{i}") for i in range(width)]
        )

        def at(family: int, column: str) -> Column:
            return F.coalesce(F.max(F.when(F.col("family") == family, F.col(column))), F.lit(0))

        out = []
        for f, key in enumerate(families):
            name = ".".join(key)
            out.append(at(f, "keys").alias(f"{name}.keys"))
            for j in range(len(self.families[key])):
                out += [at(f, f"{what}{j}").alias(f"{name}.{j}.{what}") for what in ("rows", "valid", "null")]
        for name, conditions in self.measures.items():
            out += [at(-1 - names.index(name), f"m{i}").alias(f"{name}.{i}") for i in range(len(conditions))]
        row = of_family.agg(*out)
        return row.toDF(*[c.replace(".", "/") for c in row.columns])

    def _emitted(self, df: DataFrame, name: str, number: int, families: list, width: int) -> DataFrame:
        none = F.lit(None).cast("long")
        rows = []
        own = self.measures.get(name, [])
        if own:
            counts = [F.coalesce(c.cast("long"), F.lit(0)) for c in own] + [none] * (width - len(own))
            rows.append((F.lit(-1 - number), F.lit(None).cast("string"), F.lit(None).cast("int"), counts))
        for f, key in enumerate(families):
            for j, (table, column) in enumerate(self.families[key]):
                if table == name:
                    rows.append((F.lit(f), F.col(column).cast("string"), F.lit(j), [none] * width))
        structs = [
            F.struct(f.alias("family"), k.alias("key"), s.alias("side"), *[c.alias(f"m{i}") for i, c in enumerate(m)])
            for f, k, s, m in rows
        ]
        return df.select(F.inline(F.array(*structs)))


def _result(check: str, table: str, column: str, passed: Column, message: Column, details: dict[str, Column]) -> Column:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        passed.alias("passed"),
        message.alias("message"),
        F.create_map(*pairs).alias("details"),
    )


def _found(count: Column, what: str) -> Column:
    return F.concat(count.cast("string"), F.lit(f" {what}"))


def _missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the column can hold it."""
    col = F.col(column)
    return col.isNull() | F.isnan(col) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else col.isNull()


def _named(path: str) -> Column:
    return F.col("`" + path.replace(".", "/") + "`")


def _compiled(wanted: _Counters, tables: Mapping[str, DataFrame], rule: Rule) -> Column:
    """The rule's result as an expression over the row of counts."""
    df, name = tables[rule.table], rule.table

    total = wanted.rows(name)
    if isinstance(rule, References):
        side = wanted.side(rule.parent, rule.column, name)
        rows, valid, null = (_named(f"{side}.{what}") for what in ("rows", "valid", "null"))
        orphaned = rows - valid - null
        bad = orphaned + (F.lit(0) if rule.nullable else null)
        return _result(
            "reference", name, rule.column, bad == 0, _found(bad, f"rows without a match in {rule.parent}"),
            {"records": rows, "valid_references": valid, "orphaned_references": orphaned, "null_references": null},
        )
    if isinstance(rule, Unique):
        wanted.side(name, rule.column, name)
        keys = _named(f"{name}.{rule.column}.keys")
        repeats = total - keys
        return _result("uniqueness", name, rule.column, repeats == 0, _found(repeats, "duplicate values"),
                       {"total_records": total, "unique_keys": keys, "duplicates": repeats})
    if isinstance(rule, Complete):
        nulls = wanted.count(name, _missing(df, rule.column))
        share = F.coalesce(F.try_divide(total - nulls, total), F.lit(1.0))
        return _result("completeness", name, rule.column, share >= rule.minimum, _found(nulls, "nulls"),
                       {"total_records": total, "null_count": nulls, "completeness_pct": F.round(share * 100, 2)})
    if isinstance(rule, (Matches, OneOf, Valid)):
        if isinstance(rule, Matches):
            check, good = "format", F.col(rule.column).rlike(rule.pattern)
        elif isinstance(rule, OneOf):
            check, good = "domain", F.col(rule.column).isin(*rule.allowed)
        else:
            check, good = "condition", F.expr(rule.condition)
        bad = wanted.count(name, ~F.coalesce(good, F.lit(False)))
        return _result(check, name, rule.column, bad == 0, _found(bad, "invalid values"),
                       {"total_records": total, "valid": total - bad, "invalid": bad})
    if isinstance(rule, MinRows):
        message = F.concat(total.cast("string"), F.lit(f" rows, at least {rule.minimum} wanted"))
        return _result("row_count", name, "", total >= rule.minimum, message,
                       {"expected_minimum": F.lit(rule.minimum), "actual_count": total})
    if isinstance(rule, HasColumns):
        lacking = missing_columns(df, list(rule.columns))
        return _result("columns", name, "", F.lit(not lacking), F.lit(f"{len(lacking)} required columns missing"),
                       {"required_columns": F.lit(",".join(rule.columns)), "missing_columns": F.lit(",".join(lacking))})
    raise TypeError(f"unknown rule {rule!r}")


def failed_checks(report: DataFrame) -> DataFrame:
    return report.filter(~F.col("passed"))


def success_rate(report: DataFrame) -> DataFrame:
    """One row: total, passed, failed and the success percentage."""
    total, good = F.count(F.lit(1)), F.count_if(F.col("passed"))
    return report.agg(
        total.alias("total_checks"),
        good.alias("passed_checks"),
        (total - good).alias("failed_checks"),
        F.coalesce(F.try_divide(good * 100.0, total), F.lit(0.0)).alias("success_pct"),
    )


class QualityGateError(RuntimeError):
    """A blocking check failed."""


def gate(report: DataFrame, blocking: Sequence[str] | None = None) -> None:
    """Raise if a check failed; ``blocking`` narrows it to some check names."""
    bad = failed_checks(report)
    if blocking is not None:
        bad = bad.filter(F.col("check_name").isin(list(blocking)))
    rows = bad.select("check_name", "table_name", "column_name", "message").collect()
    if rows:
        raise QualityGateError("; ".join(f"{r[0]} {r[1]}.{r[2]}: {r[3]}" for r in rows))


def append_run(report: DataFrame, path: str, run_at: str) -> None:
    """Add this run's success rate to the history kept at ``path``."""
    success_rate(report).withColumn("run_at", run_time(run_at)).write.mode("append").parquet(path)


def duplicated_rows(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once. Keys are counted first, then matched."""
    on = [key] if isinstance(key, str) else list(key)
    return df.join(duplicate_groups(df, on).select(*on), on, "left_semi")


def duplicate_groups(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    on = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def duplicate_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: total_rows, unique_keys, duplicates (rows minus keys), duplicated_rows (rows of repeated keys)."""
    on = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("unique_keys"),
            (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicated_rows"),
        )
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: total rows, nulls and the completeness percentage, in one pass."""
    df, total = nan_to_null(df), F.count(F.lit(1))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            total.alias("total_rows"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.round(F.try_divide(F.count(c) * 100.0, total), 2).alias("completeness_pct"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
