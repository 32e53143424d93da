"""Key lookups, orphan tests and keyed merges."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def lookup_key(
    rows: DataFrame, dimension: DataFrame, on: str | Sequence[str], key: str, default: Any = None
) -> DataFrame:
    """Bring in ``key`` from a dimension that is unique on ``on``.

    Without a default the key is required and unmatched rows go (see
    ``rejects``); with one they stay and take it. The join side is left to
    Spark, which compares the dimension's size with its broadcast limit, and
    splits hot keys of a shuffled join.
    """
    on = _keys(on)
    side = dimension.select(*on, key)
    if default is None:
        return rows.join(side, on, "inner")
    return left_join(rows, side, on).withColumn(key, F.coalesce(F.col(key), F.lit(default)))


def left_join(rows: DataFrame, side: DataFrame, on: str | Sequence[str], spread: int = 1024) -> DataFrame:
    """A left join that does not send all rows without a key to one task.

    Null keys match nothing but hash alike, and a third of the readings may have
    no sensor. A second join column spreads them; it is 0 on both sides
    wherever there is a key.
    """
    on = _keys(on)
    others = [f.name for f in rows.schema if f.name not in on and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    # pmod(.., 1) is always 0, yet no constant that the optimizer would fold out of the join keys
    zero = F.pmod(F.xxhash64(*on), F.lit(1).cast("long"))
    salt = F.when(_all_present(on), zero).otherwise(F.pmod(F.xxhash64(*on, *others), F.lit(spread).cast("long")))
    joined = rows.withColumn("_spread", salt).join(side.withColumn("_spread", zero), [*on, "_spread"], "left")
    return joined.drop("_spread")


def rejects(rows: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows a required lookup drops."""
    on = _keys(on)
    return rows.join(dimension.select(*on), on, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str | Sequence[str], nullable: bool = False) -> DataFrame:
    """Child rows whose key no parent row has; null keys are left out where they are allowed."""
    on = _keys(key)
    if nullable:
        child = child.filter(_all_present(on))
    return child.join(parent.select(*on).distinct(), on, "left_anti")


def reference_counts(child: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: child_rows, valid_references, orphaned_references, null_references.

    Child rows are counted per key before anything is joined, so a key held by
    a third of all rows costs the join a single row.
    """
    on = _keys(key)
    per_key = child.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    matched = per_key.join(parent.select(*on).distinct().withColumn("_hit", F.lit(1)), on, "left")
    present = _all_present(on)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0))

    return matched.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("child_rows"),
        total(F.col("_hit").isNotNull()).alias("valid_references"),
        total(F.col("_hit").isNull() & present).alias("orphaned_references"),
        total(~present).alias("null_references"),
    )


def _all_present(columns: list[str]) -> Column:
    test = F.lit(True)
    for name in columns:
        test = test & F.col(name).isNotNull()
    return test


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``target`` plus the incoming rows with keys it does not have."""
    return target.unionByName(new_rows(target, incoming, key, order), allowMissingColumns=True)


def new_rows(target: DataFrame, incoming: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Incoming rows with keys the target lacks, one per key (the first in ``order``)."""
    from wellspring.operators.history import dedup_first

    on = _keys(key)
    once = dedup_first(incoming, on, order or [c for c in incoming.columns if c not in on])
    return once.join(target.select(*on), on, "left_anti").select(*incoming.columns)


def upsert(target: DataFrame, incoming: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``target`` with rows replaced on ``key`` by the incoming ones, and new keys added."""
    from wellspring.operators.history import dedup_first

    on = _keys(key)
    once = dedup_first(incoming, on, order or [c for c in incoming.columns if c not in on])
    kept = target.join(once.select(*on), on, "left_anti").select(*target.columns)
    return kept.unionByName(once, allowMissingColumns=True)


def flag_where_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str], changes: dict[str, Any]) -> DataFrame:
    """Set columns on the rows whose key is in ``keys``; other rows keep their values."""
    on = _keys(on)
    marked = left_join(df, keys.select(*on).distinct().withColumn("_in", F.lit(True)), on)
    set_to = {
        name: F.when(F.col("_in"), F.lit(value)).otherwise(F.col(name)) if name in df.columns
        else F.when(F.col("_in"), F.lit(value))
        for name, value in changes.items()
    }
    return marked.withColumns(set_to).select(*df.columns, *[c for c in changes if c not in df.columns])
