"""Dedup, versions and slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.keys import hash_diff


def dedup_first(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``; remaining columns break ties.

    A minimum over (order, rest) structs, not a numbered window: every map task
    keeps one row per key, so a key with a third of all rows shuffles one row
    per task.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [c for c in order if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    if not order and not rest:
        return df.select(*key).distinct()
    first = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*[F.col(c) if c in key else F.col("_first")[c].alias(c) for c in df.columns])


def latest_version(df: DataFrame, key: Sequence[str] | str, by: str) -> DataFrame:
    """The newest row per key, also as a map-side combined aggregate."""
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in key and c != by]
    last = df.groupBy(*key).agg(F.max(F.struct(by, *rest)).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col("_last")[c].alias(c) for c in df.columns])


def neighbour_value(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, name: str, bucket: Column, ahead: bool = False
) -> DataFrame:
    """lag(value) per key in ``order`` (lead with ``ahead``), split by time buckets.

    ``bucket`` must not decrease along ``order``. The row window runs inside
    (key, bucket), so a hot key is spread over its buckets; the edge value of
    each bucket is handed over by a second window that sees one row per bucket.
    """
    key = list(key)
    directed = [F.col(c).desc() if ahead else F.col(c).asc() for c in order]
    held = df.withColumn("_bucket", bucket)
    inner = Window.partitionBy(*key, "_bucket").orderBy(*directed)
    # Values travel in a struct, so that a null value differs from "no neighbour".
    inside = held.withColumns(
        {
            "_near": F.lag(F.struct(F.col(value).alias("v"))).over(inner),
            "_edge": F.row_number().over(inner) == 1,
        }
    )
    pick = F.min if ahead else F.max
    edges = held.groupBy(*key, "_bucket").agg(pick(F.struct(*order, F.col(value).alias("_v"))).alias("_e"))
    outer = Window.partitionBy(*key).orderBy(F.col("_bucket").desc() if ahead else F.col("_bucket").asc())
    carried = edges.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)],
        F.col("_bucket").alias("_kb"),
        F.lag(F.col("_e")["_v"]).over(outer).alias("_carry"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    joined = inside.join(carried, [*same, F.col("_bucket").eqNullSafe(F.col("_kb"))], "left")
    found = F.when(F.col("_edge"), F.col("_carry")).otherwise(F.col("_near")["v"])
    return joined.select(*df.columns, found.alias(name))


def changed_rows(df: DataFrame, key: Sequence[str] | str, by: str, bucket: Column | None = None) -> DataFrame:
    """Versions whose hash_diff differs from the one before them; the first version always stays."""
    key = [key] if isinstance(key, str) else list(key)
    bucket = F.date_trunc("month", F.col(by)) if bucket is None else bucket
    before = neighbour_value(df, key, [by, "hash_diff"], "hash_diff", "_before", bucket)
    return before.filter(~F.col("_before").eqNullSafe(F.col("hash_diff"))).drop("_before")


def version_history(df: DataFrame, key: Sequence[str] | str, by: str, value: str, previous: str) -> DataFrame:
    """All versions in order of key and load time, each with the value it replaced."""
    key = [key] if isinstance(key, str) else list(key)
    rows = neighbour_value(df, key, [by, "hash_diff"], value, previous, F.date_trunc("month", F.col(by)))
    return rows.orderBy(*key, by)


def validity(versions: DataFrame, key: Sequence[str] | str, by: str) -> DataFrame:
    """Turn a version list into SCD2 rows: effective_date, expiration_date, is_current."""
    key = [key] if isinstance(key, str) else list(key)
    rows = neighbour_value(versions, key, [by], by, "expiration_date", F.date_trunc("month", F.col(by)), ahead=True)
    return rows.withColumnRenamed(by, "effective_date").withColumn(
        "is_current", F.col("expiration_date").isNull().cast("int")
    )


def scd2(
    history: DataFrame, incoming: DataFrame, key: str, attributes: Sequence[str], effective: str | Column
) -> DataFrame:
    """Merge a new delivery into a type 2 dimension.

    ``history`` has key, attributes, effective_date, expiration_date and
    is_current. A changed key closes its current row and opens a new one; a new
    key opens one; unchanged and absent keys stay as they are. Both sides are
    unique on the key when they meet, so no key can be hot in the join.
    """
    day = F.lit(effective).cast("date") if isinstance(effective, str) else effective
    columns = [key, *attributes, "effective_date", "expiration_date", "is_current"]
    closed = history.filter(F.col("is_current") == 0).select(*columns)
    current = history.filter(F.col("is_current") == 1)
    fresh = dedup_first(incoming.select(key, *attributes), key, attributes)

    def side(df: DataFrame, name: str, extra: Sequence[str] = ()) -> DataFrame:
        return df.select(
            key, F.struct(*attributes, *extra).alias(name), hash_diff(df, attributes).alias(f"{name}_hash")
        )

    met = side(current, "old", ["effective_date"]).join(side(fresh, "new"), key, "full")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    opens = has_new & (~has_old | (F.col("old_hash") != F.col("new_hash")))

    def row(values: Column, start: Column, end: Column, is_current: int) -> Column:
        return F.struct(
            *[values[a].alias(a) for a in attributes],
            start.alias("effective_date"),
            end.alias("expiration_date"),
            F.lit(is_current).alias("is_current"),
        )

    never = F.lit(None).cast("date")
    kept = F.when(has_old & ~opens, row(F.col("old"), F.col("old")["effective_date"], never, 1))
    ended = F.when(has_old & opens, row(F.col("old"), F.col("old")["effective_date"], day, 0))
    opened = F.when(opens, row(F.col("new"), day, never, 1))
    rows = met.select(key, F.inline(F.filter(F.array(kept, ended, opened), lambda r: r.isNotNull())))
    return closed.unionByName(rows.select(*columns))
