"""Exact, linearly interpolated quantiles per group, for groups of any size, as one lazy plan.

A radix selection. Equal values are folded to (group, value, count) first, with
the value in the shuffle key, so a hot group is spread over all tasks. Then the
wanted positions are found from the leading digits on: a histogram over values
rounded to 22 significant bits tells which cell holds a position, and only that
cell's values are looked at one by one. Rounding keeps the order, so the counts
below a cell are exact. A task sorts the cells of a group, at most 2**21 for
every power of two that its values span, and then the different values inside
a cell, which agree in their first six digits; both sorts can spill.

No group is measured beforehand and nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEADING_BITS = 22  # significant bits of the histogram
_LARGE = 2.0**900


def rounded_to(x: Column, bits: int) -> Column:
    """``x`` rounded to ``bits`` significant bits, by arithmetic that a task's generated code holds; keeps the order."""
    factor = F.lit(float(2 ** (53 - bits) + 1))

    def split(v: Column) -> Column:
        wide = v * factor
        return wide - (wide - v)

    small = F.lit(2.0**-200)
    scaled = split(x * small) / small  # where the product would overflow
    return F.when(F.abs(x) == float("inf"), x).when(F.abs(x) >= _LARGE, scaled).otherwise(split(x))


def group_quantiles(df: DataFrame, group: Sequence[str], column: str, shares: Sequence[float]) -> DataFrame:
    """One row per group with ``q``: array of the exact quantiles of ``column``. Null and NaN values are left out."""
    names = list(group)
    shares = [float(s) for s in shares]
    keys = [f"_k{i}" for i in range(len(names))] or ["_k0"]
    held = [F.col(c).alias(k) for c, k in zip(names, keys, strict=False)] if names else [F.lit(1).alias("_k0")]
    rows = df.select(*held, F.col(column).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    values = rows.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n"))
    values = values.withColumn("_coarse", rounded_to(F.col("_x"), LEADING_BITS))

    coarse = _with_below(values.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n")), keys, "_coarse")
    total = F.sum("_n").over(Window.partitionBy(*keys))
    coarse = coarse.withColumn("_total", total)
    # positions 2 * i and 2 * i + 1: the two values between which share i lies
    wanted = []
    for i, share in enumerate(shares):
        place = (F.col("_total") - 1) * F.lit(share)
        low = F.floor(place).cast("long")
        part = (place - low).cast("double")
        wanted.append(F.struct(F.lit(2 * i).alias("j"), low.alias("at"), part.alias("part")))
        wanted.append(F.struct(F.lit(2 * i + 1).alias("j"), F.least(low + 1, F.col("_total") - 1).alias("at"), part.alias("part")))
    inside = F.filter(F.array(*wanted), lambda w: (w["at"] >= F.col("_below")) & (w["at"] < F.col("_below") + F.col("_n")))
    found = coarse.withColumn("_w", F.explode(inside)).select(
        *keys, F.col("_coarse").alias("_cell"), F.col("_w.j").alias("_j"), (F.col("_w.at") - F.col("_below")).alias("_at"), F.col("_w.part").alias("_part")
    )
    found = _inside(values, found, keys)
    lows = [F.max(F.when(F.col("_j") == 2 * i, F.col("_cell"))) for i in range(len(shares))]
    highs = [F.max(F.when(F.col("_j") == 2 * i + 1, F.col("_cell"))) for i in range(len(shares))]
    parts = [F.max(F.when(F.col("_j") == 2 * i, F.col("_part"))) for i in range(len(shares))]
    between = [F.when((low == high) | (part == 0), low).otherwise(low + (high - low) * part) for low, high, part in zip(lows, highs, parts, strict=True)]
    result = found.groupBy(*keys).agg(F.array(*between).alias("q"))
    return result.select(*[F.col(k).alias(c) for c, k in zip(names, keys, strict=False)], "q")


def _with_below(cells: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Add the number of values below each cell."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("_below", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))


def _inside(values: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The value at every wanted position, among the values of the cell that holds it."""
    # one row per cell: few, whatever the table, so Spark can broadcast them to the values
    cells = found.groupBy(*[F.col(k).alias(f"_w{k}") for k in keys], "_cell").agg(
        F.collect_list(F.struct("_j", "_at", "_part")).alias("_wanted")
    )
    same = [F.col(f"_w{k}").eqNullSafe(F.col(k)) for k in keys]
    near = values.join(cells, [*same, F.col("_cell") == F.col("_coarse")])
    placed = _with_below(near, [*keys, "_coarse"], "_x")
    hit = F.filter("_wanted", lambda w: (w["_at"] >= F.col("_below")) & (w["_at"] < F.col("_below") + F.col("_n")))
    return placed.select(*keys, F.col("_x").alias("_cell"), F.explode(hit).alias("_w")).select(*keys, "_cell", "_w._j", "_w._part")
