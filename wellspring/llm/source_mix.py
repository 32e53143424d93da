"""Mixing sources to target weights by entropy balancing.

Document rates w stay as close to 1 as the targets allow, in relative entropy,
under one token constraint a source: sum(w * size) = target. The solution is an
exponential tilt, w = min(3, exp(lambda * size)), and lambda maximises a concave
dual. Newton steps, kept inside a bracket, find it for all sources at once; a
step is one aggregation over (source, size) cells, which hold every document.
Rates are rounded to whole copies cell by cell along the sizes, so that a
source's words miss its target by less than one document, and then moved closer
cell by cell. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.store import staged
from wellspring.operators.numbering import number_rows

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3  # copies of a document, and a target in units of its source
TOLERANCE = 1e-7
STEPS = 100  # Newton steps at most; the bracket halves at least every other step
PART = 512  # documents of a cell that one task ranks together


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def source_key(source: str = "source") -> Column:
    """Sorts as the sources do by code point, null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t"))


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source, source_size, target) from (key, source, size): weights 1, 2, 3, repeating, none above MOST times its source."""
    sources = sizes.groupBy("key").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("source_size"))
    sources = staged(number_rows(sources, ["key"], "place").withColumn("weight", (F.col("place") - 1) % 3 + 1), "sources")
    most, weight = F.col("source_size") * MOST, F.col("weight")
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    unit, capped = (total or 0) / (weights or 1), -1
    while True:
        above = most < weight * unit
        n, fixed, free = sources.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, most).otherwise(0)), F.sum(F.when(above, 0).otherwise(weight))
        ).first()
        if n == capped or not free:
            break
        unit, capped = (total - fixed) / free, n
    return sources.select("key", "source", "source_size", F.least(most.cast("double"), weight * F.lit(float(unit))).alias("target"))


def tilts(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """(key, scale, tilt): the dual's solution for every source, for sizes in units of ``scale``; tilt is null where every rate is MOST."""
    at = goals.withColumns(
        {
            "scale": F.greatest(F.lit(1.0), F.col("source_size") / F.col("source_rows")),
            "tilt": F.when(F.col("target") < F.col("source_size") * MOST * (1 - TOLERANCE), 0.0),
            "low": F.lit(None).cast("double"),
            "high": F.lit(None).cast("double"),
            "done": F.col("target") >= F.col("source_size") * MOST * (1 - TOLERANCE),
        }
    )
    at = staged(at, "tilts")
    columns = at.columns
    for _ in range(STEPS):
        if at.filter("not done").isEmpty():
            break
        moving = cells.join(at.filter("not done"), "key").withColumn("x", F.col("size") / F.col("scale"))
        rate = rates("tilt", "x")
        slope = F.when(rate < MOST, F.col("rows") * F.col("size") * F.col("x") * rate).otherwise(0.0)
        sums = moving.groupBy("key").agg(F.sum(F.col("rows") * F.col("size") * rate).alias("words"), F.sum(slope).alias("slope"))
        miss = F.col("words") - F.col("target")
        low, high = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low")), F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), -miss / F.col("slope")))  # null slope of zero: all capped, go down
        newton = F.col("tilt") + F.coalesce(F.when(F.col("slope") > 0, step), F.when(miss > 0, -2.0).otherwise(2.0))
        inside = ~F.coalesce(newton <= low, F.lit(False)) & ~F.coalesce(newton >= high, F.lit(False))
        near = F.abs(miss) <= F.col("target") * TOLERANCE
        moved = at.join(sums, "key", "left").select(
            "key",
            "source",
            "source_size",
            "source_rows",
            "target",
            "scale",
            F.when(F.col("done") | near | (F.col("words").isNull()), F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            (F.col("done") | F.coalesce(near, F.lit(True))).alias("done"),
        )
        at = staged(moved.select(*columns), "tilts")
    return at


def rates(tilt: str, x: str) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(F.col(tilt) * F.col(x), F.lit(50.0))))


def mix_sources(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): size, source_size, target, rate, copies and taken = copies * size.

    Sources in order of code points, null last, weigh 1, 2, 3, repeating, and
    share all words; a target stops at 3 times its source and the excess goes to
    the others by weight. No document gets more than 3 copies. A null, empty or
    wordless text has size 0 and takes nothing. Repeated rows are mixed like any
    other. A source without words has target 0. Which documents of equal source
    and size get the odd copy depends on a hash of their id alone, so reruns
    agree. An empty table gives no rows. Other columns are not read.
    """
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words().alias("size"),
    )
    sizes = staged(sizes.withColumn("key", source_key()), "sizes")
    cells = staged(sizes.groupBy("key", "size").agg(F.count(F.lit(1)).alias("rows")), "cells")
    counts = cells.groupBy("key").agg(F.sum("rows").alias("source_rows"))
    solved = tilts(cells, targets(sizes).join(counts, "key"))

    cells = cells.join(solved, "key").withColumn("x", F.col("size") / F.col("scale")).withColumn(
        "rate", F.when(F.col("tilt").isNull(), float(MOST)).otherwise(rates("tilt", "x"))
    )
    along = Window.partitionBy("key").orderBy(F.desc("size"))
    upto = F.sum(F.col("rows") * F.col("rate")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("upto", F.round(upto, 6)).withColumn(
        "taken_copies", (F.floor(F.col("upto") + 0.5) - F.coalesce(F.floor(F.lag("upto").over(along) + 0.5), F.lit(0))).cast("long")
    )
    cells = cells.withColumn("taken_copies", F.greatest(F.lit(0), F.least("taken_copies", F.col("rows") * MOST)))
    whole = Window.partitionBy("key")
    for _ in range(4):  # each turn fills most of what is missing with the largest cell that fits
        missing = F.col("target") - F.sum(F.col("taken_copies") * F.col("size")).over(whole)
        cells = cells.withColumn("missing", missing)
        room = F.when(F.col("missing") > 0, F.col("rows") * MOST - F.col("taken_copies")).otherwise(F.col("taken_copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("missing")) & (room > 0)
        cells = cells.withColumn("picked", F.max(F.when(fits, F.col("size"))).over(whole))
        change = F.signum("missing").cast("long") * F.least(room, F.floor(F.abs("missing") / F.col("size")))
        cells = cells.withColumn("taken_copies", F.col("taken_copies") + F.when(F.col("size") == F.col("picked"), change).otherwise(0))
    cells = staged(cells.select("key", "size", "rows", "rate", "taken_copies", "source_size", "target"), "copies")

    parts = F.ceil(F.col("rows") / PART).cast("long")
    spread = sizes.join(cells, ["key", "size"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), parts))
    spread = staged(spread, "spread")
    here = spread.groupBy("key", "size", "part").agg(F.count(F.lit(1)).alias("here"))
    before = F.sum("here").over(Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    here = here.select("key", "size", "part", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    ranked = spread.withColumn("rank", rank).join(here, ["key", "size", "part"])
    each = F.floor(F.col("taken_copies") / F.col("rows"))
    more = (F.col("before") + F.col("rank") <= F.col("taken_copies") - each * F.col("rows")).cast("long")
    return ranked.withColumn("copies", (each + more).cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
