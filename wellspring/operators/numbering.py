"""Dense numbering without a single-partition window.

Two forms. ``surrogate_key`` numbers a dimension lazily: approximate quantiles
of the key cut it into ranges, exact counts per range give the offsets, and a
window numbers the rows inside each range. ``number_rows`` numbers a large
table in any order: a range shuffle sorts it, each task counts its own rows,
and the per-task counts are summed up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.operators.quantiles import rounded_to
from wellspring.session import checkpointed

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row position below


def surrogate_key(
    df: DataFrame,
    key: str,
    name: str,
    start: Column | int = 0,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, ... in order of a unique numeric ``key``, above ``start``.

    The cut points only decide how rows are spread; offsets come from exact
    counts, so the numbers are right whatever the approximation returns. There
    are as many ranges as shuffle partitions, up to the 1024 that one generated
    expression tells apart, and at most one more row reaches the offset window
    and the broadcast.
    """
    ranges = ranges or min(1024, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(key, shares, ranges * 50)).scalar()
    spread = df.withColumn("_cuts", cuts).withColumn("_range", F.expr(_cuts_below(f"`{key}`", 0, ranges - 1))).drop("_cuts")
    sizes = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    start = F.lit(start) if isinstance(start, int) else start
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        spread.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (start + F.col("_before") + F.col("_inside")).cast("long"))
        .select(name, *df.columns)
    )


def _cuts_below(key: str, low: int, high: int) -> str:
    """SQL for the number of cut points below the key, by halving: a few comparisons per row, all in generated code."""
    if low == high:
        return str(low)
    middle = (low + high) // 2
    return (
        f"CASE WHEN {key} > _cuts[{middle}] THEN {_cuts_below(key, middle + 1, high)} "
        f"ELSE {_cuts_below(key, low, middle)} END"
    )


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1, 2, ... in ``order`` over the whole table, however large.

    Range bounds are sampled, so the sorted rows are written to the checkpoint
    folder once; positions and counts then refer to the same split, also when
    executors are lost. The counts table has one row per task.
    """
    columns = [F.col(c) for c in order]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    placed = checkpointed(
        ranged.sortWithinPartitions(*columns).withColumn("_place", F.monotonically_increasing_id())
    )
    return _from_places(placed, name, df.columns, 0)


def hand_out_keys(df: DataFrame, name: str, above: int = 0) -> DataFrame:
    """Add ``name`` = above + 1, above + 2, ... in no promised order, without a shuffle.

    Every task numbers its own rows and gets a range of keys of just their
    count. The rows are written to the checkpoint folder with their places, so a
    lost executor cannot change a key. ``above`` is the high-water mark of
    earlier runs.
    """
    return _from_places(checkpointed(df.withColumn("_place", F.monotonically_increasing_id())), name, df.columns, above)


def _from_places(placed: DataFrame, name: str, columns: Sequence[str], above: int) -> DataFrame:
    part = F.shiftright("_place", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + local + 1 + above)
        .select(name, *columns)
    )


def spread_blocks(
    df: DataFrame, order: Sequence[str], groups: DataFrame, group_key: str, target: str | None = None
) -> DataFrame:
    """Cut the rows, in ``order``, into equal contiguous blocks, one per group in key order.

    Each of the k groups gets floor(rows / k) rows. Rows left over at the end
    keep what ``target`` already holds, or the first group's key where the
    table has no such column.
    """
    target = target or group_key
    rows = number_rows(df, order, "_row_no")
    total = rows.agg(F.count(F.lit(1))).scalar()
    k = groups.agg(F.count(F.lit(1))).scalar()
    block = F.floor(F.try_divide(total, k))
    numbered = surrogate_key(groups.select(F.col(group_key).alias("_group")), "_group", "_block")
    rest = F.col(target) if target in df.columns else groups.agg(F.min(group_key)).scalar()
    # block 0 (fewer rows than groups) assigns nothing, as in integer division by an empty block
    wanted = F.when(block > 0, F.floor((F.col("_row_no") - 1) / block) + 1)
    return (
        rows.withColumn("_block", wanted)
        .join(numbered, "_block", "left")
        .withColumn(target, F.coalesce("_group", rest))
        .drop("_row_no", "_block", "_group")
    )


def slice_rows(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` + 1 to ``offset`` + ``limit`` in ``order``, without sorting the rest.

    Two scans count rows by the first column, rounded to 18 and then, inside
    the cells that hold the slice's ends, to 36 significant bits; counts are
    combined before they leave a task. Only rows between these ends are numbered
    in order: the slice itself and what ties with its ends in the first column's
    leading digits (of texts: 6 bytes). No task holds offset + limit rows, however deep the
    slice is. Rows that tie in ``order`` follow each other in no promised order, so it should be unique.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    if limit == 0:
        return df.limit(0)
    code = F.coalesce(_order_code(df, order[0]), F.lit(float("-inf")))
    coarse, fine = rounded_to(rounded_to(code, 36), 18), rounded_to(code, 36)
    ends = [F.lit(offset), F.lit(offset + limit - 1)]
    first = _cells_at(df.select(coarse.alias("_cell")), F.lit(0).cast("long"), ends)
    low, high = (
        _cells_at(df.filter(coarse == first[end]["cell"]).select(fine.alias("_cell")), first[end]["below"], [ends[end]])[0]
        for end in (0, 1)
    )
    band = df.filter((fine >= low["cell"]) & (fine <= high["cell"]))
    # numbering is above the rows below the band; the scalar is the same one that cut it
    numbered = number_rows(band.withColumn("_below", low["below"]), order, "_row_no")
    place = F.col("_row_no") + F.col("_below")
    return numbered.filter(place.between(offset + 1, offset + limit)).select(*df.columns)


def _order_code(df: DataFrame, name: str) -> Column:
    """A double that never falls along the column's order; what has none ties."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return (col.cast("int") if isinstance(kind, T.BooleanType) else col).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        lead = F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0")
        return F.conv(lead, 16, 10).cast("double")
    return F.lit(0.0)


def _cells_at(cells: DataFrame, below: Column, places: Sequence[Column]) -> Column:
    """For each 0-based place: (cell, below), the cell that holds it and the number of rows before that cell."""
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = cells.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows")).withColumn(
        "_before", below + F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long"))
    )
    # the last cell that begins at or before the place; a place beyond the end falls in the last one
    found = [
        F.max(F.when(F.col("_before") <= place, F.struct(F.col("_before").alias("below"), F.col("_cell").alias("cell"))))
        for place in places
    ]
    return counted.agg(F.array(*found).alias("ends")).scalar()
