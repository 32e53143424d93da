"""Sinks. Each can be run again without changing the outcome."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from wellspring.functions.scalars import as_documents, iso_text, nan_to_null, run_time
from wellspring.operators.joins import new_rows
from wellspring.sources.files import CSV_TIMES


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table; with partitions, replace only those in ``df``."""
    writer = (gathered(df, *partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and go on from what was written; for results that several steps read."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def read_if_present(df: DataFrame, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first load."""
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_table(
    df: DataFrame,
    path: str,
    key: Sequence[str],
    partition_by: str = "load_date",
    order: Sequence[str] = (),
    derive: Callable[[DataFrame], Mapping[str, Column]] | None = None,
    columns: Sequence[str] | None = None,
) -> None:
    """Append rows whose key the table lacks, partitioned by ``partition_by``.

    ``derive`` adds columns that follow from those of ``df``, such as hashes, once rows
    are at their place, so that they are not shuffled (one that is in the key as well
    is made twice); ``columns`` are the table's.

    When the partition column is part of the key, only the partitions that
    ``df`` touches are compared: Spark prunes the scan to them at run time. A key
    with a null part is new always, as nulls are equal to nothing.
    """
    existing = read_if_present(df, path)
    if existing is None:
        from wellspring.operators.history import dedup_first

        fresh = dedup_first(df, list(key), order or [c for c in df.columns if c not in key])
    else:
        if partition_by in key:
            touched = df.select(partition_by).filter(F.col(partition_by).isNotNull()).distinct()
            existing = existing.join(touched, partition_by, "left_semi")
        fresh = new_rows(existing, df, list(key), order)
    if derive is not None:
        fresh = fresh.drop(*derive(fresh))
    _append(_derived(gathered(fresh, partition_by), derive, columns), path, partition_by)


def _append(rows: DataFrame, path: str, partition_by: str) -> None:
    """zstandard, as hashes are half of such a table and their hex text needs a code for single characters."""
    rows.write.mode("append").option("compression", "zstd").partitionBy(partition_by).parquet(path)


def _derived(rows: DataFrame, derive: Callable[[DataFrame], Mapping[str, Column]] | None, columns: Sequence[str] | None) -> DataFrame:
    rows = rows if derive is None else rows.withColumns(dict(derive(rows)))
    return rows.select(*(columns or rows.columns))


def append_counted(
    df: DataFrame,
    path: str,
    partition_by: str,
    aside: Sequence[str] = (),
    derive: Callable[[DataFrame], Mapping[str, Column]] | None = None,
    columns: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> None:
    """Append as many rows of each content as ``df`` has more of than the table: a union of multisets.

    Rows are equal when all columns but those in ``aside`` are; of these the
    least value of the batch is kept. Rows of both are counted in one grouping,
    in the map tasks first, so a content repeated by a third of all rows costs a
    row a task, and only the partitions that ``df`` touches are read. Running a
    batch again appends nothing. ``derive`` adds columns that follow from those
    of ``df``, such as hashes, which then are not shuffled; a row of the table with
    others there equals none. ``columns`` are the table's. ``within`` names columns
    of the content that have few values in ``df``, such as its files' names: rows of the
    table with other values equal none, so they go before the grouping.
    """
    content = [c for c in df.columns if c not in aside]
    both = df.select(*content, *aside, F.lit(1).cast("long").alias("_more"))
    existing = read_if_present(df, path)
    if existing is not None:
        by = list(dict.fromkeys([partition_by, *within]))
        touched = df.select(*[F.col(c).alias(f"_touched_{c}") for c in by]).distinct()
        held = existing.join(touched, [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in by], "left_semi")
        for name, value in (derive(held) if derive else {}).items():
            held = held.filter(F.col(name).eqNullSafe(value))
        none = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in aside]
        both = both.union(held.select(*content, *none, F.lit(-1).cast("long").alias("_more")))
    # a grouping, not a join: nulls are equal here
    counted = both.groupBy(*content).agg(*[F.min(c).alias(c) for c in aside], F.sum("_more").alias("_more"))
    placed = gathered(counted.filter("_more > 0"), partition_by)
    rows = placed.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_more"))).alias("_copy")).select(*df.columns)
    _append(_derived(rows, derive, columns), path, partition_by)


def gathered(df: DataFrame, *partition_by: str) -> DataFrame:
    """Rows of a partition brought together before a partitioned write, so that it gets few files.

    A rebalance, not a repartition: small partitions share a task and a
    partition with very many rows is split over several.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def to_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Full refresh of a relational table: emptied and filled again, its definition kept."""
    df.write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=dict(properties or {}))


def documents(df: DataFrame, order: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """All rows, or the first ``limit`` in ``order``, with ISO text for times and null for NaN."""
    return as_documents(df if limit is None else df.orderBy(*order).limit(limit))


def to_documents(df: DataFrame, path: str, order: Sequence[str] = (), limit: int | None = None) -> None:
    """Replace the document target by JSON lines, one document per row."""
    documents(df, order, limit).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def dated_path(folder: str, name: str, day: str) -> str:
    """Export folder of one day: ``folder/name_yyyymmdd``."""
    return f"{folder.rstrip('/')}/{name}_{day.replace('-', '')}"


def to_json(df: DataFrame, folder: str, name: str, day: str, one_file: bool = False) -> str:
    """Records as JSON with ISO dates, under a dated name. ``one_file`` suits small marts only."""
    path = dated_path(folder, name, day)
    rows = iso_text(nan_to_null(df))
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def to_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; times keep their microseconds."""
    df.write.mode("overwrite").option("header", True).options(**CSV_TIMES).csv(path)


def export_marts(marts: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Every mart to CSV; returns 'ok' or the error per mart, and goes on after one fails."""
    outcome = {}
    for name, mart in marts.items():
        try:
            to_csv(mart, f"{folder.rstrip('/')}/{name}")
            outcome[name] = "ok"
        except Exception as error:
            outcome[name] = f"error: {error}"
    return outcome


def run_report(
    analytics: DataFrame,
    extracted: DataFrame,
    documents_written: Column,
    run_id: str,
    executed_at: str,
    json_path: str,
) -> DataFrame:
    """One nested row: run, time, extract / transform / load counts.

    ``extracted`` is one row with ``measurements`` and ``wells``; the analytics
    are aggregated once. No counts pass through the driver.
    """
    done = analytics.agg(
        F.count(F.lit(1)).alias("_wells"), F.coalesce(F.sum("anomaly_count"), F.lit(0)).alias("_anomalies")
    )
    taken = extracted.select(F.struct("measurements", "wells")).scalar()
    return done.select(
        F.lit(run_id).alias("pipeline_run"),
        run_time(executed_at).alias("execution_time"),
        taken.alias("extract"),
        F.struct(F.col("_wells").alias("wells_processed"), F.col("_anomalies").alias("anomalies_found")).alias(
            "transform"
        ),
        F.struct(
            F.col("_wells").alias("postgresql"), documents_written.alias("mongodb"), F.lit(json_path).alias("json")
        ).alias("load"),
    )


def flat(df: DataFrame) -> DataFrame:
    """Top-level struct columns spread into ``parent_child`` columns."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.StructType):
            out += [F.col(f.name)[c.name].alias(f"{f.name}_{c.name}") for c in f.dataType]
        else:
            out.append(F.col(f.name))
    return df.select(*out)
