"""Snapshots of a mart: writing, listing, reading, time travel and comparison."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions.scalars import pct_change, run_time
from wellspring.sources.sinks import read_if_present, write_table


def stamp_snapshot(df: DataFrame, snapshot_id: str, taken_at: str) -> DataFrame:
    return df.withColumns({"snapshot_timestamp": run_time(taken_at), "snapshot_id": F.lit(snapshot_id)})


def write_snapshot(df: DataFrame, path: str, snapshot_id: str, taken_at: str) -> None:
    """Write one full copy as its own partition; writing the same id again replaces just that one."""
    write_snapshots(stamp_snapshot(df, snapshot_id, taken_at), path)


def write_snapshots(df: DataFrame, path: str) -> None:
    """Write rows that already carry snapshot_id and snapshot_timestamp."""
    write_table(df, path, ["snapshot_id"])


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All versions. Ids are text, also where they look like numbers."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "snapshot_id" else f.dataType) for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def list_snapshots(history: DataFrame) -> DataFrame:
    """Id, time and number of rows of every version."""
    return history.groupBy("snapshot_id").agg(
        F.min("snapshot_timestamp").alias("snapshot_timestamp"), F.count(F.lit(1)).alias("records_count")
    )


def _known(history: DataFrame, *ids: str) -> None:
    found = {
        r[0] for r in history.filter(F.col("snapshot_id").isin(list(ids))).select("snapshot_id").distinct().collect()
    }
    for wanted in ids:
        if wanted not in found:
            raise ValueError(f"there is no snapshot {wanted!r}")


def read_snapshot(history: DataFrame, snapshot_id: str) -> DataFrame:
    """The rows of one version; an unknown id is an error."""
    if not snapshot_id:
        raise ValueError("snapshot id required")
    _known(history, snapshot_id)
    return history.filter(F.col("snapshot_id") == snapshot_id)


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_wells"),
        F.sum("total_readings").alias("total_readings"),
        F.avg("avg_amplitude").alias("avg_amplitude"),
        F.avg("data_quality_rate").alias("avg_quality"),
    ]


def snapshot_summary(version: DataFrame) -> DataFrame:
    """Totals per version in ``version``: wells, readings, mean amplitude, mean quality."""
    return version.groupBy("snapshot_id").agg(F.min("snapshot_timestamp").alias("snapshot_timestamp"), *_measures())


def as_of(history: DataFrame, moment: str | datetime) -> DataFrame:
    """Rows of the newest version at or before ``moment``; none is an error."""
    if not moment:
        raise ValueError("timestamp required")
    at = F.lit(str(moment)).cast("timestamp_ntz")
    newest = (
        history.filter(F.col("snapshot_timestamp") <= at)
        .agg(F.max(F.struct("snapshot_timestamp", "snapshot_id")).alias("v"))
        .select("v.snapshot_id")
        .first()[0]
    )
    if newest is None:
        raise ValueError(f"there is no snapshot at or before {moment}")
    return history.filter(F.col("snapshot_id") == newest)


def compare_snapshots(history: DataFrame, first: str, second: str) -> DataFrame:
    """One row with both versions' totals and the change between them, from one aggregation."""
    if not first or not second:
        raise ValueError("two snapshot ids required")
    _known(history, first, second)

    def side(snapshot_id: str, suffix: str) -> list[Column]:
        here = F.col("snapshot_id") == snapshot_id
        return [
            F.lit(snapshot_id).alias(f"id_{suffix}"),
            F.min(F.when(here, F.col("snapshot_timestamp"))).alias(f"timestamp_{suffix}"),
            F.count_if(here).alias(f"wells_{suffix}"),
            F.avg(F.when(here, F.col("avg_amplitude"))).alias(f"amplitude_{suffix}"),
        ]

    both = history.filter(F.col("snapshot_id").isin(first, second)).agg(*side(first, "1"), *side(second, "2"))
    a, b = F.col("amplitude_1"), F.col("amplitude_2")
    return both.withColumns(
        {
            "wells_diff": F.col("wells_2") - F.col("wells_1"),
            "amplitude_diff": b - a,
            "amplitude_change_pct": pct_change(a, b),
        }
    )


def snapshot_diff(
    history: DataFrame, first: str, second: str, key: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Rows added, removed or changed between two versions, compared null-safely.

    Old and new rows meet in one grouping on the key, so each version is read once.
    """
    _known(history, first, second)
    rows = history.filter(F.col("snapshot_id").isin(first, second)).select(
        *key, (F.col("snapshot_id") == second).alias("_new"), F.struct(*values).alias("_v")
    )
    met = rows.groupBy(*key).agg(
        F.max(F.when(~F.col("_new"), F.col("_v"))).alias("_old"), F.max(F.when(F.col("_new"), F.col("_v"))).alias("_now")
    )
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_now").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_now")), "changed")
    )
    return (
        met.withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(
            *key,
            "change",
            *[F.col("_old")[v].alias(f"{v}_before") for v in values],
            *[F.col("_now")[v].alias(f"{v}_after") for v in values],
        )
    )


class SnapshotStore:
    """Snapshots below a path, each a folder of its own, known through a manifest.

    A snapshot's rows are written first; then one manifest row (id, time, rows,
    files, place) commits it. Listing, as-of and reading go by the manifest, so
    they never scan the history, and an interrupted write is invisible. Writing
    an id again commits a new folder in place of the old one; readers that
    started before keep theirs.
    """

    SCHEMA = (
        "snapshot_id STRING, snapshot_timestamp TIMESTAMP_NTZ, records_count LONG, files LONG, place STRING, serial LONG"
    )

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, df: DataFrame, snapshot_id: str, taken_at: str) -> None:
        if not snapshot_id:
            raise ValueError("snapshot id required")
        place = f"data/{uuid.uuid4().hex}"
        stamp_snapshot(df, snapshot_id, taken_at).write.parquet(f"{self.path}/{place}")
        written = self.spark.read.parquet(f"{self.path}/{place}").select(F.col("_metadata.file_path").alias("_file"))
        serial = self._commits().agg(F.coalesce(F.max("serial"), F.lit(0)) + 1).scalar()
        counted = written.agg(F.count(F.lit(1)).alias("records_count"), F.count_distinct("_file").alias("files"))
        row = counted.select(
            F.lit(snapshot_id).alias("snapshot_id"),
            run_time(taken_at).alias("snapshot_timestamp"),
            "records_count",
            "files",
            F.lit(place).alias("place"),
            serial.cast("long").alias("serial"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def _commits(self) -> DataFrame:
        empty = self.spark.createDataFrame([], self.SCHEMA)
        found = read_if_present(empty, f"{self.path}/manifest")
        return empty if found is None else found

    def list(self) -> DataFrame:
        """Committed snapshots: id, time, rows, files. One row per snapshot is all it reads."""
        return self._newest().select("snapshot_id", "snapshot_timestamp", "records_count", "files")

    def _newest(self) -> DataFrame:
        columns = [c for c in self._commits().columns if c not in ("snapshot_id", "serial")]
        return self._commits().groupBy("snapshot_id").agg(F.max(F.struct("serial", *columns)).alias("c")).select("snapshot_id", "c.*")

    def _at(self, chosen: DataFrame, otherwise: str) -> DataFrame:
        row = chosen.orderBy(F.desc("snapshot_timestamp"), F.desc("snapshot_id")).first()
        if row is None:
            raise ValueError(otherwise)
        return self.spark.read.parquet(f"{self.path}/{row['place']}")

    def read(self, snapshot_id: str) -> DataFrame:
        if not snapshot_id:
            raise ValueError("snapshot id required")
        return self._at(self._newest().filter(F.col("snapshot_id") == snapshot_id), f"there is no snapshot {snapshot_id!r}")

    def as_of(self, moment: str | datetime) -> DataFrame:
        """Rows of the newest snapshot at or before ``moment``; only its own files are read."""
        if not moment:
            raise ValueError("timestamp required")
        at = F.lit(str(moment)).cast("timestamp_ntz")
        return self._at(self._newest().filter(F.col("snapshot_timestamp") <= at), f"there is no snapshot at or before {moment}")

    def compare(self, first: str, second: str) -> DataFrame:
        """One row with both versions' totals and the change between them, from these two folders alone."""
        return compare_snapshots(self.read(first).unionByName(self.read(second)), first, second)
