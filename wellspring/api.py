"""The questions a dashboard or a script asks, over a written warehouse.

Each returns a DataFrame; a mart that was never written is an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wellspring.functions.patterns import DEFAULT_PATTERNS
from wellspring.operators import marts, snapshots
from wellspring.schemas import MART_SENSOR, MART_SURVEY, MART_WELL
from wellspring.sources import repair, sinks, traces


class Dashboard:
    """Marts and snapshots below one warehouse folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _mart(self, name: str, schema: T.StructType) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        found = sinks.read_if_present(empty, f"{self.path}/{name}")
        return empty if found is None else found

    def well_performance(self) -> DataFrame:
        return marts.load_mart(self._mart("mart_well_performance", MART_WELL))

    def sensor_analysis(self) -> DataFrame:
        return marts.load_mart(self._mart("mart_sensor_analysis", MART_SENSOR))

    def survey_summary(self) -> DataFrame:
        return marts.load_mart(self._mart("mart_survey_summary", MART_SURVEY))

    def stats(self) -> DataFrame:
        return marts.kpi_stats(
            self._mart("mart_well_performance", MART_WELL), self._mart("mart_sensor_analysis", MART_SENSOR)
        )

    def wells_map(self) -> DataFrame:
        return marts.wells_map(self._mart("mart_well_performance", MART_WELL))

    # --- versions of the well mart

    @property
    def _snapshot_path(self) -> str:
        return f"{self.path}/snapshots"

    def take_snapshot(self, snapshot_id: str, taken_at: str) -> None:
        mart = self._mart("mart_well_performance", MART_WELL)
        snapshots.write_snapshot(mart, self._snapshot_path, snapshot_id, taken_at)

    def _history(self) -> DataFrame:
        schema = T.StructType(
            [*MART_WELL.fields, T.StructField("snapshot_timestamp", T.TimestampNTZType()),
             T.StructField("snapshot_id", T.StringType())]
        )
        empty = self.spark.createDataFrame([], schema)
        if sinks.read_if_present(empty, self._snapshot_path) is None:
            return empty
        return snapshots.read_snapshots(self.spark, self._snapshot_path)

    def snapshots(self) -> DataFrame:
        return snapshots.list_snapshots(self._history()).orderBy("snapshot_id")

    def snapshot(self, snapshot_id: str) -> DataFrame:
        return snapshots.read_snapshot(self._history(), snapshot_id)

    def snapshot_summary(self, snapshot_id: str) -> DataFrame:
        return snapshots.snapshot_summary(self.snapshot(snapshot_id))

    def compare(self, first: str, second: str) -> DataFrame:
        return snapshots.compare_snapshots(self._history(), first, second)

    def time_travel(self, moment: str) -> DataFrame:
        return snapshots.as_of(self._history(), moment)


def parse_sgx(spark: SparkSession, path: str, output: str, on_error: str = "skip", by_file: bool = False) -> DataFrame:
    """Trace files to a Parquet table, or to one folder per source file."""
    sinks.write_table(traces.read_sgx(spark, path, on_error=on_error), output, ["source_file"] if by_file else ())
    return spark.read.parquet(output)


def recover(spark: SparkSession, path: str, output: str, glob: str = "*.parquet") -> DataFrame:
    """Repair a folder of Parquet files; returns the log in file order."""
    _, manifest = repair.repair_parquet(spark, path, output, glob)
    return repair.repair_manifest(manifest)


def extract_flags(
    spark: SparkSession, path: str, glob: str = "*.parquet", patterns: Sequence[str] = DEFAULT_PATTERNS
) -> DataFrame:
    """Pattern matches in a folder of files."""
    return repair.scan_files_for_patterns(spark, path, glob, patterns)
