"""Table and file scans."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.sources.traces import open_filesystem

# Both time types, written and read with microseconds and no zone.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def read_master(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV with a declared schema; types are not inferred, so the file is read once."""
    return spark.read.schema(schema).option("header", True).options(**CSV_TIMES).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A whole Parquet table; filters and column choice made later reach the scan."""
    return spark.read.parquet(path)


def read_vault(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One table of a written vault or warehouse."""
    return read_table(spark, f"{path.rstrip('/')}/{name}")


def static_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A fixed, small table of literals."""
    return spark.createDataFrame(rows, schema)


def read_dir(spark: SparkSession, path: str, glob: str = "*.parquet", schema: T.StructType | None = None) -> DataFrame:
    """All matching Parquet files of a folder, with the file's name as record_source."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.parquet(path)
    return rows.withColumn("record_source", F.col("_metadata.file_name"))


def read_bytes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Raw files: path, modificationTime, length, content. Unused content is never loaded."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    )


def list_sources(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of the files below ``path``, from Spark's own file index; no content is read."""
    return read_bytes(spark, path, glob).select("path", "length", F.col("modificationTime").alias("modified"))


def find_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of the same files as ``list_sources`` has, found in the tasks, so that the driver holds none of them.

    What lies right below ``path`` is dealt out; a task lists each folder there
    with all below it. It holds the listing of one folder at a time.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    roots = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    if not roots:
        return list_sources(spark, path, glob).select("path", "length")  # fails as Spark's reader does
    # Hadoop's own reading of the glob
    named = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.createDataFrame([(r.getPath().toString(), None) for r in roots], "path STRING, length BIGINT")
    for deep in (False, True):
        found = found.repartition(tasks, "path").mapInArrow(_listing(deep), "path STRING, length BIGINT")
    return found.filter(F.element_at(F.split("path", "/"), -1).rlike(rf"(?s)\A(?:{named})\z"))


def _listing(deep: bool):
    """Folders (rows without a length) by what is in them, or, ``deep``, by all files below them; files as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for rows in [[(path, length)]] if length is not None else _below(path, deep):
                    if rows:
                        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64()))], ["path", "length"])

    return run


def _below(path: str, deep: bool) -> Iterator[list[tuple[str, int | None]]]:
    system, inner = open_filesystem(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        yield [(path, info.size)] if info.size and not _hidden(info.base_name, False) else []
        return
    inner = inner.rstrip("/")
    waiting = [inner]
    while waiting:
        rows = []
        for f in system.get_file_info(fs.FileSelector(waiting.pop() or "/")):
            file = f.type == fs.FileType.File
            if _hidden(f.base_name, not file) or (file and not f.size):
                continue
            if file or not deep:
                rows.append((path.rstrip("/") + f.path[len(inner) :], f.size if file else None))
            else:
                waiting.append(f.path)
        yield rows


def _hidden(name: str, folder: bool) -> bool:
    """Whether Spark's file index leaves a file or folder out; of the files it also leaves out empty ones."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
