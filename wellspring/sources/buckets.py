"""Vault tables in buckets of their hash key, so that joins on it need no shuffle.

Link and measurements are bucketed alike: rows of one key are in the same bucket
of both, whatever load brought them, and Spark joins bucket with bucket. An
append adds files to buckets and keeps that property. The files lie below a path
of their own; another session finds them again with ``open_bucketed``, which
only registers what the path already holds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A bucket is a task's work in every join: about rows * width / buckets bytes.
BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int = BUCKETS, append: bool = False) -> DataFrame:
    """Write ``df`` as (or append it to) a table bucketed and sorted by ``key``; returns the table.

    Rows are brought to their bucket's task first, so a load writes one file per
    bucket, not one per task and bucket; Spark leaves that out for rows that are
    there already. Hashes are the bulk of a table, and as hex text half its size
    with a code for single characters, which zstandard has.
    """
    rows = df.repartition(buckets, F.col(key))
    writer = rows.write.format("parquet").option("compression", "zstd").mode("append" if append else "overwrite")
    writer.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Register the bucketed files at ``path``, which an earlier session wrote, under ``table``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def write_vault_buckets(
    tables: Mapping[str, DataFrame], keys: Mapping[str, str], prefix: str, path: str, buckets: int = BUCKETS, append: bool = False
) -> dict[str, DataFrame]:
    """Write the tables that ``keys`` names, each by its key, as ``prefix`` + name below ``path``."""
    return {
        name: write_bucketed(tables[name], f"{prefix}{name}", f"{path.rstrip('/')}/{name}", key, buckets, append)
        for name, key in keys.items()
    }
