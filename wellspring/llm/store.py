"""Stage tables in the shared scratch folder, and components of a link table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import scratch_path


SIEVE_BITS = 24  # of a filter over hashed keys: a fixed 2 MB

_passing: list[list[str]] = []  # paths of the open ``passing`` blocks, the innermost last


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, but for those with ``lasting``, which an outer block may remove.

    What leaves the block must be lasting or not read them. After an error they stay, for a look at them.
    """
    _passing.append([])
    try:
        yield
    except BaseException:
        _passing.pop()
        raise
    for name in _passing.pop():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str = "stage", lasting: bool = False) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    blocks = _passing[:-1] if lasting else _passing
    if blocks:
        blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def marked(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``df`` with ``met``: true where ``key`` (a 64-bit hash) is in ``keys``, and for few others while these are some millions or fewer.

    Only a key's first bits are asked, of a filter that is broadcast as at most
    2**(SIEVE_BITS - 6) words of 64 bits, so the rows themselves stay where they are.
    """
    cell = F.shiftrightunsigned(key, 64 - SIEVE_BITS)
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = keys.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = df.join(F.broadcast(words), F.shiftright(cell, 6) == F.col("word"), "left")
    met = F.coalesce(F.getbit("bits", cell.bitwiseAND(63).cast("int")) == 1, F.lit(False))
    return found.select(*df.columns, met.alias("met"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node of each node's component, for the nodes of undirected ``links``.

    Alternating large-star and small-star steps: a step is a grouping with a
    map-side minimum and a join, its result a written table, and the number of
    steps grows with the logarithm of the longest chain. No neighbour list is
    collected, so a node may have any number of links.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = staged(pairs, "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.filter("u != v").union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # done when every node points at one root and no root points on
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("from")).union(edges.select("v", F.lit(0)).distinct())
        moving = ends.groupBy("node").agg(F.sum("from").alias("from"), F.count(F.lit(1)).alias("all")).filter("from > 1 or all > from and from > 0")
        if moving.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
