"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm.best_fit_packing import best_fit_packing
from wellspring.llm.jaccard_join import JaccardJoin
from wellspring.llm.pii import redact_personal_data
from wellspring.llm.quality_rules import quality_rules
from wellspring.llm.source_mix import mix_sources
from wellspring.llm.store import marked, passing, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a key of their content, since ids may be null or repeated; equal rows have one key.

    A key follows from the row, so texts need not be stored a second time to be
    found again. Two unequal rows share one with probability 2**-64; of 10**9 rows
    some pair does with probability 0.03.
    """
    return docs.select(*COLUMNS, F.xxhash64(*[F.struct(F.col(c).isNull(), c) for c in COLUMNS]).alias("key"))


def _rows_of(keyed: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows in all as often as ``verdicts`` (every key, copies, rows) says for their key, however many equal rows there are.

    Only rows whose key may have another verdict than one copy of one row are joined; the other texts are not moved.
    """
    keyed = marked(keyed, "key", verdicts.filter("copies != 1 or rows != 1"))
    met = keyed.filter("met").join(verdicts.filter("copies > 0"), "key")
    found = met.filter("rows = 1").union(met.filter("rows > 1").dropDuplicates(["key"]))
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)
    return keyed.filter("not met").select(*COLUMNS).union(found)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep.

    A null text counts as empty and is rejected, as is any text under 10 words.
    Equal rows are kept or rejected together. A null language is a language of
    its own. An empty table stays empty. Columns beyond those of documents are dropped.
    """
    rows = _keyed(docs)
    with passing(spark):
        verdicts = quality_rules(rows.select(F.col("key").alias("doc_id"), "text", "lang"))
        verdicts = staged(verdicts.select(F.col("doc_id").alias("key"), F.coalesce("kept", F.lit(False)).alias("kept")).distinct(), "kept", lasting=True)
    rows = marked(rows, "key", verdicts.filter("not kept"))  # texts of all other rows are not moved
    met = rows.filter("met").join(verdicts.filter("kept"), "key", "semi")
    return rows.filter("not met").select(*COLUMNS).union(met.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of linked texts: that with the smallest id.

    Null, empty and wordless texts are linked with nothing and all stay. A null
    id comes after all others; of rows with equal ids the one with the smaller
    key stays, of equal rows one. An empty table stays empty. Columns beyond
    those of documents are dropped.
    """
    rows = _keyed(docs)
    with passing(spark):
        found = JaccardJoin(rows, "key").result().select(F.col("id").alias("key"), "n", F.col("component").alias("group"))
        ids = rows.select("key", "doc_id").distinct()
        by_id = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
        of_key = found.groupBy("key", "n", "group").agg(F.count(F.lit(1)).alias("rows"))
        linked = of_key.filter("n > 0").join(ids, "key").groupBy("group").agg(F.min(by_id).alias("kept"), F.min_by("rows", by_id).alias("rows"))
        linked = linked.select("kept.key", F.lit(1).cast("long").alias("copies"), "rows")
        kept = linked.union(of_key.filter("n = 0").select("key", F.col("rows").alias("copies"), "rows"))
        dropped = of_key.select("key").distinct().join(kept, "key", "anti")
        verdicts = kept.union(dropped.select("key", F.lit(0).cast("long"), F.lit(1).cast("long")))
        verdicts = staged(verdicts, "kept", lasting=True)
    return _rows_of(rows, verdicts)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind; n_chars follows.

    A null text stays null and keeps its n_chars. Repeated rows, null and
    repeated ids are rows like others. An empty table stays empty. Columns beyond
    those of documents are dropped.
    """
    clean = redact_personal_data(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as many times as the mix takes it.

    Rows without words are not taken. A null source is a source of its own. Of
    equal rows it is left open which are taken, since their copies are equal. An
    empty table stays empty. Columns beyond those of documents are dropped.
    """
    rows = _keyed(docs)
    with passing(spark):
        taken = mix_sources(rows.select(F.col("key").alias("doc_id"), "text", "source")).groupBy(F.col("doc_id").alias("key"))
        taken = taken.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
        taken = staged(taken, "taken", lasting=True)
    return _rows_of(rows, taken)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows' pieces in sequences of permitted lengths.

    Null, empty and wordless texts have no pieces. Rows with equal or null ids
    are packed one by one. An empty table gives no rows.
    """
    return best_fit_packing(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("packing", packing),
]

# the model of the third stage is not expressible in SQL; tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
