"""Exact top-k inner products by three phases with a uniform threshold.

A vector's dimensions are dealt to ``SLICES`` lists; a score is the sum of its
lists' scores. (1) Every block of vectors reports each list's best local scores
for a query; the exact totals of these give a lower bound of the k-th score.
(2) That bound, shared equally by the lists above their least scores, is a safe
cutoff: a vector below the cutoff in every list stays below the bound. Each list
reports all entries that reach it. (3) Entries seen in all lists are exact;
for the others a bound decides, and what remains is resolved from the vectors.

Equal vectors are one entry with their k + 1 least ids, cut down before the
shuffle, so a vector that fills a third of the table costs one comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.store import staged

SLICES = 2
BLOCK, QUERY_BLOCK = 2048, 512  # vectors of a block, in the mean
QUERY_ROWS = 128  # of a block, compared at once
SCALE = 256


def _quantize_pass(scale: int, keep: int):
    """(vec, vec_id): each task's ``keep`` least ids of every quantized vector."""

    def run(batches):
        least: dict[bytes, list[int]] = {}
        for batch in batches:
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = values.values
                if vec_id is None or values is None or values.null_count:
                    continue
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all():
                    continue
                ids = least.setdefault(np.floor(v * scale).astype(np.int64).tobytes(), [])
                ids.append(vec_id)
                if len(ids) > 4 * keep:
                    ids[:] = sorted(ids)[:keep]
        rows = [(v, i) for v, ids in least.items() for i in sorted(ids)[:keep]]
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            yield pa.record_batch([pa.array([r[0] for r in part], pa.binary()), pa.array([r[1] for r in part], pa.int64())], ["vec", "vec_id"])

    return run


def _query_pass(scale: int, every: int):
    def run(batches):
        for batch in batches:
            found = []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = values.values
                if vec_id is None or vec_id % every or values is None or values.null_count:
                    continue
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    found.append((np.floor(v * scale).astype(np.int64).tobytes(), vec_id))
            yield pa.record_batch([pa.array([r[0] for r in found], pa.binary()), pa.array([r[1] for r in found], pa.int64())], ["vec", "query_id"])

    return run


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    if all(len(v) == 8 * width for v in vectors):
        return np.frombuffer(b"".join(vectors), np.int64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        v = np.frombuffer(v, np.int64)
        row[: len(v)] = v
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where these are exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _slices(width: int) -> list[slice]:
    edges = np.linspace(0, width, SLICES + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _parts(row: dict, width: int):
    """A pair of blocks as (queries, their places, vectors' ids, scores of each list), some queries at a time."""
    v, cs = _matrix(row["vec"], width), np.array(row["c"])
    for at in range(0, len(row["q"]), QUERY_ROWS):
        here = slice(at, at + QUERY_ROWS)
        q = _matrix(row["q_vec"][here], width)
        yield np.array(row["q"][here]), here, cs, [_product(q[:, s], v[:, s]) for s in _slices(width)]


def _local_lists(width: int, k: int):
    """Phase 1: (q, c, total, low0, ...): of the best entries of all lists in the block those with the k best exact totals, and each list's least score."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for ids, _, cs, lists in _parts(row, width):
                    n = min(k, len(cs))
                    heads = np.hstack([np.argpartition(-scores, n - 1, axis=1)[:, :n] for scores in lists])
                    heads.sort(axis=1)
                    totals = np.take_along_axis(sum(lists), heads, 1)
                    totals[:, 1:][heads[:, 1:] == heads[:, :-1]] = np.iinfo(np.int64).min  # an entry of several lists counts once
                    best = np.argpartition(-totals, n - 1, axis=1)[:, :n]
                    yield pa.record_batch(
                        [
                            pa.array(np.repeat(ids, n)),
                            pa.array(cs[np.take_along_axis(heads, best, 1)].ravel()),
                            pa.array(np.take_along_axis(totals, best, 1).ravel()),
                            *[pa.array(np.repeat(scores.min(axis=1), n)) for scores in lists],
                        ],
                        ["q", "c", "total", *[f"low{s}" for s in range(SLICES)]],
                    )

    return run


def _entries(width: int):
    """Phases 2 and 3: (q, c, score): entries that reach the query's cutoff in a list, and by what their unseen lists may add its bound, resolved; those at the bound at least."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cutoffs, bounds = np.array(row["cutoffs"]), np.array(row["bounds"])
                for ids, here, cs, lists in _parts(row, width):
                    reached = [scores >= cutoffs[here, number][:, None] for number, scores in enumerate(lists)]
                    at = np.nonzero(np.logical_or.reduce(reached))
                    # an unseen list adds less than its cutoff
                    most = sum(np.where(seen[at], scores[at], cutoffs[here, number][at[0]]) for number, (scores, seen) in enumerate(zip(lists, reached, strict=True)))
                    open_ = most >= bounds[here][at[0]]
                    at = (at[0][open_], at[1][open_])
                    total = sum(scores[at] for scores in lists)
                    kept = total >= bounds[here][at[0]]
                    yield pa.record_batch([pa.array(ids[at[0][kept]]), pa.array(cs[at[1][kept]]), pa.array(total[kept])], ["q", "c", "score"])

    return run


def _blocks(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """Vectors gathered into blocks of about ``rows``, by hash."""
    blocks = max(1, -(-vectors.count() // rows))
    block = F.pmod(F.xxhash64("c", "vec"), F.lit(blocks).cast("long")).alias(name)
    return vectors.groupBy(block).agg(F.collect_list(F.struct("c", "vec")).alias("all")).select(
        name, F.col("all.c").alias("c"), F.col("all.vec").alias("vec")
    ), blocks


def topk_search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of every query with all other rows.

    Components become floor(scale * x). Queries are rows whose id is divisible
    by ``every``; ties go to the smaller id; with fewer candidates all come.
    Rows with a null id, a null vector or a null, NaN or infinite component take
    no part. A shorter vector counts as filled up with zeros. A repeated id is
    one query a distinct vector; its other rows are candidates. An empty table
    gives no rows. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    keep = k + 1  # a query's own row is among its class
    ids = rows.mapInArrow(_quantize_pass(scale, keep), "vec binary, vec_id long")
    by_id = Window.partitionBy("vec").orderBy("vec_id")
    ids = ids.withColumns({"place": F.row_number().over(by_id), "first_id": F.first("vec_id").over(by_id)}).filter(F.col("place") <= keep)
    # a class is named by id and vector, since an id may come with several vectors
    ids = staged(ids.withColumn("c", F.xxhash64("first_id", "vec")), "ids")
    classes = ids.filter("place = 1").select("c", "first_id", "vec")
    width = (classes.agg(F.max(F.length("vec"))).first()[0] or 0) // 8
    asked = rows.mapInArrow(_query_pass(scale, every), "vec binary, query_id long").distinct()
    # vectors are small in files and shuffles and large in a broadcast
    asked = staged(asked.join(classes.hint("merge"), "vec").select("query_id", F.col("c").alias("q")), "queries")
    q_vectors = classes.join(asked.select(F.col("q").alias("c")).distinct(), "c", "semi").select("c", "vec")

    all_blocks, n_blocks = _blocks(classes.select("c", "vec"), BLOCK, "block")
    all_blocks = staged(all_blocks, "blocks")
    q_blocks, _ = _blocks(q_vectors, QUERY_BLOCK, "q_block")
    q_blocks = staged(q_blocks.select("q_block", F.col("c").alias("q"), F.col("vec").alias("q_vec")), "blocks")
    to_all = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block")

    # shuffled by block: a broadcast of the repeated queries would grow with queries times blocks
    lists = q_blocks.select("q", "q_vec", to_all).join(all_blocks.hint("merge"), "block").select("q", "q_vec", "c", "vec")
    low_columns = [f"low{s}" for s in range(SLICES)]
    lists = staged(lists.mapInArrow(_local_lists(width, keep), "q long, c long, total long, " + ", ".join(f"{c} long" for c in low_columns)), "lists")
    lows = lists.groupBy("q").agg(*[F.min(c).alias(c) for c in low_columns])
    best = lists.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("total"), "c"))).filter(F.col("rank") <= keep)
    bound = best.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("bound"))
    low_sum = sum((F.col(c) for c in low_columns), F.lit(0))
    share = F.floor((F.col("bound") - low_sum) / SLICES)
    # fewer than k + 1 candidates so far: no bound, everything is reported
    cutoffs = lows.join(bound, "q").select("q", "bound", F.array(*[F.when(F.col("n") >= keep, F.col(c) + share).otherwise(F.col(c)) for c in low_columns]).alias("cutoffs"))
    cutoffs = staged(cutoffs, "cutoffs")
    with_cuts = q_blocks.select("q_block", F.explode(F.arrays_zip("q", "q_vec")).alias("one")).select("q_block", "one.q", "one.q_vec")
    with_cuts = with_cuts.join(cutoffs, "q").groupBy("q_block").agg(F.collect_list(F.struct("q", "q_vec", "cutoffs", "bound")).alias("all"))
    with_cuts = with_cuts.select(*[F.col(f"all.{c}").alias(n) for c, n in (("q", "q"), ("q_vec", "q_vec"), ("cutoffs", "cutoffs"), ("bound", "bounds"))], to_all)
    entries = with_cuts.join(all_blocks.hint("merge"), "block").select("q", "q_vec", "cutoffs", "bounds", "c", "vec")
    scores = staged(entries.mapInArrow(_entries(width), "q long, c long, score long"), "entries").join(classes.select("c", "first_id"), "c")
    top = scores.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first_id"))).filter(F.col("rank") <= keep)
    members = top.select("q", "c", "score").join(ids.select("c", "vec_id"), "c")
    members = members.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= keep)
    again = F.row_number().over(Window.partitionBy("q", "c", "vec_id").orderBy("rank"))
    members = members.withColumn("again", again)
    found = asked.join(members, "q").filter(~((F.col("vec_id") == F.col("query_id")) & (F.col("c") == F.col("q")) & (F.col("again") == 1)))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
