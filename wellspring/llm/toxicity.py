"""Toxicity by subword-bag embeddings, averaged into a linear softmax.

A word is its own feature and the bag of its character 3- to 5-grams, hashed to
``BUCKETS`` embedding rows, so an unseen misspelling shares vectors with words
that were learnt. The bag's mean goes through a linear softmax; embeddings and
softmax are trained together in NumPy, with Adam, on a bounded sample of labelled
rows (``SAMPLE`` rows with the least hash of their id). Features are made where
the rows are; a row's bag has at most BUCKETS entries whatever the text's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.store import staged
from wellspring.llm.suffix_tree_lm import fold
from wellspring.llm.tokens import Words, lower, mix, text_chunks, word_hashes, words_of

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
SIZE = 8
SAMPLE = 6_000
STEPS, BATCH, RATE = 1_200, 64, 0.02
THRESHOLD = 0.3
_STRIP = np.isin(np.arange(256), list(b".,;:!?\"'()"))


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and of its character n-grams. Words lose outer punctuation."""
    words = words_of(lower(data), offsets)
    start, end = words.start.copy(), words.end.copy()
    for _ in range(2):
        start += (end - start > 1) & _STRIP[words.data[start]]
        end -= (end - start > 1) & _STRIP[words.data[end - 1]]
    bare = Words(words.data, words.offsets, start, end, words.text, words.first)
    h = word_hashes(bare)
    bucket, text = [(h & np.uint64(BUCKETS - 1)).astype(np.int64)], [words.text]
    size = end - start
    # bytes of every word between two marks
    begin = np.cumsum(size + 2) - size - 2
    total = int(begin[-1] + size[-1] + 2) if len(size) else 0
    of = np.repeat(np.arange(len(size)), size + 2)
    place = np.arange(total) - begin[of]
    inner = (place > 0) & (place <= size[of])
    letters = np.full(total, 1, np.uint64)
    letters[inner] = words.data[start[of[inner]] + place[inner] - 1].astype(np.uint64) + 2
    code = letters.copy()
    for k in range(2, max(GRAMS) + 1):
        code = code[:-1] * np.uint64(263) + letters[k - 1 :] if len(code) > 1 else code[:0]
        if k in GRAMS and len(code):
            whole = of[: len(code)] == of[k - 1 : k - 1 + len(code)]
            bucket.append((mix(code[whole] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) & np.uint64(BUCKETS - 1)).astype(np.int64))
            text.append(words.text[of[: len(code)][whole]])
    return np.concatenate(text), np.concatenate(bucket)


def bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, bucket, count): each text's buckets, ascending, with their counts."""
    text, bucket = subwords(data, offsets)
    key, count = np.unique(text * BUCKETS + bucket, return_counts=True)
    first = np.searchsorted(key, np.arange(len(offsets)) * BUCKETS)
    return first, key % BUCKETS, count


def _bag_pass(batches):
    for batch in batches:
        rows = []
        for _, data, offsets in text_chunks(batch.column(1)):
            first, bucket, count = bags(data, offsets)
            for a, b in zip(first[:-1], first[1:], strict=True):
                rows.append((bucket[a:b].astype(np.int32), count[a:b].astype(np.int32)))
        yield pa.record_batch(
            [batch.column(0), pa.array([r[0].tobytes() for r in rows], pa.binary()), pa.array([r[1].tobytes() for r in rows], pa.binary())],
            ["toxic", "bucket", "count"],
        )


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5):
    """(embeddings, weights, bias) of a two-class softmax over mean embeddings."""
    rng = np.random.default_rng(seed)
    params = [
        rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32),
        np.zeros((SIZE, 2), np.float32) + rng.normal(0, 0.1, (SIZE, 2)).astype(np.float32),
        np.zeros(2, np.float32),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    while step < STEPS:
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            ids = order[at : at + BATCH]
            sizes = np.array([len(rows[i][0]) for i in ids])
            bucket = np.concatenate([rows[i][0] for i in ids]).astype(np.int64)
            share = np.concatenate([rows[i][1] / max(1, rows[i][1].sum()) for i in ids]).astype(np.float32)
            of = np.repeat(np.arange(len(ids)), sizes)
            e, w, b = params
            mean = np.zeros((len(ids), SIZE), np.float32)
            values = e[bucket] * share[:, None]
            for d in range(SIZE):
                mean[:, d] = np.bincount(of, values[:, d], minlength=len(ids))
            p = softmax(mean @ w + b)
            p[np.arange(len(ids)), labels[ids]] -= 1
            p /= len(ids)
            back = (p @ w.T)[of] * share[:, None]
            used, where = np.unique(bucket, return_inverse=True)
            grad_e = np.stack([np.bincount(where, back[:, d], minlength=len(used)) for d in range(SIZE)], axis=1).astype(np.float32)
            step += 1
            for i, (grad, rows_of) in enumerate([(grad_e, used), (mean.T @ p, slice(None)), (p.sum(axis=0), slice(None))]):
                m, v = moments[i]
                m[rows_of] = 0.9 * m[rows_of] + 0.1 * grad
                v[rows_of] = 0.999 * v[rows_of] + 0.001 * grad * grad
                params[i][rows_of] -= RATE * (m[rows_of] / (1 - 0.9**step)) / (np.sqrt(v[rows_of] / (1 - 0.999**step)) + 1e-8)
    return params


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _score_pass(model):
    def run(batches):
        weights, bias = model.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for row, data, offsets in text_chunks(batch.column(2)):
                text, bucket = subwords(data, offsets)
                n = len(offsets) - 1
                total = np.maximum(np.bincount(text, minlength=n), 1)
                x = np.bincount(text, weights[bucket], minlength=n) / total + bias
                score[row : row + n] = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(score)], ["doc_id", "held_out", "score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, score (0 to 1, likelier toxic) and predicted (score >= 0.3).

    Learns from ``labels`` (doc_id, toxic) of rows whose fold of 4 is not 2: of
    these the ``sample`` with the least hash of their id, of a repeated id its
    least text. A null label or id
    teaches nothing. A null, empty or wordless text is an empty bag and gets the
    bias's score. Without labels of both kinds the score is the share of toxic
    ones, or 0. Repeated rows give rows like any other. Other columns are not
    read. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("held_out", fold("doc_id", 4) == 2)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = staged(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labels")
    taught = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    taught = taught.select("toxic", "text")  # at most ``sample`` rows
    table = taught.mapInArrow(_bag_pass, "toxic int, bucket binary, count binary").toArrow()
    rows = [
        (np.frombuffer(a, np.int32), np.frombuffer(c, np.int32))
        for a, c in zip(table["bucket"].to_pylist(), table["count"].to_pylist(), strict=True)
    ]
    y = (table["toxic"].to_numpy() > 0).astype(np.int64)
    order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i][0].tobytes(), rows[i][1].tobytes(), y[i])), np.int64)
    if len(y) and 0 < y.sum() < len(y):
        e, w, b = (p.astype(np.float64) for p in train([rows[i] for i in order], y[order]))
        # a mean goes through the softmax as the mean of each bucket's own part: one number a bucket
        model = docs.sparkSession.sparkContext.broadcast((e @ (w[:, 1] - w[:, 0]), float(b[1] - b[0])))
        scored = docs.select("doc_id", "held_out", "text").mapInArrow(
            _score_pass(model), "doc_id long, held_out boolean, score double"
        )
    else:
        scored = docs.select("doc_id", "held_out", F.lit(float(y.mean()) if len(y) else 0.0).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
