"""Probabilistic suffix tree over characters, and the word unigram base.

The tree predicts the next byte of a text (words lower-cased, one blank between,
then an end) from the longest retained context. Contexts of every length come
from counts over all training texts: one pass a length, growing those seen in at
least ``LEAST_SHARE`` of all places, so a length has at most 1 / LEAST_SHARE of
them and the tree a fixed bound. A context stays if its next-symbol counts
diverge from its parent's distribution by more bits than it costs, or if a longer
one built on it does. Its distribution is smoothed with its parent's.

The score is over the base's events: the training words, one event for any unseen
word, and the end. The tree alone decides, from what stands before, whether the
text ends and which first two symbols the next word has (a class; the second may
be the word's terminator): there its contexts reach across words. Within a class,
where they would show the word's own beginning alone, a known word has its share
of the class's training tokens. An unseen word has the mass that words seen once
give it among words of equal first byte, summed over the tree's probabilities of
the first byte.

The base needs every word's count. The most frequent words are broadcast (a fixed
number); the others meet their counts in a join, one row an occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.store import staged
from wellspring.llm.tokens import Words, lower, text_chunks, word_hashes, words_of

SYMBOLS = 257  # 0: text boundary, else byte + 1
DEPTH = 4
LEAST_SHARE = 1 / 4096
GAIN_BITS, BITS_A_SYMBOL = 64.0, 12.0
PARENT_WEIGHT = 20.0
LEAST_UNSEEN, MOST_UNSEEN = 1e-4, 0.5
CLASSES = 1 << 16  # the first two bytes of a word, 32 for a second one that is missing
FREQUENT_WORDS = 1 << 18
FLUSH = 4_000_000
_LN10 = float(np.log(10))


def symbols_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, each ended by 0, and n + 1 positions of their first symbols."""
    counts = np.diff(words.first)
    size = words.end - words.start
    begin = np.cumsum(size + 1) - size - 1
    total = int(begin[-1] + size[-1] + 1) if len(size) else 0
    source = np.arange(total) + np.repeat(words.start - begin, size + 1)
    out = np.append(words.data, np.uint8(32))[source].astype(np.int32) + 1
    out[begin + size] = 33
    ends = np.concatenate([begin, [total]])
    out[ends[words.first[1:][counts > 0]] - 1] = 0
    empty = np.flatnonzero(counts == 0)
    out = np.insert(out, ends[words.first[empty]], 0)
    lengths = ends[words.first[1:]] - ends[words.first[:-1]]
    lengths[empty] = 1
    return out, np.concatenate([[0], np.cumsum(lengths)])


class Tree:
    """Contexts as nodes of a trie read backwards: ``child[node, symbol]`` puts a symbol before the context."""

    def __init__(self):
        self.child = np.full((1, SYMBOLS), -1, np.int32)
        self.parent = np.array([-1])
        self.oldest = np.array([-1])
        self.depth = np.array([0])
        self.counts = np.zeros((1, SYMBOLS), np.int64)

    def grow(self, wanted: list[tuple[int, int]]) -> int:
        """Adds (node, symbol before it); returns the first new node."""
        first = len(self.parent)
        for i, (node, symbol) in enumerate(wanted):
            self.child[node, symbol] = first + i
        nodes, symbols = (np.array([w[j] for w in wanted], np.int64) for j in (0, 1))
        self.child = np.vstack([self.child, np.full((len(wanted), SYMBOLS), -1, np.int32)])
        self.parent, self.oldest = np.concatenate([self.parent, nodes]), np.concatenate([self.oldest, symbols])
        self.depth = np.concatenate([self.depth, self.depth[nodes] + 1])
        self.counts = np.vstack([self.counts, np.zeros((len(wanted), SYMBOLS), np.int64)])
        return first

    def context(self, node: int) -> tuple[int, ...]:
        """Oldest symbol first."""
        out = []
        while node > 0:
            out.append(int(self.oldest[node]))
            node = int(self.parent[node])
        return tuple(out)


def states(child: np.ndarray, s: np.ndarray, depth: int, exact: bool) -> np.ndarray:
    """For every place the node of its context: of ``depth`` symbols or -1 (``exact``), else of the longest one."""
    node = np.zeros(len(s), np.int32)
    live = np.arange(len(s), dtype=np.int64)
    best = node.copy()
    for back in range(1, depth + 1):
        before = live - back
        previous = np.where(before >= 0, s[np.maximum(before, 0)], 0 if back == 1 else -1)
        following = np.where(previous >= 0, child[node[live], previous], -1)
        going = following >= 0
        live = live[going]
        node[live] = following[going]
        best[live] = node[live]
        if not len(live):
            break
    if not exact:
        return best
    out = np.full(len(s), -1, np.int32)
    out[live] = node[live]
    return out


def classes_of(words: Words) -> np.ndarray:
    """The class of every word: its first two bytes, or its only one and a blank."""
    second = words.data[np.minimum(words.start + 1, max(len(words.data) - 1, 0))]
    return words.data[words.start].astype(np.int32) * 256 + np.where(words.end - words.start > 1, second, 32)


def _first_pass(batches):
    """(kind, key, n, class) of training texts: 0 word counts, 1 symbol pairs, 2 texts."""

    def rows(kind, keys, n, of=None):
        of = np.zeros(len(keys), np.int32) if of is None else of
        return pa.record_batch([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(n), pa.array(of)], ["kind", "key", "n", "class"])

    pairs, texts = np.zeros(SYMBOLS * SYMBOLS, np.int64), 0
    held: list[np.ndarray] = []
    held_classes: list[np.ndarray] = []
    waiting = 0

    def counted():
        keys, where, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        return rows(0, keys.view(np.int64), n.astype(np.int64), np.concatenate(held_classes)[where])

    for batch in batches:
        texts += batch.num_rows
        for _, data, offsets in text_chunks(batch.column(0)):
            words = words_of(lower(data), offsets)
            s, _ = symbols_of(words)
            pairs += np.bincount(np.concatenate([[0], s[:-1]]) * SYMBOLS + s, minlength=len(pairs))
            held.append(word_hashes(words))
            held_classes.append(classes_of(words))
            waiting += len(held[-1])
            if waiting >= FLUSH:
                yield counted()
                held, held_classes, waiting = [], [], 0
    if waiting:
        yield counted()
    used = np.flatnonzero(pairs)
    yield rows(1, used, pairs[used])
    yield rows(2, np.zeros(1, np.int64), np.array([texts], np.int64))


def _count_pass(child: np.ndarray, first: int, depth: int):
    """(key, n): next symbols after the contexts of ``depth`` symbols, nodes counted from ``first``."""

    def run(batches):
        tree = child.value
        hits = np.zeros((len(tree) - first) * SYMBOLS, np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                s, _ = symbols_of(words_of(lower(data), offsets))
                node = states(tree, s, depth, True)
                at = np.flatnonzero(node >= 0)
                hits += np.bincount((node[at].astype(np.int64) - first) * SYMBOLS + s[at], minlength=len(hits))
        used = np.flatnonzero(hits)
        yield pa.record_batch([pa.array(used), pa.array(hits[used])], ["key", "n"])

    return run


def _learn(texts: DataFrame, pairs: np.ndarray) -> Tree:
    """The tree over all training texts. ``pairs``: counts of (symbol before, symbol)."""
    spark = texts.sparkSession
    tree = Tree()
    tree.counts[0] = pairs.sum(axis=0)
    least = max(2.0, float(pairs.sum()) * LEAST_SHARE)
    first = tree.grow([(0, int(a)) for a in np.flatnonzero(pairs.sum(axis=1) >= least)])
    tree.counts[first:] = pairs[tree.oldest[first:]]
    for depth in range(2, DEPTH + 1):
        # a longer context's own count is its string's count as context and next symbol, one symbol shorter
        of = {tree.context(v): v for v in range(first, len(tree.parent))}
        wanted = []
        for v, context in ((v, c) for c, v in of.items()):
            for symbol in np.flatnonzero(tree.counts[v] >= least):
                suffix = of.get((*context[1:], int(symbol)))
                if suffix is not None and symbol != 0:
                    wanted.append((suffix, context[0]))
        if not wanted:
            break
        first = tree.grow(sorted(wanted))
        child = spark.sparkContext.broadcast(tree.child)
        found = texts.mapInArrow(_count_pass(child, first, depth), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        tree.counts[first:].reshape(-1)[found["key"].to_numpy()] = found["n"].to_numpy()
    return tree


def distributions(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(child, log10 p) of the retained contexts."""
    root = tree.counts[0] + 0.5
    p = np.zeros(tree.counts.shape)
    p[0] = root / root.sum()
    keep = np.zeros(len(p), bool)
    for v in range(1, len(p)):
        # the parent in the tree of suffixes: the context without its oldest symbol
        up = tree.parent[v]
        n = tree.counts[v]
        p[v] = (n + PARENT_WEIGHT * p[up]) / (n.sum() + PARENT_WEIGHT)
        if n.sum():
            seen = n > 0
            bits = float((n[seen] * np.log2(n[seen] / n.sum() / p[up][seen])).sum())
            keep[v] = bits >= GAIN_BITS + BITS_A_SYMBOL * seen.sum()
    keep[0] = True
    for v in range(len(p) - 1, 0, -1):
        keep[tree.parent[v]] |= keep[v]
    number = np.cumsum(keep) - 1
    child = tree.child[keep]
    child = np.where(child >= 0, np.where(keep[child], number[child], -1), -1).astype(np.int32)
    return child, np.log10(p[keep]).astype(np.float32)


def _log_add(a, b):
    """log10(10**a + 10**b)"""
    return np.logaddexp(a * _LN10, b * _LN10) / _LN10


def token_logs(words: Words, s: np.ndarray, first: np.ndarray, state: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tree's log10 probabilities: that a word follows, of every word's class after that, and of every text's end; and the state before each word.

    After a word stands a blank or the end: that it is one of them belongs to the
    word, and which one to the next token.
    """
    p = logp[state, s].astype(np.float64)
    size = words.end - words.start
    counts = np.diff(words.first)
    ends = np.concatenate([[0], np.cumsum(size + 1)])
    stop = first[words.text] + ends[1:] - ends[words.first[words.text]] - 1  # places of the terminators
    blank, end = logp[state[stop], 33].astype(np.float64), logp[state[stop], 0].astype(np.float64)
    either = _log_add(blank, end)
    begin = stop - size
    logs = p[begin] + np.where(size > 1, p[np.minimum(begin + 1, max(len(p) - 1, 0))], either)
    follows = np.zeros(len(size))
    later = np.flatnonzero(np.arange(len(size)) > words.first[:-1][words.text])
    follows[later] = blank[later - 1] - either[later - 1]
    end_logs = np.zeros(words.n)
    last = words.first[1:][counts > 0] - 1
    end_logs[counts > 0] = end[last] - either[last]
    end_logs[counts == 0] = p[first[:-1][counts == 0]]
    return follows, logs, end_logs, state[begin]


def class_shares(tokens: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each class's training ``tokens`` and words seen ``once``: log10 of one occurrence's probability in the class, and of each first byte the mass of unseen words."""
    by_byte, once_by_byte = tokens.reshape(256, 256).sum(axis=1), once.reshape(256, 256).sum(axis=1)
    total = by_byte.sum()
    unseen = once.sum() / total if total else 1.0
    rates = np.clip((once_by_byte + PARENT_WEIGHT * unseen) / (by_byte + PARENT_WEIGHT), LEAST_UNSEEN, MOST_UNSEEN)
    rates[by_byte == 0] = 1.0  # every such word is unseen
    shares = np.log10(np.maximum(1 - rates, 1e-300))[:, None] - np.log10(np.maximum(tokens, 1)).reshape(256, 256)
    return shares.reshape(-1), rates


def _score_pass(model):
    """Rows of texts (kind 0) and of their less frequent words (kind 1: log10 as an unseen word in ``logs``, but for its count as a known one in ``score``)."""

    names = ["kind", "serial", "doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "word"]

    def run(batches):
        child, logp, frequent, counts, shares, unseen = model.value
        for batch in batches:
            n = batch.num_rows
            tokens, known, logs, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            serial = batch.column(0).to_numpy()
            for row, data, offsets in text_chunks(batch.column(3)):
                words = words_of(lower(data), offsets)
                here = slice(row, row + words.n)
                s, first = symbols_of(words)
                state = states(child, s, DEPTH, False)
                follows, by_tree, end_logs, before = token_logs(words, s, first, state, logp)
                as_known = follows + by_tree + shares[classes_of(words)]
                as_unseen = follows + unseen[before]
                h = word_hashes(words)
                at = np.minimum(np.searchsorted(frequent, h), max(len(frequent) - 1, 0))
                hit = frequent[at] == h if len(frequent) else np.zeros(len(h), bool)
                of = words.text[hit]
                tokens[here] = np.diff(words.first) + 1
                known[here] = np.bincount(of, minlength=words.n)
                logs[here] = np.bincount(of, np.log10(counts[at[hit]] + 0.5), minlength=words.n)
                score[here] = np.bincount(of, as_known[hit] + np.log10(counts[at[hit]]), minlength=words.n)
                score[here] += end_logs
                rare = np.flatnonzero(~hit)
                m = len(rare)
                if m:
                    yield pa.record_batch(
                        [
                            pa.array(np.ones(m, np.int8)),
                            pa.array(serial[row + words.text[rare]]),
                            *[pa.nulls(m, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64())],
                            pa.array(as_unseen[rare]),
                            pa.array(as_known[rare]),
                            pa.array(h[rare].view(np.int64)),
                        ],
                        names,
                    )
            yield pa.record_batch(
                [
                    pa.array(np.zeros(n, np.int8)),
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    *[pa.array(v) for v in (tokens, known, logs, score)],
                    pa.nulls(n, pa.int64()),
                ],
                names,
            )

    return run


def fold(id_col: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def suffix_tree_scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learns from rows whose fold of 5 is not 1. A null, empty or wordless text is
    one token, the end. Without training rows all counts are 0. ``score`` is the
    model's log10 probability of the text, a sum over its words and the end.
    Repeated rows and null ids give rows like any other (a null id is a training
    row). Other columns are not read. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("held_out", fold("doc_id", 5) == 1)
    train = docs.filter(~F.col("held_out")).select("text")
    first = staged(train.mapInArrow(_first_pass, "kind byte, key long, n long, class int"), "counts")
    words = staged(first.filter("kind = 0").groupBy("key").agg(F.sum("n").alias("n"), F.min("class").alias("class")), "words")
    table = first.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    pairs[table["key"].to_numpy()] = table["n"].to_numpy()
    n_texts = first.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    # at most CLASSES rows
    found = words.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("once")).toArrow()
    tokens, once = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    tokens[found["class"].to_numpy()], once[found["class"].to_numpy()] = found["n"].to_numpy(), found["once"].to_numpy()
    n_words, distinct = int(tokens.sum()), int(found["kinds"].to_numpy().sum())
    total, vocabulary = n_words + n_texts, distinct + (n_texts > 0)
    log_all = float(np.log10(total + 0.5 * (vocabulary + 1)))

    child, logp = distributions(_learn(train, pairs.reshape(SYMBOLS, SYMBOLS)))
    shares, rates = class_shares(tokens, once)
    unseen = np.log10((10.0 ** logp[:, 1:].astype(np.float64)) @ rates)  # after each context
    top = words.orderBy(F.desc("n"), "key").limit(FREQUENT_WORDS).toArrow()
    keys, counts = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(keys)
    model = docs.sparkSession.sparkContext.broadcast((child, logp, keys[order], counts[order], shares, unseen))
    scored = docs.select(F.monotonically_increasing_id().alias("serial"), "doc_id", "held_out", "text").mapInArrow(
        _score_pass(model),
        "kind byte, serial long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, word long",
    )
    scored = staged(scored, "scores")
    rare = scored.filter("kind = 1").select("serial", F.col("word").alias("key"), "logs", "score").join(words.select("key", "n"), "key", "left")
    rare = rare.groupBy("serial").agg(
        F.count("n").alias("rare_known"),
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"),
        F.sum(F.coalesce(F.col("score") + F.log10("n"), F.col("logs"))).alias("rare_score"),
    )
    end = float(np.log10(n_texts + 0.5))
    of_doc = scored.filter("kind = 0").join(rare, "serial", "left")
    return of_doc.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + end - F.col("n_tokens") * log_all).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
