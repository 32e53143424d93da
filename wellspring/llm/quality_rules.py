"""Quality rules: repeated windows and lines, and divergence from the language's own distributions.

Two histograms of a document are compared with references of its language by
Jensen-Shannon distance: characters by class, and words by the language's common
words (those with at least ``COMMON_SHARE`` of its words, so at most
1 / COMMON_SHARE of them) with all others as one. References are sums over the
whole corpus, one for every language. Those of languages with at least
``LANGUAGE_SHARE`` of all words are broadcast, which bounds their number; any
other reference is a row that goes to the language's documents in a shuffle and
is sorted before them. A document is rejected when a distance passes its limit
and it is long enough for the histogram to mean something.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm.store import staged
from wellspring.llm.tokens import runs, text_chunks, word_hashes, words_of

WINDOW = 5
COMMON_SHARE = 0.002  # of a language's words
LANGUAGE_SHARE = 0.01  # of all words, for a broadcast reference
CLASSES = ["lower", "upper", "digit", "blank", "stop", "mark", "symbol", "other"]
LEAST_CHARS, LEAST_WORDS = 200, 50
CHAR_LIMIT, WORD_LIMIT = 0.32, 0.46
_SEPARATORS = r"[\x20\x09-\x0D]+"

_CLASS = np.full(256, 7, np.int64)  # bytes of other scripts and control characters; UTF-8 tails are not counted
for _i, _chars in enumerate(
    ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", ".,;:", "!?'\"()-", "#*$%&|<>"]
):
    _CLASS[list(_chars.encode())] = _i
_CLASS[0x80:0xC0] = len(CLASSES)
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n)."""
    words = docs.select("lang", F.explode(F.split(F.coalesce("text", F.lit("")), _SEPARATORS)).alias("word")).filter("word != ''")
    return staged(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")


def common_words(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, word, share): the common words of the languages in ``sizes`` (lang, in_lang)."""
    found = counts.join(sizes, counts["lang"].eqNullSafe(sizes["lang"])).drop(sizes["lang"])
    return found.filter(F.col("n") >= F.col("in_lang") * COMMON_SHARE).select("lang", "word", (F.col("n") / F.col("in_lang")).alias("share"))


def _is_one_of(langs: list[str | None]) -> Column:
    named = F.coalesce(F.col("lang").isin([x for x in langs if x is not None]), F.lit(False))
    return named | F.col("lang").isNull() if None in langs else named


def _distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2: 0 for equal distributions, 1 for disjoint ones."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(parts.sum() / 2, 0)))


def _hash_of(words: list[str]) -> np.ndarray:
    spans = [(r, word_hashes(words_of(d, o))) for r, d, o in text_chunks(pa.array(words, pa.large_string()))]
    return np.concatenate([h for _, h in spans]) if spans else np.zeros(0, np.uint64)


def _sorted_reference(words: list[str], shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in order, and their shares with that of all others."""
    h = _hash_of(words)
    order = np.argsort(h)
    return h[order], np.append(shares[order], max(0.0, 1 - shares.sum()))


def _measure_pass(references: dict):
    """Base columns, the character classes and the word distance of every text.

    Batches have (doc_id, text, lang), and may have (words, shares) too: rows
    where these are set are references, before all texts of their language.
    """

    def run(batches):
        sorted_refs = {lang: _sorted_reference(*r) for lang, r in references.items()}
        last = None
        for batch in batches:
            if batch.num_columns > 3:
                sorted_refs = {} if last is None else {last: sorted_refs[last]}
                given = batch.filter(batch.column(3).is_valid())
                for lang, words, shares in zip(*(given.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    sorted_refs[lang], last = _sorted_reference(words, np.array(shares, float)), lang
                batch = batch.filter(batch.column(3).is_null())
            n = batch.num_rows
            out = {c: np.zeros(n, np.int64) for c in ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]}
            classes = np.zeros((n, len(CLASSES)), np.int64)
            distance = np.full(n, np.nan)
            langs = batch.column(2).to_pylist()
            for row, data, offsets in text_chunks(batch.column(1)):
                w = words_of(data, offsets)
                h = word_hashes(w)
                lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                here = slice(row, row + w.n)
                chars = np.concatenate([[0], np.cumsum(lead[w.end] - lead[w.start])])
                symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
                out["n_words"][here] = np.diff(w.first)
                out["word_chars"][here] = np.diff(chars[w.first])
                out["n_symbols"][here] = np.diff(symbols[offsets])
                kind = _CLASS[data]
                window = runs(h, WINDOW)
                for i in range(w.n):
                    a, b = w.first[i], w.first[i + 1]
                    text = data[offsets[i] : offsets[i + 1]]
                    classes[row + i] = np.bincount(kind[offsets[i] : offsets[i + 1]], minlength=len(CLASSES) + 1)[:-1]
                    if b > a:
                        out["n_dup_lines"][row + i] = _repeated_lines(text.tobytes())
                        out["n_repeat_words"][row + i] = _repeated_words(window[a : max(a, b - WINDOW + 1)], b - a)
                    if b > a and langs[row + i] in sorted_refs:
                        known, share = sorted_refs[langs[row + i]]
                        at = np.minimum(np.searchsorted(known, h[a:b]), max(len(known) - 1, 0))
                        at = np.where(known[at] == h[a:b], at, len(known)) if len(known) else np.zeros(b - a, np.int64)
                        distance[row + i] = _distance(np.bincount(at, minlength=len(share)) / (b - a), share)
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    *[pa.array(v) for v in out.values()],
                    pa.array(list(classes), pa.list_(pa.int64())),
                    pa.array(distance, mask=np.isnan(distance)),
                ],
                ["doc_id", "lang", *out, "classes", "word_distance"],
            )

    return run


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def _repeated_words(window: np.ndarray, n: int) -> int:
    """Word places covered by windows that occur at least twice."""
    order = np.argsort(window, kind="stable")
    s = window[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    covered = np.zeros(n + WINDOW, np.int64)
    covered[order[twice]] += 1
    covered[order[twice] + WINDOW] -= 1
    return int((np.cumsum(covered[:n]) > 0).sum())


def _reference_rows(counts: DataFrame) -> DataFrame:
    """(lang, words, shares): one row for every language of ``counts``; at most 1 / COMMON_SHARE words each."""
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("in_lang"))
    words = common_words(counts, sizes).groupBy(F.col("lang").alias("of")).agg(F.collect_list(F.struct("word", "share")).alias("found"))
    found = sizes.join(words, F.col("lang").eqNullSafe(F.col("of")), "left")
    pairs = F.coalesce("found", F.array().cast("array<struct<word:string,share:double>>"))
    return found.select("lang", F.transform(pairs, lambda x: x["word"]).alias("words"), F.transform(pairs, lambda x: x["share"]).alias("shares"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): the base columns, two distances and the verdict ``kept``.

    ``base_failed``: fewer than 10 words, or more than a fifth of them inside
    5-word windows that occur twice or more. ``kept`` is false for these, and
    for texts of at least ``LEAST_CHARS`` characters whose ``char_distance``
    passes ``CHAR_LIMIT``, or of at least ``LEAST_WORDS`` words whose
    ``word_distance`` passes ``WORD_LIMIT``. A null or empty text has no words.
    Null is a language of its own. A language without a word or a character has
    no reference, the distance is null and rejects nothing. A null id and
    repeated rows give rows like any other. An empty table gives no rows. Other
    columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = word_counts(docs)
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("in_lang"))
    total = sizes.agg(F.sum("in_lang")).scalar()
    large = sizes.filter(F.col("in_lang") >= total * LANGUAGE_SHARE)
    langs = [r.lang for r in large.select("lang").collect()]  # at most 1 / LANGUAGE_SHARE
    references: dict = {lang: ([], []) for lang in langs}
    for r in common_words(counts, F.broadcast(large)).orderBy("lang", "word").collect():  # for each at most 1 / COMMON_SHARE
        references[r.lang][0].append(r.word)
        references[r.lang][1].append(r.share)
    references = {lang: (words, np.array(shares, float)) for lang, (words, shares) in references.items()}
    others = counts.filter(~_is_one_of(langs))
    measures = (
        "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "classes array<long>, word_distance double"
    )
    if others.isEmpty():
        measured = docs.mapInArrow(_measure_pass(references), measures)
    else:
        measured = docs.filter(_is_one_of(langs)).mapInArrow(_measure_pass(references), measures)
        rest = docs.filter(~_is_one_of(langs)).unionByName(_reference_rows(others), allowMissingColumns=True)
        # none of these languages is large, so none is a hot key
        rest = rest.repartition("lang").sortWithinPartitions("lang", F.col("words").isNull())
        measured = measured.unionByName(rest.mapInArrow(_measure_pass({}), measures))
    measured = staged(measured, "measures")
    n_classes = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    of_lang = sum((F.col(f"c{i}") for i in range(len(CLASSES))), F.lit(0))
    refs = measured.groupBy("lang").agg(*n_classes).filter(of_lang > 0)
    refs = refs.select(F.col("lang").alias("ref_lang"), F.array(*[F.col(f"c{i}") / of_lang for i in range(len(CLASSES))]).alias("ref"), _is_one_of(langs).alias("large"))
    same = F.col("lang").eqNullSafe(F.col("ref_lang"))
    joined = measured.filter(_is_one_of(langs)).join(F.broadcast(refs.filter("large")), same, "left")  # at most 1 / LANGUAGE_SHARE rows
    joined = joined.unionByName(measured.filter(~_is_one_of(langs)).join(refs.filter("not large"), same, "left"))
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    joined = joined.withColumn("n_chars", chars)
    parts = F.lit(0.0)
    for i in range(len(CLASSES)):
        p, q = F.col("classes")[i] / F.col("n_chars"), F.col("ref")[i]
        m = (p + q) / 2
        parts = parts + F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    distance = F.when(F.col("ref").isNotNull() & (F.col("n_chars") > 0), F.sqrt(F.greatest(parts / 2, F.lit(0.0))))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    odd = ((F.col("n_chars") >= LEAST_CHARS) & (F.coalesce("char_distance", F.lit(0.0)) > CHAR_LIMIT)) | (
        (F.col("n_words") >= LEAST_WORDS) & (F.coalesce("word_distance", F.lit(0.0)) > WORD_LIMIT)
    )
    return joined.withColumn("char_distance", distance).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~odd).alias("kept"),
        "char_distance",
        "word_distance",
    )
