"""Secrets: base patterns, and zstandard novelty of strings in a sensitive context.

A candidate is a string of key characters shortly after a sensitive word, on its
line or the next, or one that follows a reported candidate after blanks only (a
key over several lines). Its novelty is what it adds to the compressed size of
the text around it, with a dictionary of identifiers and of the corpus's common
words primed into the compressor: names and prose are found in the dictionary or
in the surroundings and add few bytes, random strings add nearly all of theirs.

A long random string of few kinds of characters compresses for its alphabet
alone. So a candidate is measured in pieces too short for that, each against the
surroundings, and as a whole against the bytes its alphabet needs: the pieces
tell names from random strings, the whole tells random strings from repetition.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.spans import Covered, Span, digest, listed

KINDS = ["assign", "access", "hex", "novel"]
WORD_SHARE = 1e-4  # of all words, for a place in the dictionary: at most 10,000 words
WORD_BYTES = 64
LEVEL = 19
NOVELTY, LEAST_BYTES = 0.8, 12
REACH = 48  # characters between the sensitive word and a candidate
PIECE = 32  # characters measured at once
AROUND = 1024  # characters of surroundings on each side
_SEPARATORS = r"[\x20\x09-\x0D]+"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_SENSITIVE = re.compile(
    r"passwords?|passwd|passphrase|pwd|secrets?|tokens?|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?|bearer|authorization", re.A | re.I
)
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]+")
# names that code has around values, part of the dictionary
_NAMES = (
    "password passwd secret token api_key apikey access_key secret_key private_key client_id client_secret username user_name "
    "authorization bearer credentials config settings environment production development default example placeholder changeme "
    "string integer boolean return function import from export const public private static class self this null none true false "
    "http https www com org net localhost host port path file name value key id uuid session cookie header request response"
)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class Compressed:
    """Compressed sizes of texts with a dictionary of given content."""

    def __init__(self, content: str):
        primed = zstandard.ZstdCompressionDict(_bytes(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_checksum=False, write_content_size=False)
        self.least = len(self.compressor.compress(b""))

    def added(self, text: str) -> int:
        return len(self.compressor.compress(_bytes(text))) - self.least


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Novelty:
    """Marginal compressed bytes against the corpus's words, and against names and the surroundings.

    Both are dictionaries, not text before the candidate: what is random in the
    surroundings would lend its letter code to the candidate.
    """

    def __init__(self, words: list[str]):
        self.corpus = Compressed(" ".join([*words, _NAMES]))

    def novel(self, around: str, candidate: str) -> bool:
        n = len(candidate)
        cuts = [*range(0, max(n - LEAST_BYTES, 0) + 1, PIECE), n]  # a short rest stays with the piece before it
        pieces = [candidate[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        least = max(LEAST_BYTES, NOVELTY * n)
        fresh = [self.corpus.added(p) for p in pieces]
        if sum(fresh) < least:
            return False
        local = Compressed(f"{_NAMES} {around}")
        if sum(min(x, local.added(p)) for x, p in zip(fresh, pieces, strict=True)) < least:
            return False
        bits = math.log2(len(set(candidate)))
        return len(pieces) == 1 or local.added(candidate) >= NOVELTY * n * bits / 8


def novel_spans(novelty: Novelty, text: str, base: list[Span]) -> list[Span]:
    """Novel candidates clear of the ``base`` spans (sorted by start), in time linear in the text."""
    words = [m.end() for m in _SENSITIVE.finditer(text)]
    if not words:
        return []
    known = Covered(base)
    out: list[Span] = []
    word, reported = 0, -1  # the first sensitive word after the last run's end, the end of the last run if reported
    for m in _RUN.finditer(text):
        a = m.start()
        while word < len(words) and words[word] <= a:
            word += 1
        follows = 0 <= reported and not text[reported:a].strip() if a - reported <= REACH else False
        if not (word and a - words[word - 1] <= REACH) and not follows:
            # a run that holds a sensitive word is a candidate from there on
            if word == len(words) or words[word] >= m.end():
                continue
            a = words[word]
        reported = -1
        b = m.end()
        while b > a and text[b - 1] in ".-=" and text[b - 1 : b + 1] != "==":
            b -= 1
        piece = text[a:b]
        mixed = any(ch.isdigit() for ch in piece) and any(ch.isalpha() for ch in piece)
        if len(piece) < LEAST_BYTES or not mixed or not known.clear(a, b):
            continue
        around = text[max(0, a - AROUND) : a] + "\n" + text[b : b + AROUND]
        if novelty.novel(around.replace(piece, " "), piece):
            out.append((a, 3, b))
            reported = b
    return out


def dictionary_words(docs: DataFrame) -> list[str]:
    """The corpus's words with at least WORD_SHARE of all words, rarer ones first."""
    words = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), _SEPARATORS)).alias("word")).filter("word != ''")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = docs.select(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), _SEPARATORS)))).first()[0] or 0
    common = counts.filter((F.col("n") >= total * WORD_SHARE) & (F.octet_length("word") <= WORD_BYTES)).toPandas()
    return common.sort_values(["n", "word"])["word"].tolist()


def _find_pass(words: list[str]):
    def run(batches):
        novelty = Novelty(words)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                every = base + novel_spans(novelty, text, base)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*counts, digest(listed(base, KINDS)), listed(every, KINDS)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of base spans, their digest, and all spans.

    A null text counts as empty: no spans, the digest of the empty string.
    Repeated rows and null ids give rows like any other. A span is the whole
    match, offsets are code points, the end exclusive. A string that stands in
    its surroundings once more is as novel as one that does not. The dictionary
    comes from all texts, the time is linear in a text's length. An empty table gives no rows; other columns are not read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(
        _find_pass(dictionary_words(own)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
