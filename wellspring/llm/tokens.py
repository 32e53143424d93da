"""Words, hashes and shingles of whole Arrow text batches, in NumPy.

A word is a run of characters other than space and U+0009 to U+000D. None of
these is part of a longer UTF-8 sequence, so words are cut on bytes, for a batch
of texts at once, without a Python object per word. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MASK = np.array([2 ** (8 * i) - 1 for i in range(9)], np.uint64)
_SEPARATOR = np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
SHINGLE = 5


@dataclass
class Words:
    """The words of some texts: byte ranges, the text each belongs to, and each text's first word."""

    data: np.ndarray  # bytes of the texts, one after another
    offsets: np.ndarray  # n + 1 byte positions
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray  # n + 1 word positions

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for slices of a string column with about ``limit`` bytes; a longer text stands alone.

    Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's first byte begins a word whatever stands before it
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    first = np.searchsorted(start, offsets, "left")
    return Words(data, offsets, start, end, text, first)


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z lower-cased, all else as it is."""
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _P2
    return h ^ (h >> np.uint64(29))


def word_hashes(words: Words) -> np.ndarray:
    """Eight bytes of every word at a time, each mixed into the word's hash."""
    size = words.end - words.start
    h = mix(size.astype(np.uint64) * _P1)
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    active = np.arange(len(size))
    done = 0
    while len(active):
        left = np.minimum(size[active] - done, 8)
        piece = eight[words.start[active] + done] & _MASK[left]
        h[active] = mix((h[active] ^ piece) * _P1)
        done += 8
        active = active[size[active] > done]
    return h


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of h[i], ..., h[i + k - 1] for every i where they exist."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        out = (out ^ h[j : len(h) - k + 1 + j]) * _P1
        out ^= out >> np.uint64(32)
    return mix(out)


def shingle_hashes(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All k-word shingles of every text: hashes, and n + 1 positions of each text's first.

    A text with 1 to k - 1 words has its whole sequence as the only shingle.
    """
    h = word_hashes(words)
    counts = np.diff(words.first)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    whole = words.text[: max(len(h) - k + 1, 0)] == words.text[k - 1 :]
    out = runs(h, k)[whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        alone = [runs(h[words.first[i] : words.first[i + 1]], int(counts[i]))[0] for i in short]
        out = np.insert(out, first[short] - np.arange(len(short)), np.array(alone, np.uint64))
    return out, first


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed longs."""
    a, b = np.frombuffer(hashlib.blake2b(values.tobytes(), digest_size=16).digest(), np.int64)
    return int(a), int(b)
