"""Repeated passages across documents, by MinHash banding of paragraphs.

A paragraph is a window of ``WIDTH`` words. Its start is an anchor that depends
on the words around it alone (the least 5-gram hash of every ``GUARANTEE``
consecutive starts), so a passage gets the same paragraphs whatever text it
stands in, lines and sentences notwithstanding: any WIDTH + GUARANTEE - 1 equal
words hold a common one. Paragraphs collide in bands of MinHash values; with
``BANDS`` bands of ``ROWS`` a pair of Jaccard similarity 0.8 meets with
probability 1 - (1 - 0.8**ROWS)**BANDS, above 0.98.

Every paragraph carries the parities of its words over 64 cells. An edit changes
at most two of them, so paragraphs within EDITS edits are within NEAR parities;
so are those whose ends alone differ. A bucket's paragraphs pass by in order and
each is compared with all leaders of the bucket: it is paired with the first that
is NEAR, or leads from then on. A bucket of more than ``LEADERS`` leaders is dealt
out by five parts of the parities, of which NEAR ones share at least one, so that
no pair is left uncompared there either. Where a bucket then has paragraphs of
several components, all NEAR ones of different components are compared. Pairs are verified by exact Jaccard
similarity of 5-word shingles or by edit distance in words, and components of
them are one passage. Nothing is gathered by key.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.store import components, passing, staged
from wellspring.llm.tokens import SHINGLE, lower, mix, runs, text_chunks, word_hashes, words_of

WIDTH, GUARANTEE = 24, 28
BANDS, ROWS = 4, 2
PERCENT, EDITS = 80, 2
NEAR = 2 * EDITS  # word parities in which similar paragraphs may differ
PARTS = np.array([0, 13, 26, 39, 52, 64], np.uint64)  # of the parities: one more than NEAR
LEADERS = 2_000
FEW = 24  # leaders that are looked at one by one
PART = WIDTH // (EDITS + 1)
COMPARED = 4_096  # pairs that are compared at a time
BLOCK_PAIRS = 1 << 19  # pairs of a bucket that are looked at at a time
HELD_ROWS = 20_000  # of whole buckets are looked at together
REACH = GUARANTEE - 1  # words on each side of a paragraph in which a repeat may end
FILTER_BITS = 24  # of a filter that spares a shuffle of all paragraphs; misses nothing
_RNG = np.random.default_rng(8)
_A = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * 2 + 1
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
OUT_ROWS = 100_000


_PLACE = np.uint64((1 << 24) - 1)  # a chunk has fewer words than this, or is cut


def anchors(grams: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places that hold the least gram (by its upper 40 bits) of some GUARANTEE consecutive places of a text, the last of equal ones.

    ``text`` numbers the text of every place, ascending. A text with fewer
    places has one window.
    """
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    # the place is part of the value, so that a minimum names it; doubled up from windows of 1, 2, 4, ...
    offset = np.arange(n) & int(_PLACE)
    keyed = (grams & ~_PLACE) | (_PLACE - offset.astype(np.uint64))
    chosen = np.zeros(n, bool)
    first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    size = np.diff(np.append(first, n))
    if n >= GUARANTEE:
        low, reach = keyed, 1
        while reach * 2 <= GUARANTEE:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        count = n - GUARANTEE + 1
        low = np.minimum(low[:count], low[GUARANTEE - reach : GUARANTEE - reach + count])
        inside = np.flatnonzero(text[:count] == text[GUARANTEE - 1 :])
        found = int(_PLACE) - (low[inside] & _PLACE).astype(np.int64)
        chosen[found + (inside - found + int(_PLACE) // 2 + 1) // (int(_PLACE) + 1) * (int(_PLACE) + 1)] = True
    short = size < GUARANTEE
    if short.any():
        for i in np.flatnonzero(short):
            part = keyed[first[i] : first[i] + size[i]] & ~_PLACE
            chosen[first[i] + size[i] - 1 - int(np.argmin(part[::-1]))] = True
    return np.flatnonzero(chosen)


def _paragraphs(column: pa.Array):
    """By chunk of texts: word hashes, grams, and each paragraph's row, first word (in the chunk and in its text), content and text's length."""
    for row, data, offsets in text_chunks(column):
        words = words_of(lower(data), offsets)
        h = word_hashes(words)
        count = len(h) - WIDTH + 1
        if count <= 0:
            continue
        grams = runs(h, SHINGLE)
        starts = np.flatnonzero(words.text[:count] == words.text[WIDTH - 1 :])
        at = starts[anchors(grams[starts], words.text[starts])]
        content = np.full(len(at), WIDTH, np.uint64)
        for i in range(WIDTH):
            content = mix(content ^ h[at + i])
        text = words.text[at]
        yield h, grams, row + text, at, at - words.first[text], content, np.diff(words.first)[text]


def _beside(h: np.ndarray, place: np.ndarray, room: np.ndarray, step: int) -> pa.Array:
    """One byte for each of up to REACH words from ``place`` on, ``room`` of them in the text, nearest first."""
    size = np.minimum(room, REACH)
    ends = np.cumsum(size)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    data = (h[np.repeat(place, size) + step * inside] >> np.uint64(56)).astype(np.uint8)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(place), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


_UNITS = "serial long, doc_id long, start long, content long, before binary, after binary"


def _unit_pass(batches):
    for batch in batches:
        for h, _, row, at, start, content, size in _paragraphs(batch.column(2)):
            row = pa.array(row)
            columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(start), pa.array(content.view(np.int64))]
            columns += [_beside(h, at - 1, start, -1), _beside(h, at + WIDTH, size - start - WIDTH, 1)]
            yield pa.record_batch(columns, ["serial", "doc_id", "start", "content", "before", "after"])


def _band_pass(batches):
    """(bucket, odd, content) with the word parities ``odd``: a task names a content once."""
    seen: set[int] = set()
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = 0

    def out():
        columns = [np.concatenate(p).view(np.int64) for p in zip(*parts, strict=True)]
        return pa.record_batch([pa.array(c) for c in columns], ["bucket", "odd", "content"])

    inside = np.arange(WIDTH - SHINGLE + 1)
    for batch in batches:
        for h, grams, _, at, _, content, _ in _paragraphs(batch.column(2)):
            content, where = np.unique(content, return_index=True)
            at = at[where]
            new = np.array([i for i, c in enumerate(content.tolist()) if c not in seen], np.int64)
            seen.update(content.tolist())
            if not len(new):
                continue
            sets = grams[at[new][:, None] + inside]
            least = np.stack([(sets * a + b).min(axis=1) for a, b in zip(_A, _B, strict=True)])
            odd = np.bitwise_xor.reduce(np.uint64(1) << (h[at[new][:, None] + np.arange(WIDTH)] & np.uint64(63)), axis=1)
            for i in range(BANDS):
                key = np.full(len(new), i + 1, np.uint64)
                for values in least[i * ROWS : (i + 1) * ROWS]:
                    key = mix(key ^ values)
                parts.append((key, odd, content[new]))
                rows += len(new)
            if rows >= OUT_ROWS:
                yield out()
                parts, rows = [], 0
    if parts:
        yield out()


PAIR, DENSE, OPEN = 0, 1, 2  # kinds of rows that come out of a bucket


def _unmet(odds: list[int], led: list[int]) -> list[tuple[int, int]]:
    """(place, group) of a bucket's rows that are NEAR one with which they make no pair; such rows are of one group. ``led``: the place of a row's leader, or -1."""
    n = len(odds)
    packed = np.array(odds, np.uint64) if n > FEW else None
    group, free = list(range(n)), [False] * n
    for i in range(1, n):
        odd = odds[i]
        if packed is None:
            near = [j for j in range(i) if (odds[j] ^ odd).bit_count() <= NEAR]
        else:
            near = np.flatnonzero(np.bitwise_count(packed[:i] ^ packed[i]) <= NEAR).tolist()
        for j in near:
            if j != led[i]:
                free[i] = free[j] = True
                if group[i] != group[j]:
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    return [(i, group[i]) for i in range(n) if free[i]]


def _pair_pass(most: int | None):
    """Sorted (bucket, odd, content) to pairs (PAIR, a, b, null, null).

    Of a bucket with more than ``most`` leaders also the leaders so far and all
    later rows (DENSE, null, content, bucket, odd). For ``_cross_links`` the rows
    that are NEAR one they make no pair with (OPEN, ...), in a bucket for each
    group of such; of a bucket of more than LEADERS rows all.
    """

    def run(batches):
        bucket, over = None, False
        odds, names, places = [], [], []  # of the bucket's leaders
        row_odds, row_names, led = [], [], []  # of all its rows, up to LEADERS
        opened = False
        packed = np.zeros(0, np.uint64)
        kind, a, b, of, odd_of = out = [], [], [], [], []

        def put(what, name, odd, where):
            kind.append(what)
            a.append(None)
            b.append(name)
            of.append(where)
            odd_of.append(odd - (1 << 64) if odd >> 63 else odd)

        def close():
            if not opened and len(led) > max(2, len(odds)):
                for i, group in _unmet(row_odds, led):
                    put(OPEN, row_names[i], row_odds[i], hash((bucket, group)))

        def seen(name, odd, leader):
            if opened:
                put(OPEN, name, odd, bucket)
            else:
                row_odds.append(odd)
                row_names.append(name)
                led.append(leader)

        def open_all():
            for n, o in zip(row_names, row_odds, strict=True):
                put(OPEN, n, o, bucket)

        def taken():
            columns = [pa.array(kind, pa.int8()), *[pa.array(x, pa.int64()) for x in out[1:]]]
            for x in out:
                x.clear()
            return pa.record_batch(columns, ["kind", "a", "b", "bucket", "odd"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(3)]
            # a row alone in its bucket, or again the content before it, has nothing to meet
            again = columns[0][1:] == columns[0][:-1]
            kept = np.concatenate([[True], again]) | np.concatenate([again, [True]])
            kept[1:] &= ~(again & (columns[2][1:] == columns[2][:-1]))
            columns = [c[kept] for c in columns]
            for key, odd, name in zip(columns[0].tolist(), columns[1].view(np.uint64).tolist(), columns[2].tolist(), strict=True):
                if key != bucket:
                    close()
                    bucket, over = key, False
                    odds, names, places = [], [], []
                    row_odds, row_names, led = [], [], []
                    opened = False
                if not opened and len(led) > LEADERS:
                    open_all()
                    opened = True
                if not over:
                    if len(odds) <= FEW:
                        near = next((i for i, o in enumerate(odds) if (o ^ odd).bit_count() <= NEAR), -1)
                    else:
                        hits = np.bitwise_count(packed[: len(odds)] ^ np.uint64(odd)) <= NEAR
                        near = int(hits.argmax()) if hits.any() else -1
                    if near >= 0:
                        if names[near] == name:
                            continue
                        kind.append(PAIR)
                        a.append(names[near])
                        b.append(name)
                        of.append(None)
                        odd_of.append(None)
                        seen(name, odd, places[near])
                        continue
                    if len(odds) == FEW:
                        packed = np.array([*odds, *[0] * FEW], np.uint64)
                    elif len(odds) > FEW and len(odds) == len(packed):
                        packed = np.resize(packed, 2 * len(packed))
                    if len(odds) >= FEW:
                        packed[len(odds)] = odd
                    odds.append(odd)
                    names.append(name)
                    places.append(len(led))
                    seen(name, odd, -1)
                    if most is None or len(odds) <= most:
                        continue
                    over = True
                    for n, o in zip(names, odds, strict=True):
                        put(DENSE, n, o, bucket)
                    if not opened:
                        open_all()
                        opened = True
                else:
                    put(DENSE, name, odd, bucket)
                    put(OPEN, name, odd, bucket)
            yield taken()
        close()
        yield taken()

    return run


def _deal_pass(batches):
    """(bucket, odd, ...) to one row for each part of the parities, in a bucket of its own."""
    for batch in batches:
        bucket, odd = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
        for i, (low, high) in enumerate(zip(PARTS[:-1], PARTS[1:], strict=True)):
            part = (odd >> low) & np.uint64((1 << int(high - low)) - 1)
            key = mix(bucket ^ mix(part + np.uint64((i + 1) << 32)))
            yield pa.record_batch([pa.array(key.view(np.int64)), *batch.columns[1:]], batch.schema.names)


_MET = "kind byte, a long, b long, bucket long, odd long"


def _met(bands: DataFrame) -> DataFrame:
    """The rows of all buckets as ``_pair_pass`` gives them."""
    return staged(bands.repartition("bucket").sortWithinPartitions("bucket", "content").mapInArrow(_pair_pass(LEADERS), _MET), "met")


def _colliding(bands: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """(a, b): paragraphs of a bucket with a leader that is NEAR. ``first``: the buckets' rows, if they are there."""
    first = _met(bands) if first is None else first
    dense = first.filter(f"kind = {DENSE}").select("bucket", "odd", F.col("b").alias("content")).mapInArrow(_deal_pass, "bucket long, odd long, content long")
    second = dense.repartition("bucket").sortWithinPartitions("bucket", "content").mapInArrow(_pair_pass(None), _MET)
    # open rows of dealt buckets are those of the dense one
    both = first.filter(f"kind = {PAIR}").select("a", "b").union(second.filter(f"kind = {PAIR}").select("a", "b"))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _content_pass(bits):
    """(content, words): word hashes of the contents that the filter may hold, once a task."""

    def run(batches):
        wanted = bits.value
        seen: set[int] = set()
        for batch in batches:
            names, words = [], []
            for h, _, _, at, _, content, _ in _paragraphs(batch.column(2)):
                hit = wanted[(content >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                for c, a in zip(content[hit].tolist(), at[hit].tolist(), strict=True):
                    if c not in seen:
                        seen.add(c)
                        names.append(c)
                        words.append(h[a : a + WIDTH].tobytes())
            yield pa.record_batch([pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(words, pa.binary())], ["content", "words"])

    return run


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every row of ``a`` and its row of ``b``."""
    along = np.arange(b.shape[1] + 1)
    row = np.tile(along, (len(b), 1))
    for i in range(a.shape[1]):
        change = np.minimum(row[:, :-1] + (b != a[:, i : i + 1]), row[:, 1:] + 1)
        row = np.concatenate([np.full((len(b), 1), i + 1), change], axis=1)
        row = np.minimum.accumulate(row - along, axis=1) + along
    return row[:, -1]


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    return int(edit_distances(a[None], b[None])[0])


def _shingle_rows(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles of every row, and which of them are the first of equal ones."""
    n, width = a.shape
    flat = np.concatenate([runs(a.reshape(-1), SHINGLE), np.zeros(SHINGLE - 1, np.uint64)])
    rows = np.sort(flat.reshape(n, width)[:, : width - SHINGLE + 1], axis=1)
    return rows, np.concatenate([np.ones((n, 1), bool), rows[:, 1:] != rows[:, :-1]], axis=1)


def _may_align(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At most EDITS words of ``a`` have no equal one in ``b`` within EDITS places, as of every row that EDITS edits make."""
    met = a == b
    for d in range(1, EDITS + 1):
        met[:, d:] |= a[:, d:] == b[:, :-d]
        met[:, :-d] |= a[:, :-d] == b[:, d:]
    return met.shape[1] - met.sum(axis=1) <= EDITS


def similar_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """100 * |intersection| >= PERCENT * |union| of 5-word shingles, or at most EDITS words inserted, dropped or changed."""
    if not len(a):
        return np.zeros(0, bool)
    (x, x_new), (y, y_new) = _shingle_rows(a), _shingle_rows(b)
    both = ((x[:, :, None] == y[:, None, :]).any(axis=2) & x_new).sum(axis=1)
    good = both * 100 >= PERCENT * (x_new.sum(axis=1) + y_new.sum(axis=1) - both)
    rest = np.flatnonzero(~good)
    rest = rest[_may_align(a[rest], b[rest])]
    good[rest] = edit_distances(a[rest], b[rest]) <= EDITS
    return good


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    return bool(similar_rows(a[None], b[None])[0])


def _verify(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, WIDTH) for i in (2, 3))
        yield batch.select(["a", "b"]).filter(pa.array(similar_rows(a, b)))


class _Signs:
    """What follows from the words of each paragraph, to exclude pairs that are not similar without a look at the words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n = np.zeros(n, np.int64)  # distinct shingles
        self.held = np.zeros((n, 4), np.uint64)  # 256 cells that hold a shingle or not
        self.words = np.zeros((n, 32), np.int8)  # words in each of 32 cells
        self.parts = np.zeros((n, WIDTH - PART + 1), np.uint64)  # of PART words, from every place
        for first in range(0, n, HELD_ROWS):
            at = slice(first, first + HELD_ROWS)
            some = words[at]
            shingles, new = _shingle_rows(some)
            self.n[at] = new.sum(axis=1)
            bit, quarter = np.uint64(1) << (shingles & np.uint64(63)), shingles >> np.uint64(6) & np.uint64(3)
            for i in range(4):
                self.held[at, i] = np.bitwise_or.reduce(np.where(quarter == i, bit, np.uint64(0)), axis=1)
            cell = (some >> np.uint64(8) & np.uint64(31)).astype(np.int64) + 32 * np.arange(len(some))[:, None]
            self.words[at] = np.bincount(cell.ravel(), minlength=32 * len(some)).reshape(-1, 32)
            parts = np.concatenate([runs(some.reshape(-1), PART), np.zeros(PART - 1, np.uint64)])
            self.parts[at] = parts.reshape(some.shape)[:, : WIDTH - PART + 1]

    def allow(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of each pair of rows: few enough shingles of one only for the similarity, or what EDITS edits leave.

        A cell that one of two sets holds alone stands for a shingle of that set alone. At
        PERCENT, those in one set only are at most (100 - PERCENT) / (100 + PERCENT) of both sizes.
        EDITS edits take or add 2 * EDITS words at most, and of EDITS + 1 parts they leave
        one whole, which the other row holds within EDITS places.
        """
        apart = np.bitwise_count(self.held[i] ^ self.held[j]).sum(axis=1, dtype=np.int64)
        good = apart * (100 + PERCENT) <= (100 - PERCENT) * (self.n[i] + self.n[j])
        rest = np.flatnonzero(~good)
        rest = rest[np.abs(self.words[i[rest]] - self.words[j[rest]]).sum(axis=1) <= 2 * EDITS]
        a, b = self.parts[i[rest]], self.parts[j[rest]]
        for place in range(0, PART * (EDITS + 1), PART):
            beside = b[:, max(0, place - EDITS) : place + EDITS + 1]
            good[rest] |= (a[:, place, None] == beside).any(axis=1)
        return good


class _Buckets:
    """Open rows of some whole buckets, sorted by bucket, of which similar ones are brought into one component."""

    def __init__(self, bucket: np.ndarray, odd: np.ndarray, root: np.ndarray, words: np.ndarray):
        self.odd, self.words = odd, words
        self.names, self.root = np.unique(root, return_inverse=True)
        self.to = np.arange(len(self.names))  # of every component the one it has come into
        self.ends = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        self.signs = _Signs(words)
        self.found: list[tuple[int, int]] = []

    def links(self) -> list[tuple[int, int]]:
        """Links (root, root) between components: every NEAR pair is in one of them, or is not similar."""
        waiting, pairs = [], 0
        for low, high in zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True):
            rows = max(1, BLOCK_PAIRS // (high - low))
            for first in range(low, high, rows):
                last = min(first + rows, high)
                now = self.to[self.root[low:last]]
                near = np.bitwise_count(self.odd[first:last, None] ^ self.odd[None, low:last]) <= NEAR
                near &= now[first - low :, None] != now[None, :]
                i, j = np.nonzero(near)
                i, j = i + first, j + low
                before = j < i
                i, j = i[before], j[before]
                allowed = self.signs.allow(i, j)
                i, j = i[allowed], j[allowed]
                if len(i):
                    waiting.append((i, j))
                    pairs += len(i)
                if pairs >= COMPARED:
                    self._compare(*[np.concatenate(x) for x in zip(*waiting, strict=True)])
                    waiting, pairs = [], 0
        if waiting:
            self._compare(*[np.concatenate(x) for x in zip(*waiting, strict=True)])
        return self.found

    def _compare(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links the components of the similar ones among pairs: first one pair for two components, then what is still apart."""
        low, high = (f(self.root[i], self.root[j]) for f in (np.minimum, np.maximum))
        _, one = np.unique(self.to[low] * len(self.to) + self.to[high], return_index=True)
        rest = np.ones(len(i), bool)
        rest[one] = False
        for of in (one, np.flatnonzero(rest)):
            for first in range(0, len(of), COMPARED):
                some = of[first : first + COMPARED]
                some = some[self.to[self.root[i[some]]] != self.to[self.root[j[some]]]]
                hit = some[similar_rows(self.words[i[some]], self.words[j[some]])]
                for a, b in zip(self.root[i[hit]].tolist(), self.root[j[hit]].tolist(), strict=True):
                    x, y = self._end(a), self._end(b)
                    if x != y:
                        self.found.append((int(self.names[a]), int(self.names[b])))
                        self.to[max(x, y)] = min(x, y)
                if len(hit):
                    while (self.to[self.to] != self.to).any():
                        self.to = self.to[self.to]

    def _end(self, a: int) -> int:
        while self.to[a] != a:
            a = int(self.to[a])
        return a


def _cross_pass(batches):
    """(bucket, odd, content, root, words), sorted by bucket, to links (a, b) of roots; some whole buckets at a time."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, odd, root = (batch.column(i).to_numpy() for i in (0, 1, 3))
        words = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(-1, WIDTH)
        columns = [keys, odd.view(np.uint64), root, words]
        # up to where the last bucket begins all are whole
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if not cut and held and held[-1][0][-1] != keys[0]:
            if rows >= HELD_ROWS:
                yield _link_rows(_links_of(held))
                held, rows = [], 0
        elif cut and rows + cut >= HELD_ROWS:
            yield _link_rows(_links_of([*held, [c[:cut] for c in columns]]))
            held, rows, columns = [], 0, [c[cut:] for c in columns]
        held.append(columns)
        rows += len(columns[0])
    if held:
        yield _link_rows(_links_of(held))


def _links_of(parts: list[list[np.ndarray]]) -> list[tuple[int, int]]:
    return _Buckets(*[np.concatenate(c) for c in zip(*parts, strict=True)]).links()


def _link_rows(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _cross_links(met: DataFrame, roots: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b): roots of paragraphs that are NEAR in a bucket, similar, and not yet in one component.

    A paragraph met the first near leader alone. What is left are buckets whose
    rows are of several components: there all NEAR ones of different components
    are compared. Buckets of more than LEADERS rows are dealt out as before.
    """
    rows = met.filter(f"kind = {OPEN}").select("bucket", "odd", F.col("b").alias("content"))
    rows = rows.join(roots, F.col("content") == F.col("node"), "left").select("bucket", "odd", "content", F.coalesce("root", "content").alias("root"))
    rows = staged(rows, "open")
    several = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).filter("low < high")
    rows = staged(rows.join(several.select("bucket", "n"), "bucket"), "several")
    columns = ["bucket", "odd", "content", "root"]
    dealt = rows.filter(F.col("n") > LEADERS).select(*columns).mapInArrow(_deal_pass, "bucket long, odd long, content long, root long")
    both = rows.filter(F.col("n") <= LEADERS).select(*columns).union(dealt)
    both = both.join(words, "content").select(*columns, "words")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # as given: work is by pairs, so small parts are not to be merged by size
    return both.repartition(parts, "bucket").sortWithinPartitions("bucket", "content").mapInArrow(_cross_pass, "a long, b long")


def _roots(docs: DataFrame) -> DataFrame:
    """(node, root): the components of similar contents, for contents that have a similar one."""
    with passing(docs.sparkSession):
        met = _met(docs.mapInArrow(_band_pass, "bucket long, odd long, content long"))
        pairs = staged(_colliding(None, met), "pairs")
        needed = pairs.select(F.explode(F.array("a", "b")).alias("content")).union(met.filter(f"kind = {OPEN}").select("b")).distinct()
        needed = staged(needed, "needed")
        cells = needed.select(F.shiftrightunsigned("content", 64 - FILTER_BITS).alias("cell")).distinct()
        wanted = np.zeros(1 << FILTER_BITS, bool)
        wanted[cells.toArrow()["cell"].to_numpy()] = True  # at most 2**FILTER_BITS cells
        words = docs.mapInArrow(_content_pass(docs.sparkSession.sparkContext.broadcast(wanted)), "content long, words binary")
        words = staged(words.join(needed, "content", "semi").dropDuplicates(["content"]), "contents")
        both = pairs.join(words.select(F.col("content").alias("a"), F.col("words").alias("a_words")), "a")
        both = both.join(words.select(F.col("content").alias("b"), F.col("words").alias("b_words")), "b").select("a", "b", "a_words", "b_words")
        links = staged(both.mapInArrow(_verify, "a long, b long"), "links")
        roots = staged(components(links, "a", "b"), "roots", lasting=True)
        more = staged(_cross_links(met, roots, words), "more")
        if more.isEmpty():
            return roots
        again = components(more, "a", "b").select(F.col("node").alias("of"), F.col("root").alias("to"))
        both = roots.join(again, F.col("root") == F.col("of"), "full")
        return staged(both.select(F.coalesce("node", "of").alias("node"), F.coalesce("to", "root").alias("root")), "roots", lasting=True)


def common_words(mine: bytes, kept: bytes) -> int:
    """Words in which two sides go on alike.

    Similar paragraphs may begin up to EDITS words apart, so sides are laid beside
    each other at such distances too; a distance counts from two equal words on.
    """
    best = len(os.path.commonprefix([mine, kept]))
    for d in range(1, EDITS + 1):
        later, earlier = len(os.path.commonprefix([mine, kept[d:]])), len(os.path.commonprefix([mine[d:], kept]))
        best = max(best, later if later > 1 else 0, d + earlier if earlier > 1 else 0)
    return best


def _extend_pass(batches):
    """(place of the row, words before, words after) in which a passage and the one that is kept go on alike."""
    for batch in batches:
        grown = []
        for mine, other in ((5, 6), (7, 8)):
            sides = zip(batch.column(mine).to_pylist(), batch.column(other).to_pylist(), strict=True)
            grown.append([common_words(x or b"", y or b"") for x, y in sides])
        start, end = (np.array(batch.column(i).to_pylist(), np.int64) for i in (1, 2))
        start, end = start - np.array(grown[0], np.int64), end + np.array(grown[1], np.int64)
        yield pa.record_batch(
            [batch.column(0), pa.array(start), pa.array(end), batch.column(3), batch.column(4)], ["doc_id", "start", "end", "component_id", "removed"]
        )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages of ``docs`` (doc_id, text) that two or more rows share, exactly or nearly.

    One row a passage of a document and component: ``doc_id``, ``start`` and ``end``
    (words, end exclusive), ``n_words``, ``component_id`` (the smallest id of the
    rows that share its paragraphs, itself included) and ``removed`` (false in the
    first such row, which keeps the passage). Overlapping or neighbouring paragraphs
    of one component and verdict are one passage; passages of several components may
    overlap. A removed passage goes on, word by word, as long as the kept one does
    (words are told apart by one byte of their hash there, so one in 256 goes a
    word too far); a kept one is reported from its first to its last paragraph.
    Exact repeats of WIDTH + GUARANTEE - 1 words (51)
    or more are always found. Letters A to Z count as a to z. Texts that are
    null, empty or shorter than WIDTH words have no passages; repetition inside
    one row is none. Repeated rows share everything; of rows with equal ids one
    keeps the passage. A null id comes after all others. An empty table gives no
    rows. Other columns are not read.
    """
    docs = docs.select(
        F.monotonically_increasing_id().alias("serial"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    units = staged(docs.mapInArrow(_unit_pass, _UNITS), "units")
    roots = _roots(docs)
    contents = units.groupBy("content").agg(
        F.min("serial").alias("low"), F.max("serial").alias("high"), F.min("doc_id").alias("id"), F.min_by("serial", "doc_id").alias("id_serial")
    )
    contents = contents.join(roots, F.col("content") == F.col("node"), "left").withColumn("root", F.coalesce("root", "content"))
    contents = staged(contents.drop("node"), "contents")
    shared = contents.groupBy("root").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("id").alias("component_id"), F.min_by("id_serial", "id").alias("keeper")
    ).filter("low != high")
    shared = contents.select("content", "root").join(shared, "root").select("content", "root", "component_id", F.coalesce("keeper", "low").alias("keeper"))
    found = units.select("serial", "doc_id", "start", "content").join(shared, "content")
    found = staged(found.select("serial", "doc_id", "start", "content", "root", "component_id", (F.col("serial") != F.col("keeper")).alias("removed")), "found")
    by = Window.partitionBy("serial", "removed", "component_id").orderBy("start")
    gap = F.col("start") > F.lag("start").over(by) + max(WIDTH, GUARANTEE)  # neighbours in a repeated passage are no farther apart
    parts = found.withColumn("new", F.coalesce(gap, F.lit(True)).cast("int"))
    parts = parts.withColumn("passage", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    passages = staged(
        parts.groupBy("serial", "removed", "component_id", "passage").agg(
            F.min("doc_id").alias("doc_id"),
            F.min("start").alias("first"),
            F.max("start").alias("last"),
            F.min_by(F.struct("content", "root"), "start").alias("first_unit"),
            F.max_by(F.struct("content", "root"), "start").alias("last_unit"),
        ),
        "passages",
    )
    return _extended(passages, found, units).select(
        "doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "component_id", "removed"
    )


def _extended(passages: DataFrame, found: DataFrame, units: DataFrame) -> DataFrame:
    """``passages`` from ``start`` to ``end``, removed ones to where they part from the kept ones."""
    # beside the kept occurrence of the same content; where there is none, of a similar one
    at = F.min(F.struct("serial", "start"))
    same = found.filter("not removed").groupBy("content").agg(at.alias("same"))
    like = found.filter("not removed").groupBy("root").agg(at.alias("like"))
    ends = passages.filter("removed").select("serial", "removed", "component_id", "passage", "first", "last", "first_unit", "last_unit")
    for side in ("first", "last"):
        unit = [F.col(f"{side}_unit.{c}").alias(c) for c in ("content", "root")]
        met = ends.select("*", *unit).join(same, "content", "left").join(like, "root").withColumn("at", F.coalesce("same", "like"))
        ends = met.withColumns({f"{side}_serial": F.col("at.serial"), f"{side}_start": F.col("at.start")})
        ends = ends.drop("content", "root", "same", "like", "at", f"{side}_unit")
    ends = staged(ends, "ends")
    places = [("serial", "first"), ("serial", "last"), ("first_serial", "first_start"), ("last_serial", "last_start")]
    wanted = None
    for serial, start in places:
        one = ends.select(F.col(serial).alias("serial"), F.col(start).alias("start"))
        wanted = one if wanted is None else wanted.union(one)
    around = staged(units.select("serial", "start", "before", "after").join(wanted.distinct(), ["serial", "start"], "semi"), "around")
    for (serial, start), take, name in zip(places, ("before", "after", "before", "after"), ("before", "after", "kept_before", "kept_after"), strict=True):
        one = around.select(F.col("serial").alias(serial), F.col("start").alias(start), F.col(take).alias(name))
        ends = ends.join(one, [serial, start])
    columns = ["before", "kept_before", "after", "kept_after"]
    met = passages.join(ends.select("serial", "removed", "component_id", "passage", *columns), ["serial", "removed", "component_id", "passage"], "left")
    met = met.select("doc_id", F.col("first").alias("start"), (F.col("last") + WIDTH).alias("end"), "component_id", "removed", *columns)
    return met.mapInArrow(_extend_pass, "doc_id long, start long, end long, component_id long, removed boolean")
