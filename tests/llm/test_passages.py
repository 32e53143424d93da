"""Repeated passages against planted ones: every component of a document, the ends of a repeat, dense buckets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from wellspring.llm import substring_dedup
from wellspring.llm.substring_dedup import repeated_passages


def prose(rng, n):
    return " ".join(f"w{rng.randrange(50_000)}" for _ in range(n))


def test_repeats_to_their_ends_with_every_component(spark):
    rng = random.Random(3)
    one, two = [prose(rng, 51) for _ in range(30)], [prose(rng, 51) for _ in range(30)]
    rows = []
    for i in range(30):  # a text that shares its halves with two others
        rows += [
            (3 * i, f"{prose(rng, 40)} {one[i]} {prose(rng, 40)}"),
            (3 * i + 1, f"{prose(rng, 40)} {two[i]} {prose(rng, 40)}"),
            (3 * i + 2, f"{prose(rng, 30)} {one[i]} {two[i]} {prose(rng, 30)}"),
        ]
    rows += [(None, None), (1000, ""), (1001, prose(rng, 300)), (1002, "x" * 100_000)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_words == r.end - r.start for r in found)
    exact = 0
    for i in range(30):
        spans = {r.component_id: (r.start, r.end) for r in found if r.doc_id == 3 * i + 2 and r.removed}
        assert set(spans) == {3 * i, 3 * i + 1}
        for (start, end), (true_start, true_end) in ((spans[3 * i], (30, 81)), (spans[3 * i + 1], (81, 132))):
            # whole, and at most the words beyond that a near paragraph may differ in, or a byte equal by chance
            assert true_start - 4 <= start <= true_start and true_end <= end <= true_end + 4
            exact += (start, end) == (true_start, true_end)
        assert {r.component_id for r in found if r.doc_id == 3 * i} == {3 * i}
    assert exact >= 30
    assert not {r.doc_id for r in found} & {1000, 1001, 1002}


@pytest.mark.parametrize("leaders", [2_000, 3])
def test_all_near_paragraphs_of_a_bucket_meet(spark, leaders, monkeypatch):
    monkeypatch.setattr(substring_dedup, "LEADERS", leaders)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    rows = []
    for i, odd in enumerate(base):  # every one with a near one, all in one bucket, and one bucket with a single row
        other = odd
        for bit in rng.choice(64, 4, replace=False):
            other ^= np.uint64(1) << np.uint64(bit)
        rows += [(7, int(odd.view(np.int64)), 2 * i), (7, int(other.view(np.int64)), 2 * i + 1)]
    order = rng.permutation(len(rows))
    bands = spark.createDataFrame([*[rows[i] for i in order], (8, 0, 9_999)], "bucket long, odd long, content long")
    got = {tuple(r) for r in substring_dedup._colliding(bands).collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(400)}


@pytest.mark.parametrize("leaders", [2_000, 1])
def test_followers_of_a_leader_unlike_them_meet_each_other(spark, leaders, monkeypatch):
    monkeypatch.setattr(substring_dedup, "LEADERS", leaders)
    rng, rows = random.Random(9), []
    for i in range(60):  # halves swapped: the same parities and many equal shingles, but not similar
        first, second = prose(rng, 12), prose(rng, 12)
        rows += [(3 * i, f"{first} {second}"), (3 * i + 1, f"{second} {first}"), (3 * i + 2, f"{second} {first.rsplit(' ', 1)[0]} other{i}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).selectExpr("doc_id serial", "doc_id", "text")
    bands = docs.mapInArrow(substring_dedup._band_pass, "bucket long, odd long, content long").collect()
    buckets = {}
    for r in bands:
        buckets.setdefault(r.content, set()).add(r.bucket)
    content = {r.doc_id: r.content for r in docs.mapInArrow(substring_dedup._unit_pass, substring_dedup._UNITS).collect()}
    found = {(r.doc_id, r.component_id) for r in repeated_passages(docs.select("doc_id", "text")).collect()}
    meet = [i for i in range(60) if buckets[content[3 * i + 1]] & buckets[content[3 * i + 2]]]
    assert len(meet) > 50
    assert found == {(3 * i + j, 3 * i + 1) for i in meet for j in (1, 2)}


def _open_rows(buckets: int, size: int):
    """Rows of one parity each: unlike but for every fourth, which repeats the one before it with one word changed."""
    rng = np.random.default_rng(3)
    low = np.arange(substring_dedup.WIDTH, dtype=np.uint64)
    words = (rng.integers(0, 2**57, (buckets * size, substring_dedup.WIDTH), dtype=np.uint64) << np.uint64(6)) + low
    words[3::4] = words[2::4]
    words[3::4, 11] += np.uint64(1 << 40)
    bucket, root = np.repeat(np.arange(buckets), size), np.arange(buckets * size) + 100
    columns = [bucket, np.full(len(root), 2**24 - 1), root, root, [w.tobytes() for w in words]]
    return words, pa.table(dict(zip(["bucket", "odd", "content", "root", "words"], columns, strict=True)))


@pytest.mark.parametrize("buckets, size, rows", [(500, 8, 1_000), (3, 400, 77), (1, 1_200, 100)])
def test_unlike_open_rows_are_excluded_without_a_look_at_their_words(monkeypatch, buckets, size, rows):
    words, table = _open_rows(buckets, size)
    calls, real = [], substring_dedup.similar_rows
    monkeypatch.setattr(substring_dedup, "similar_rows", lambda a, b: calls.append(len(a)) or real(a, b))
    out = list(substring_dedup._cross_pass(iter(table.to_batches(max_chunksize=rows))))
    got = {frozenset(x) for b in out for x in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    assert got == {frozenset((i + 99, i + 100)) for i in range(3, len(words), 4)}
    assert sum(calls) < len(words) and len(calls) < 20


def test_signs_exclude_no_similar_pair():
    rng = np.random.default_rng(4)
    some = rng.integers(0, 2**63, 3, dtype=np.uint64)
    a = some[rng.integers(0, 3, (4_000, substring_dedup.WIDTH))]
    a[::2] = rng.integers(0, 2**63, a[::2].shape, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        b[i] = np.roll(b[i], -rng.integers(0, 4))
        b[i, rng.integers(0, substring_dedup.WIDTH, rng.integers(0, 4))] = some[0]
    similar = substring_dedup.similar_rows(a, b)
    slow = [bool(substring_dedup.edit_distance(x, y) <= substring_dedup.EDITS) for x, y in zip(a, b, strict=True)]
    assert 0.1 < similar.mean() < 0.9 and (similar >= slow).all()
    signs, i = substring_dedup._Signs(np.concatenate([a, b])), np.arange(len(a))
    assert (signs.allow(i, i + len(a)) | ~similar).all()
    assert not signs.allow(i[::2][:-1], i[::2][1:]).any()
