"""LSH forest, conversation trie and whitening against brute force, and the odd cases each must take."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wellspring.llm import lsh_forest, prefix_trie
from wellspring.llm.lsh_forest import LshForest, forest_near_duplicates
from wellspring.llm.prefix_trie import RadixTree, conversation_trie, rebuilt_conversations, trie_nodes, turn_depths
from wellspring.llm.whitening import count_above, leading_eigenpairs, whiten

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- LSH forest ------------------------------------------------------------

def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(
        ((d, len(s), d if not s else least[root(i)], d == (d if not s else least[root(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def edited(rng, text, share):
    w = text.split(" ")
    for i in range(len(w)):
        if rng.random() < share:
            w[i] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 20, 60, 200]))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base + base[:5])]
    for t in base[:20]:
        rows += [(len(rows) + k, edited(rng, t, s)) for k, s in enumerate((0.002, 0.01, 0.02, 0.1))]
    hot = " ".join(f"h{i}" for i in range(120))
    rows += [(1000 + i, edited(rng, hot, 0.012)) for i in range(60)]  # a dense region
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "x " * 30_000), (2004, "X " * 30_000), (2005, "y" * 200_000)]
    rows += [rows[0], (None, base[1]), (None, "only without an id here")]
    return rows


def forest_rows(spark, rows, **settings):
    df = spark.createDataFrame([(t, 1, d, "s") for d, t in rows], "text string, item int, doc_id long, path string").repartition(5)
    return sorted([tuple(r) for r in forest_near_duplicates(df, **settings).collect()], key=str)


def test_forest_finds_every_component(spark, copies):
    want = [r if r[0] is not None else (*r[:3], r[2] is None) for r in brute_components(copies)]
    assert forest_rows(spark, copies) == want


def test_dense_regions_are_taken_deeper_and_whole(spark, copies, monkeypatch):
    monkeypatch.setattr(lsh_forest, "PARTNERS", 0)  # every open region goes to the full depth
    monkeypatch.setattr(lsh_forest, "PART", 3)
    want = brute_components(copies)
    got = forest_rows(spark, copies)
    assert sum(a[:3] != b[:3] for a, b in zip(got, want)) <= 2


def test_forest_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, path string")
    assert forest_near_duplicates(empty).collect() == []
    alone = spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, "g h i j k l")], "doc_id long, text string")
    assert sorted(map(tuple, forest_near_duplicates(alone).collect())) == [(1, 2, 1, True), (2, 0, 2, True), (3, 2, 3, True)]
    with pytest.raises(ValueError):
        LshForest(alone, percent=40)


def test_recall_of_planted_pairs(spark):
    """Pairs at the threshold among many that share a phrase; at least 0.9 is wanted."""
    rng = random.Random(9)
    phrase = " ".join(f"p{i}" for i in range(15))
    rows, pairs = [], []
    for i in range(300):
        t = phrase + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(85))
        u = t.split(" ")
        u[40] = f"c{i}"  # five of 96 shingles change: 91 of 101 shared, and a second word brings it to 86 of 106
        if i % 2:
            u[99] = f"d{i}"
        rows += [(2 * i, t), (2 * i + 1, " ".join(u))]
        pairs.append((2 * i, 2 * i + 1))
    linked = [len(shingles(a) & shingles(b)) * 100 >= 85 * len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2])]
    found = {r[0]: r[2] for r in forest_rows(spark, rows)}
    hits = [found[a] == found[b] for (a, b), yes in zip(pairs, linked) if yes]
    assert len(hits) >= 290 and sum(hits) >= 0.9 * len(hits)
    assert not any(found[a] == found[b] for (a, b), yes in zip(pairs, linked) if not yes)


# --- conversation trie -----------------------------------------------------

def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()[:32], r, x))
    for v in turns.values():
        v.sort()
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple((r, x) for *_, r, x in turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
            if d:
                children[p[: d - 1]].add(p[:d])
        ends[p].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(WORD.findall(p[-1][1])) if p else 0)
    return [
        (
            min(m),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(m),
            len(children[p]),
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    ]


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(3)
    rows = []
    for c in [*range(-45, 260), 10**12 + 7]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 40 if rng.random() < 0.05 else 2])):
            role = rng.choice(["user", "assistant", None])
            rows.append((c, t if rng.random() > 0.05 else None, role, rng.choice(["a b", "c", "", None, "hello  world x"])))
    rows += [(7, 900, "user", "word " * 50_000), (None, 1, "a", "b"), *rows[:5]]
    rows += [(400 + i, 0, "user", "the same") for i in range(200)]
    return rows


@pytest.mark.parametrize("piece", [(20_000, 100_000), (3, 100_000), (1, 1), (7, 11)])
def test_trie_nodes(spark, talk, piece):
    df = spark.createDataFrame([(*r, 5, None) for r in talk], "conv_id long, turn long, role string, text string, depth int, words string")
    got = [tuple(r) for r in trie_nodes(rebuilt_conversations(df), *piece).collect()]
    assert sorted(got, key=str) == sorted(brute_trie(talk), key=str)


def test_trie_of_nothing_and_of_no_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversation_trie(spark.createDataFrame([], schema)).collect() == []
    none_left = next(c for c in range(1, 19) if zlib.crc32(str(c).encode()) % 4 >= 2)
    rows = [(none_left, 1, "user", "lost")]  # its family's first conversation is absent
    assert [tuple(r)[:7] for r in conversation_trie(spark.createDataFrame(rows, schema)).collect()] == [(none_left, 0, None, 1, 0, 1, 0)]


def test_radix_tree_layouts_grow():
    rng = random.Random(1)
    for n in (3, 15, 47, 250):
        tree, keys = RadixTree(), set()
        for first in range(n):
            key = bytes([first]) + bytes(15)
            for more in range(rng.randrange(3)):
                keys.add(key + rng.randbytes(16 * more))
            keys.add(key)
        for i, key in enumerate(sorted(keys, key=lambda k: rng.random())):
            tree.insert(key, [1] * (len(key) // 16)).ends.append(i)
        assert type(tree.root.branches).__name__ == ("Sorted" if n <= 16 else "Indexed" if n <= 48 else "Direct")
        nodes = tree.measure()
        prefixes = {k[: 16 * d] for k in keys for d in range(len(k) // 16 + 1)}
        assert sum(len(turn_depths(node)) for node in nodes) == len(prefixes)
        assert nodes[0].n == len(keys)
        assert nodes[0].leaves == sum(not any(q != p and q.startswith(p) for q in prefixes) for p in prefixes)


# --- whitening -------------------------------------------------------------

def test_inertia_counts():
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 8, 40):
        m = rng.standard_normal((d, d))
        m = m + m.T
        values = np.linalg.eigvalsh(m)
        for s in np.linspace(values[0] - 1, values[-1] + 1, 40):
            assert count_above(m, s) == (values > s).sum()
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert count_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("values", [[5, 5, 5, 4, 4, 3, 1, 1, 1] + [0] * 11, [1] * 20, [2, 1] + [0] * 18, [1, 1 - 1e-15, 1 - 1e-12] + [0.1] * 17])
def test_leading_eigenpairs(values):
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((20, 20)))
    m = q @ np.diag(values) @ q.T
    m = (m + m.T) / 2
    found = leading_eigenpairs(m)
    want = [v for v in values if v > 0][:8]
    assert np.allclose(found.values, want, rtol=1e-12)
    assert np.allclose(found.vectors.T @ m @ found.vectors, np.diag(want), atol=1e-12)


def whitened(rows):
    """(V, eigenvalues, vectors by falling eigenvalue, x, S) of plain vectors."""
    x = np.floor(1024 * np.array(rows, float)) + 100_000
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    e, p = np.linalg.eigh(v)
    return v, e[::-1], p[:, ::-1], x, x.sum(axis=0)


def test_whitening_of_rows(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((400, 12)) * np.linspace(1, 4, 12)).astype(np.float32)
    vectors[::3] = vectors[0]  # a third of all rows are one vector
    rows = [(i, [float(c) for c in v], 0.5, None) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [float("nan")] * 12), (902, [1.0, None] + [0.0] * 10), (903, [float("inf")] * 12)]
    repeated = [rows[3], (None, rows[5][1], 1.0, None)]
    df = spark.createDataFrame(rows + [(i, v, None, None) for i, v in odd] + repeated, "vec_id long, embedding array<float>, n double, component string")
    got = whiten(df.repartition(6)).collect()
    plain = [v for _, v, *_ in rows + repeated]
    v, e, p, x, sums = whitened(plain)
    n = len(plain)
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    at = {}
    for r in got:
        at.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert len(at[3, 1]) == 2 and len(at[None, 8]) == 1
    for k in range(8):
        want = (x - sums / n) @ p[:, k] / np.sqrt(e[k])
        mine = np.array([at[i, k + 1][0]["whitened"] for i in range(400)])
        assert np.allclose(mine, want[:400], atol=1e-8) or np.allclose(-mine, want[:400], atol=1e-8)
    for i in (0, 7, 399):
        r = at[i, 1][0]
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
        assert math.isclose(r["explained"], e[0] / np.trace(v), rel_tol=1e-10)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).collect() == []
    assert whiten(spark.createDataFrame([(1, None), (2, [float("nan")])], schema)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []  # no direction at all
    assert whiten(spark.createDataFrame([(1, []), (2, [])], schema)).collect() == []
    uneven = whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [3.0, -1.0])], schema)).collect()
    assert {r["component"] for r in uneven} == {1, 2} and len(uneven) == 6
    huge = whiten(spark.createDataFrame([(i, [float(i) * 1e37, 1.0]) for i in range(-3, 4)], schema)).collect()
    assert len(huge) >= 7 and all(np.isfinite(r["whitened"]) for r in huge) and huge[0]["deviation"] is None
