"""Near-duplicate documents by an LSH forest.

Sets of the same content are one item from the start. An item's MinHash values
are dealt to ``TREES`` trees, each a sequence of ``DEPTH`` values: its path. All
paths of a tree are sorted, range partitioned over the tasks, so that an item's
neighbours in that order are those with the longest common prefix. Neighbours
that share at least ``LEAST`` values are candidates; most members of a group of
near copies are connected by their neighbours in the first trees, and later
trees only compare items whose components still differ.

What neighbours alone leave open is found region by region. A region holds the
items below one prefix. It is open while it spans several components; its pairs
across components are compared at the least depth at which they are few for its
size, at the full depth at the latest. So a sparse region is taken at 3 values,
a dense one deeper, and no pair of an examined region is left out.

Candidates are confirmed on whole sets. Before that, sizes and the parities of
the sets over 512 cells exclude, by bounds that hold always, most pairs that
cannot reach the similarity.

A pair of similarity s meets in a region of depth d in at least one tree with
probability 1 - (1 - s^d)^TREES: at s = 0.85 it is 0.99999 for d = 3 and 0.978
for d = 8.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.store import components, staged
from wellspring.llm.tokens import SHINGLE, digest, distinct, lower, shingle_hashes, text_chunks, words_of

TREES, DEPTH = 12, 8
LEAST = 3  # values that a candidate pair shares in some tree
STEPS = ([0, 1], list(range(2, TREES)))  # trees whose neighbours are compared before components are drawn again
DEPTHS = (LEAST, 5, DEPTH)  # at which regions are looked at
PARTNERS = 32  # a region with more open pairs an item than this is looked at deeper
PART = 4096  # items of a region's part
FILTER_BITS = 24  # of the filter that finds the texts to compare: a fixed 2 MB; misses nothing
SEEN = 1_000_000  # contents a task remembers
CELLS = [f"cell{i}" for i in range(8)]  # 64 parities each

_RNG = np.random.default_rng(12)
_FLIP = _RNG.integers(0, 2**64, TREES * DEPTH, np.uint64)
_TIMES = _RNG.integers(0, 2**63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)


def _signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(sets, TREES * DEPTH) least 32-bit values; ``first`` are the places at which the non-empty sets begin."""
    out = np.empty((len(first), TREES * DEPTH), ">u4")
    for i in range(TREES * DEPTH):
        out[:, i] = np.minimum.reduceat((values ^ _FLIP[i]) * _TIMES[i], first) >> np.uint64(32)
    return out


def _parities(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & np.uint64(64 * len(CELLS) - 1)).astype(np.int64), minlength=64 * len(CELLS)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_SIGNED = ["id", "n", "item", "check", "signature", *CELLS]
_SIGNED_DDL = "id long, n long, item long, check long, signature binary, " + ", ".join(f"{c} long" for c in CELLS)


def _signature_pass(k: int):
    """A row per document; signature and parities for the first document with its content in the task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            m = batch.num_rows
            n, a, b = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
            cells = np.zeros((len(CELLS), m), np.int64)
            signature: list[bytes | None] = [None] * m
            for row, data, offsets in text_chunks(batch.column(1)):
                hashes, first = shingle_hashes(words_of(lower(data), offsets), k)
                fresh, sets = [], []
                for i in range(len(offsets) - 1):
                    s = distinct(hashes[first[i] : first[i + 1]])
                    n[row + i] = len(s)
                    if not len(s):
                        continue
                    a[row + i], b[row + i] = digest(s)
                    if (item := int(a[row + i])) not in seen:
                        if len(seen) >= SEEN:  # a repeated signature is only work
                            seen.clear()
                        seen.add(item)
                        fresh.append(row + i)
                        sets.append(s)
                if fresh:
                    at = np.cumsum([0, *[len(s) for s in sets[:-1]]])
                    for i, s, path in zip(fresh, sets, _signatures(np.concatenate(sets), at), strict=True):
                        signature[i] = path.tobytes()
                        cells[:, i] = _parities(s)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(n),
                    pa.array(a, mask=n == 0),
                    pa.array(b, mask=n == 0),
                    pa.array(signature, pa.binary()),
                    *[pa.array(c) for c in cells],
                ],
                _SIGNED,
            )

    return run


_SORTED = ["tree", "path", "item", "n", "before", "before_n", "edge"]
_SORTED_DDL = "tree int, path binary, item long, n long, before long, before_n long, edge boolean"


def _neighbour_pass(least: int):
    """Sorted entries to those that share ``least`` values with a neighbour, with their predecessor; and the task's ends."""

    def run(batches):
        held = None  # the last row so far: (tree, path, item, n), and its predecessor where that is near
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, item, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            path = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, 4 * DEPTH)
            begins = held is None
            if not begins:
                tree, item, n = (np.concatenate([[h], c]) for h, c in zip((held[0], held[2], held[3]), (tree, item, n), strict=True))
                path = np.concatenate([held[1][None], path])
            near = (path[1:, : 4 * least] == path[:-1, : 4 * least]).all(axis=1) & (tree[1:] == tree[:-1])
            with_before = np.concatenate([[False if begins else held[4] is not None], near])
            before = np.concatenate([[0 if begins or held[4] is None else held[4][0]], item[:-1]])
            before_n = np.concatenate([[0 if begins or held[4] is None else held[4][1]], n[:-1]])
            edge = np.zeros(len(tree), bool)
            edge[0] = begins or held[5]
            keep = np.flatnonzero(with_before[:-1] | near | edge[:-1])
            yield _sorted_batch(tree, path, item, n, before, before_n, with_before, edge, keep)
            held = tree[-1], path[-1], item[-1], n[-1], (before[-1], before_n[-1]) if with_before[-1] else None, bool(edge[-1])
        if held is not None:
            one = [np.array([h]) for h in (held[0], held[2], held[3], *(held[4] or (0, 0)))]
            yield _sorted_batch(
                one[0], held[1][None], one[1], one[2], one[3], one[4], np.array([held[4] is not None]), np.array([True]), np.array([0])
            )

    return run


def _sorted_batch(tree, path, item, n, before, before_n, with_before, edge, keep):
    alone = ~with_before[keep]
    return pa.record_batch(
        [
            pa.array(tree[keep].astype(np.int32)),
            pa.array([p.tobytes() for p in path[keep]], pa.binary()),
            pa.array(item[keep].astype(np.int64)),
            pa.array(n[keep].astype(np.int64)),
            pa.array(before[keep].astype(np.int64), mask=alone),
            pa.array(before_n[keep].astype(np.int64), mask=alone),
            pa.array(edge[keep]),
        ],
        _SORTED,
    )


def _set_pass(k: int, bits):
    """(item, members): the sorted n-gram hashes of texts whose item the filter may hold."""

    def run(batches):
        wanted = bits.value
        seen: set[int] = set()
        for batch in batches:
            items, members = [], []
            for _, data, offsets in text_chunks(batch.column(0)):
                hashes, first = shingle_hashes(words_of(lower(data), offsets), k)
                for i in range(len(offsets) - 1):
                    s = distinct(hashes[first[i] : first[i + 1]])
                    if not len(s):
                        continue
                    item, _ = digest(s)
                    cell = (item & (1 << 64) - 1) >> (64 - FILTER_BITS)
                    if item in seen or not int(wanted[cell >> 6]) >> (cell & 63) & 1:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(item)
                    items.append(item)
                    members.append(s.tobytes())
            if items:
                yield pa.record_batch([pa.array(items, pa.int64()), pa.array(members, pa.binary())], ["item", "members"])

    return run


def _overlap_pass(batches):
    for batch in batches:
        found = np.zeros(batch.num_rows, np.int64)
        for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            left, right = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            found[i] = len(np.intersect1d(left, right, assume_unique=True))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found)], ["p", "x", "overlap"])


class LshForest:
    """One run over ``docs``; ``result`` has the documents."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = 85):
        if not 50 < percent <= 100:
            raise ValueError("percent must be above 50 and at most 100")
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        self.spark = docs.sparkSession
        signed = staged(self.docs.mapInArrow(_signature_pass(k), _SIGNED_DDL), "signed")
        self.rows = signed.select("id", "n", "item", "check")
        self.ids = staged(self.rows.filter("n > 0").groupBy("item", "check").agg(F.min("id").alias("id")), "ids")
        columns = ["item", "n", "signature", *CELLS]
        self.items = staged(signed.filter("signature is not null").select(*columns).dropDuplicates(["item"]), "items")
        self.sets: DataFrame | None = None
        self.roots = self.spark.createDataFrame([], "node long, root long")

    def _may(self, a: str, b: str) -> F.Column:
        """The sizes allow the similarity."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def _cells_allow(self, a: str, b: str) -> F.Column:
        """At least as many n-grams are in one set only as there are cells whose parity differs."""
        apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(a + c).bitwiseXOR(F.col(b + c))) for c in CELLS])
        both = F.col(f"{a}n") + F.col(f"{b}n")
        return (both - apart) * (100 + self.percent) >= both * (2 * self.percent)

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """(p, x, ...) that no parities exclude, with the sizes p_n and x_n."""
        facts = self.items.select("item", "n", *CELLS)
        for side in ("p", "x"):
            pairs = pairs.join(facts.select(F.col("item").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", *CELLS)]), side)
        return pairs.filter(self._cells_allow("p_", "x_")).drop(*[f"{s}_{c}" for s in ("p", "x") for c in CELLS])

    def forest(self) -> DataFrame:
        """Entries near a neighbour in their tree's order: (tree, path, item, n), with the predecessor where near."""
        paths = F.array(*[F.substring("signature", 4 * DEPTH * t + 1, 4 * DEPTH) for t in range(TREES)])
        entries = self.items.select(F.posexplode(paths).alias("tree", "path"), "item", "n")
        order = ["tree", "path", "item"]
        entries = entries.repartitionByRange(*order).sortWithinPartitions(*order)
        return staged(entries.mapInArrow(_neighbour_pass(LEAST), _SORTED_DDL), "forest")

    def neighbours(self, forest: DataFrame) -> DataFrame:
        """(p, x, tree): neighbouring items, each pair with the first tree in which they are."""
        inside = forest.filter("before is not null").select("tree", "item", "n", F.col("before").alias("other"), F.col("before_n").alias("other_n"))
        # first and last entry of each task: two rows a task, whatever the data
        across = Window.partitionBy(F.lit(0)).orderBy("tree", "path", "item")
        ends = forest.filter("edge").select(
            "tree",
            "path",
            "item",
            "n",
            *[F.lag(c).over(across).alias(f"last_{c}") for c in ("tree", "path", "item", "n")],
        )
        near = (F.col("tree") == F.col("last_tree")) & (F.substring("path", 1, 4 * LEAST) == F.substring("last_path", 1, 4 * LEAST))
        between = ends.filter(near).select("tree", "item", "n", F.col("last_item").alias("other"), F.col("last_n").alias("other_n"))
        both = inside.union(between).filter(self._may("n", "other_n") & (F.col("item") != F.col("other")))
        return both.groupBy(F.least("item", "other").alias("p"), F.greatest("item", "other").alias("x")).agg(F.min("tree").alias("tree"))

    def _gather(self, pairs: DataFrame) -> None:
        """Sets of all items in ``pairs``, found by content: null and repeated ids play no part."""
        items = pairs.select(F.col("p").alias("item")).union(pairs.select("x")).distinct()
        if self.sets is not None:
            items = staged(items.join(self.sets.select("item"), "item", "anti"), "missing")
        cell = F.shiftrightunsigned("item", 64 - FILTER_BITS)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))
        masks = items.groupBy(F.shiftright(cell, 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
        table = masks.toArrow()  # at most 2**FILTER_BITS / 64 longs
        if not table.num_rows:
            return
        bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        bits[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
        found = self.docs.select("text").mapInArrow(_set_pass(self.k, self.spark.sparkContext.broadcast(bits)), "item long, members binary")
        found = staged(found.dropDuplicates(["item"]), "members")
        self.sets = found if self.sets is None else self.sets.union(found.join(self.sets.select("item"), "item", "anti"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """(p, x) of ``pairs`` (with p_n and x_n) whose whole sets reach the similarity."""
        sets = {s: self.sets.select(F.col("item").alias(s), F.col("members").alias(f"{s}_members")) for s in ("p", "x")}
        both = pairs.select("p", "x").join(sets["x"], "x").join(sets["p"], "p").select("p", "x", "p_members", "x_members")
        found = both.mapInArrow(_overlap_pass, "p long, x long, overlap long").join(pairs.select("p", "x", "p_n", "x_n"), ["p", "x"])
        enough = F.col("overlap") * (100 + self.percent) >= (F.col("p_n") + F.col("x_n")) * self.percent
        return staged(found.filter(enough).select("p", "x"), "links")

    def _across(self, pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs whose items are in different components."""
        for side in ("p", "x"):
            pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
        return pairs.filter(F.coalesce("p_root", "p") != F.coalesce("x_root", "x")).drop("p_root", "x_root")

    def region_pairs(self, forest: DataFrame, roots: DataFrame, known: DataFrame) -> DataFrame:
        """(p, x, p_n, x_n): all possible pairs across components in the open regions, each region at a depth of its own."""
        entries = forest.select("tree", "path", "item", "n").join(roots, F.col("item") == F.col("node"), "left")
        entries = entries.select("tree", "path", "item", "n", F.coalesce("root", "item").alias("root"))
        found = []
        for depth in DEPTHS:
            entries = entries.withColumn("region", F.substring("path", 1, 4 * depth))
            of_root = entries.groupBy("tree", "region", "root").agg(F.count(F.lit(1)).alias("m"))
            regions = of_root.groupBy("tree", "region").agg(
                F.sum("m").alias("size"),
                F.sum(F.col("m") * F.col("m")).alias("squares"),
                F.max(F.struct("m", "root")).alias("main"),
            )
            pairs_open = (F.col("size") * F.col("size") - F.col("squares")) / 2
            regions = regions.filter("size * size > squares").select(
                "tree",
                "region",
                (F.lit(depth == DEPTH) | (pairs_open <= PARTNERS * F.col("size"))).alias("here"),
                F.col("main.root").alias("main"),
                (1 + F.col("size") / PART).cast("int").alias("parts"),
            )
            met = staged(entries.join(regions, ["tree", "region"]), "regions")
            found.append(self._cross_pairs(met.filter("here")))
            entries = met.filter("not here").select("tree", "path", "item", "n", "root")
            if depth == DEPTH or entries.isEmpty():
                break
        pairs = staged(reduce(DataFrame.union, found).distinct(), "cross")
        return pairs.join(known.select("p", "x"), ["p", "x"], "anti")

    def _cross_pairs(self, entries: DataFrame) -> DataFrame:
        """Pairs across components below one prefix: entries outside the region's main component, with all of its parts.

        The main component's own pairs never arise, the pairs that do are counted
        beforehand, and sizes and parities are compared inside the join.
        """
        entries = entries.join(self.items.select("item", *CELLS), "item")
        salt = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int")
        columns = ["item", "n", "root", *CELLS]
        whole = entries.select("tree", "region", salt.alias("part"), *[F.col(c).alias(f"b_{c}") for c in columns])
        parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("a_part")
        rest = entries.filter("root != main").select(
            F.col("tree").alias("a_tree"), F.col("region").alias("a_region"), parts, *[F.col(c).alias(f"a_{c}") for c in columns]
        )
        same = (F.col("tree") == F.col("a_tree")) & (F.col("region") == F.col("a_region")) & (F.col("part") == F.col("a_part"))
        possible = (F.col("a_root") != F.col("b_root")) & self._may("a_n", "b_n") & self._cells_allow("a_", "b_")
        pairs = rest.join(whole, same & possible)
        return pairs.groupBy(F.least("a_item", "b_item").alias("p"), F.greatest("a_item", "b_item").alias("x")).agg(
            F.max(F.when(F.col("a_item") < F.col("b_item"), F.col("a_n")).otherwise(F.col("b_n"))).alias("p_n"),
            F.max(F.when(F.col("a_item") < F.col("b_item"), F.col("b_n")).otherwise(F.col("a_n"))).alias("x_n"),
        )

    def links(self) -> DataFrame | None:
        """(p, x): links that hold every component together; sets ``roots``."""
        forest = self.forest()
        known = staged(self._possible(self.neighbours(forest)), "neighbours")
        self._gather(known)
        if self.sets is None:
            return None
        links = None
        for trees in STEPS:
            pairs = known.filter(F.col("tree").isin(trees))
            if links is not None and (pairs := staged(self._across(pairs, self.roots), "across")).isEmpty():
                continue
            more = self.linked(pairs)
            links = more if links is None else links.union(more)
            self.roots = components(links, "p", "x")
        pairs = staged(self.region_pairs(forest, self.roots, known), "pairs")
        if pairs.isEmpty():
            return links
        self._gather(pairs)
        more = self.linked(pairs)
        if not more.isEmpty():
            links = links.union(more)
            self.roots = components(links, "p", "x")
        return links

    def result(self) -> DataFrame:
        """Per document: id, n (set size), component (the smallest id)."""
        self.links()
        met = self.ids.join(self.roots, F.col("item") == F.col("node"), "left").withColumn("root", F.coalesce("root", "item"))
        least = met.groupBy("root").agg(F.min("id").alias("component"))
        of_item = met.join(least, "root").select("item", "check", "component")
        filled = self.rows.filter("n > 0").join(of_item, ["item", "check"])
        alone = self.rows.filter("n = 0").withColumn("component", F.col("id"))
        return filled.select("id", "n", "component").union(alone.select("id", "n", "component"))


def forest_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` (distinct k-word shingles), ``component_id`` and ``kept``.

    Two texts are linked when 100 * |intersection| >= percent * |union|, on whole
    sets; ``component_id`` is the smallest id reachable by links and ``kept`` marks
    its row. A text with fewer than k words has its whole sequence as one
    shingle. Null, empty and wordless texts have 0 shingles, are linked with
    nothing and kept. Repeated rows and repeated ids each give a row; a null id
    never is the smallest, and is kept only where no row of its component has
    an id. Other columns are not read, whatever their names. An empty table
    gives no rows.
    """
    found = LshForest(docs, id_col, text_col, k, percent).result()
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
