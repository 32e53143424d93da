"""Exact Jaccard join of word n-gram sets, by prefix lists, skipping and derived answers.

Sets of the same content are one item from the start. Items that can reach the
similarity share an n-gram among the first few of each, in an order that puts
rare n-grams first, so these are indexed: one list of (position, size) entries
per n-gram, entries apart from each other in size or position skipped unseen.

Instead of comparing all pairs of a list, every list has a pivot, the item whose
n-grams are the most common ones (copies gather around such an item). All
members are compared with it. From these computed answers the rest is derived:
for members x and z of a list with pivot p, known overlaps |x n p| and |z n p|
bound |x n z| from both sides. Pairs that cannot reach the similarity are
skipped, pairs that must are linked, and pairs already connected need no answer
for a component. Every set also carries the parities of its n-grams over 512 cells: the cells in
which two sets differ are a lower bound of their difference, which excludes most
other pairs. Only what is left is compared by content. So a group of n near
copies costs about n comparisons, and no link between different texts is lost
for the components.

The order comes from a fixed number of counters over all n-grams of the corpus;
it decides speed alone, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.store import components, staged
from wellspring.llm.tokens import SHINGLE, digest, distinct, lower, shingle_hashes, text_chunks, words_of

COUNTER_BITS = 22  # counters of the n-gram order: a fixed 16 MB, whatever the corpus
BLOCK_BITS = 12  # counters of a row, where tasks' counters are added up
LIST_ENTRIES = 20_000  # a longer list is salted into parts of about this size, each with a pivot of its own
TURNS = 1  # rounds of comparing with one other member a list, before all that is left is compared
FILTER_BITS = 24  # of a filter that spares a shuffle of all texts: a fixed 2 MB; misses nothing
OUT_ROWS = 100_000
UNPACKED = 64  # texts of a batch that are unpacked at once
CELLS = [f"cell{i}" for i in range(8)]  # 64 parities each


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, data, offsets in text_chunks(column):
        hashes, first = shingle_hashes(words_of(lower(data), offsets), k)
        for i in range(len(offsets) - 1):
            yield row + i, distinct(hashes[first[i] : first[i + 1]])


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _parities(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & np.uint64(64 * len(CELLS) - 1)).astype(np.int64), minlength=64 * len(CELLS)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_SIGNED = ["id", "n", "item", "check", "block", "place", "hits", *CELLS]


def _blocks(hits: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(block, bits of the counters above 0, their counts) of the blocks that have any; low bytes of the counts come first, mostly zero ones last."""
    for block, counts in enumerate(hits.reshape(-1, 1 << BLOCK_BITS)):
        if (used := counts > 0).any():
            yield block, np.packbits(used).tobytes(), counts[used].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _block_counts(place: bytes, hits: bytes) -> np.ndarray:
    counts = np.zeros(1 << BLOCK_BITS, np.int64)
    counts[np.unpackbits(np.frombuffer(place, np.uint8)).astype(bool)] = np.frombuffer(hits, np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]
    return counts


def _sum_pass(batches):
    """(block, counts) of all rows of a partition's blocks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, place, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block not in sums:
                sums[block] = np.zeros(1 << BLOCK_BITS, np.int64)
            sums[block] += _block_counts(place, hits)
    counts = [np.minimum(s, 2**32 - 1).astype(np.uint32).tobytes() for s in sums.values()]
    yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(counts, pa.binary())], ["block", "hits"])


def _signature_pass(k: int):
    def run(batches):
        hits = np.zeros(1 << COUNTER_BITS, np.uint32)
        seen: set[int] = set()
        for batch in batches:
            n = batch.num_rows
            size, a, b = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            cells = np.zeros((len(CELLS), n), np.int64)
            for i, s in _sets(batch.column(1), k):
                size[i] = len(s)
                if len(s):
                    a[i], b[i] = digest(s)
                    cells[:, i] = _parities(s)
                    if a[i] not in seen:  # as the lists, which hold an item once a task
                        seen.add(int(a[i]))
                        np.add.at(hits, _counter(s), 1)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(size),
                    pa.array(a, mask=size == 0),
                    pa.array(b, mask=size == 0),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.binary()),
                    *[pa.array(c) for c in cells],
                ],
                _SIGNED,
            )
        blocks = list(_blocks(hits))
        m = len(blocks)
        yield pa.record_batch(
            [
                *[pa.nulls(m, pa.int64())] * 4,
                pa.array([block for block, _, _ in blocks], pa.int32()),
                pa.array([place for _, place, _ in blocks], pa.binary()),
                pa.array([counts for _, _, counts in blocks], pa.binary()),
                *[pa.nulls(m, pa.int64()) for _ in CELLS],
            ],
            _SIGNED,
        )

    return run


def _prefix_pass(k: int, percent: int, counters):
    """(token, salt, item, spot, rank) for the first n - ceil(n * percent / 100) + 1 n-grams of every set.

    ``spot`` is the set's size and the n-gram's place, 32 bits each; ``rank`` how
    common the set's n-grams are, its last bit whether the list has salted parts.
    """

    def run(batches):
        hits = counters.value
        usual = 2 * max(1, int(hits.mean()))
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def out():
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            return pa.record_batch([pa.array(c) for c in columns], ["token", "salt", "item", "spot", "rank"])

        for batch in batches:
            for _, s in _sets(batch.column(1), k):
                if not len(s):
                    continue
                item, _ = digest(s)
                if item in seen:  # copies within a task; copies of other tasks meet in the list
                    continue
                seen.add(item)
                count = hits[_counter(s)].astype(np.int64)
                order = np.argsort(count, kind="stable")[: len(s) - (percent * len(s) + 99) // 100 + 1]
                token, count_of = s[order].view(np.int64), count[order]
                salts = 1 + np.maximum(count_of - usual, 0) // LIST_ENTRIES
                m = len(order)
                parts.append(
                    (
                        token,
                        (abs(item) % salts).astype(np.int32),
                        np.full(m, item, np.int64),
                        len(s) << 32 | np.arange(m, dtype=np.int64),
                        int(count.mean()) << 1 | (salts > 1).astype(np.int64),
                    )
                )
                rows += m
                if rows >= OUT_ROWS:
                    yield out()
                    parts, rows = [], 0
        if parts:
            yield out()

    return run


def _packed(texts: pa.Array) -> pa.Array:
    """Every text compressed by itself, behind its length in bytes."""
    raw = texts.cast(pa.large_binary()).to_pylist()
    return pa.array([len(t).to_bytes(8, "little") + pa.compress(t, "zstd", asbytes=True) for t in raw], pa.binary())


def _unpacked(packed: pa.Array) -> pa.Array:
    raw = [pa.decompress(t[8:], int.from_bytes(t[:8], "little"), "zstd", asbytes=True) for t in packed.to_pylist()]
    return pa.array(raw, pa.large_binary()).cast(pa.large_string())


def _overlap_pass(k: int):
    """Adds the exact overlap of two texts' sets; neighbouring rows often share the first text."""

    def run(batches):
        last, last_set = None, None
        for whole in batches:
            for start in range(0, whole.num_rows, UNPACKED):
                batch = whole.slice(start, UNPACKED)
                left, right = batch.column(2), _unpacked(batch.column(3))
                found = np.zeros(batch.num_rows, np.int64)
                for i, s in _sets(right, k):
                    if (p := batch.column(0)[i].as_py()) != last:
                        (_, last_set), last = next(iter(_sets(_unpacked(left.slice(i, 1)), k))), p
                    found[i] = len(np.intersect1d(last_set, s, assume_unique=True))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found)], ["p", "x", "overlap"])

    return run


def _wanted_pass(k: int, bits):
    """(item, packed text) of the texts whose item the filter may hold, once a task."""

    def run(batches):
        wanted = bits.value
        seen: set[int] = set()
        for batch in batches:
            rows, items = [], []
            for i, s in _sets(batch.column(1), k):
                if not len(s):
                    continue
                item, _ = digest(s)
                cell = (item & (1 << 64) - 1) >> (64 - FILTER_BITS)
                if item not in seen and wanted[cell >> 3] >> (7 - (cell & 7)) & 1:
                    seen.add(item)
                    rows.append(i)
                    items.append(item)
            if rows:
                yield pa.record_batch([pa.array(items, pa.int64()), _packed(batch.column(1).take(pa.array(rows)))], ["item", "text"])

    return run


class JaccardJoin:
    """One run over ``docs``; ``result`` has the documents, ``links`` the linked pairs that hold components together."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = 80):
        if not 50 < percent <= 100:
            raise ValueError("percent must be above 50 and at most 100")
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        self.spark = docs.sparkSession
        first = staged(
            self.docs.mapInArrow(
                _signature_pass(k),
                "id long, n long, item long, check long, block int, place binary, hits binary, " + ", ".join(f"{c} long" for c in CELLS),
            ),
            "sets",
        )
        self.rows = first.filter("block is null").select("id", "n", "item", "check")
        one = [F.min("id").alias("id"), F.max("n").alias("n"), *[F.max(c).alias(c) for c in CELLS]]  # cells follow from the set
        self.items = staged(first.filter("n > 0").groupBy("item", "check").agg(*one), "items")
        blocks = first.filter("block is not null").select("block", "place", "hits").repartition("block")
        table = blocks.mapInArrow(_sum_pass, "block int, hits binary").toArrow()  # at most 2**(COUNTER_BITS - BLOCK_BITS) rows
        hits = np.zeros((1 << COUNTER_BITS - BLOCK_BITS, 1 << BLOCK_BITS), np.uint32)
        for block, counts in zip(*(c.to_pylist() for c in table.columns), strict=True):
            hits[block] = np.frombuffer(counts, np.uint32)
        hits = hits.reshape(-1)
        self.counters = self.spark.sparkContext.broadcast(hits)

    def _near(self, a: str, b: str | F.Column) -> F.Column:
        """The sizes allow the similarity."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def _enough(self, overlap: F.Column, a: str, b: str) -> F.Column:
        """100 * overlap >= percent * union, in whole numbers."""
        return overlap * (100 + self.percent) >= (F.col(a).cast("long") + F.col(b)) * self.percent

    def _with_cells(self, df: DataFrame, column: str, prefix: str) -> DataFrame:
        cells = self.items.groupBy("item").agg(*[F.max(c).alias(f"{prefix}{c}") for c in CELLS], F.max("n").alias(f"{prefix}size"))
        return df.join(cells.withColumnRenamed("item", column), column)

    def _cells_allow(self, a: str, b: str, a_size: str, b_size: str) -> F.Column:
        """At least as many n-grams are in one set only as there are cells whose parity differs."""
        apart = sum((F.bit_count(F.col(a + c).bitwiseXOR(F.col(b + c))) for c in CELLS), F.lit(0))
        both = F.col(a_size).cast("long") + F.col(b_size)
        return (both - apart) * (100 + self.percent) >= both * (2 * self.percent)

    def index(self) -> DataFrame:
        """Entries with their list's pivot: lists of two or more items, and of a salted list every part, also one with one item.

        ``open`` marks what comparing with the pivots may leave to compare: in a
        list of one part, members other than the pivot that have one of a near
        size beside them, and their pivot; of a salted list all.
        """
        entries = self.docs.mapInArrow(_prefix_pass(self.k, self.percent, self.counters), "token long, salt int, item long, spot long, rank long")
        of_part = Window.partitionBy("token", "salt")
        by = of_part.orderBy(F.desc("rank"), "item")
        to_here = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        entries = entries.select(
            "token",
            "salt",
            "item",
            "spot",
            "rank",
            F.first("item").over(to_here).alias("p"),
            F.first("spot").over(to_here).alias("p_spot"),
            F.lead("item").over(by).alias("next"),
        )
        salted = F.col("rank").bitwiseAND(1) == 1
        # copies in several tasks leave one entry; a part with one item keeps it, since the other parts may hold items like it
        entries = entries.filter("next is null or item != next").filter(F.expr("item != p or next is not null") | salted)
        size, place = (lambda c: F.shiftright(c, 32).cast("int")), (lambda c: F.col(c).bitwiseAND((1 << 32) - 1).cast("int"))
        entries = entries.select(
            "token",
            "salt",
            "item",
            size("spot").alias("n"),
            place("spot").alias("place"),
            F.shiftright("rank", 1).alias("weight"),
            "p",
            size("p_spot").alias("p_n"),
            place("p_spot").alias("p_place"),
            salted.alias("salted"),
        )
        member = F.col("item") != F.col("p")
        by_size = of_part.orderBy(member.desc(), "n")
        beside = [F.lag("n").over(by_size), F.lead(F.when(member, F.col("n"))).over(by_size)]
        entries = entries.withColumn("near", member & reduce(or_, [n.isNotNull() & self._near("n", n) for n in beside]))
        open_ = F.col("salted") | F.when(member, F.col("near")).otherwise(F.max("near").over(of_part))
        return staged(entries.withColumn("open", open_).drop("near"), "index")

    def star_pairs(self, index: DataFrame) -> DataFrame:
        """(p, x): every member with its list's pivot, and the pivots of a salted list's parts with the first part's."""
        left = F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place"))  # shared from here on, at most
        members = index.filter("item != p").filter(self._near("n", "p_n") & self._enough(left + F.least("place", "p_place"), "n", "p_n"))
        salted = index.filter("item = p").groupBy("token").agg(F.min("p").alias("p"), F.max("salt").alias("parts")).filter("parts > 0")
        between = index.filter("item = p").join(salted.select("token", F.col("p").alias("q")), "token").filter("p != q")
        pairs = members.select("p", F.col("item").alias("x")).union(between.select(F.col("q").alias("p"), F.col("p").alias("x"))).distinct()
        pairs = self._with_cells(self._with_cells(pairs, "p", "p_"), "x", "x_")
        return pairs.filter(self._cells_allow("p_", "x_", "p_size", "x_size")).select(
            "p", "x", F.lit(False).alias("sure"), "p_size", "x_size"
        )

    def texts(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (item, as_p, as_x) with one text of each item.

        The items are found by content, so null and repeated ids play no part;
        texts that the filter excludes stay where they are.
        """
        cells = wanted.select(F.shiftrightunsigned("item", 64 - FILTER_BITS).alias("cell")).distinct().toArrow()
        held = np.zeros(1 << FILTER_BITS, bool)
        held[cells["cell"].to_numpy()] = True  # at most 2**FILTER_BITS cells
        bits = self.spark.sparkContext.broadcast(np.packbits(held))
        found = self.docs.mapInArrow(_wanted_pass(self.k, bits), "item long, text binary")
        return found.join(wanted, "item").dropDuplicates(["item"])

    def overlaps(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """(p, x, overlap), counted on whole texts; a text moves for the sides that it stands on."""
        x_texts = texts.filter("as_x").select(F.col("item").alias("x"), F.col("text").alias("x_text"))
        p_texts = texts.filter("as_p").select(F.col("item").alias("p"), F.col("text").alias("p_text"))
        both = pairs.select("p", "x").join(x_texts, "x").join(p_texts, "p")
        return both.select("p", "x", "p_text", "x_text").mapInArrow(_overlap_pass(self.k), "p long, x long, overlap long")

    def with_sizes(self, overlaps: DataFrame) -> DataFrame:
        size = self.items.groupBy("item").agg(F.max("n").alias("size"))
        return (
            overlaps.join(size.select(F.col("item").alias("p"), F.col("size").alias("p_size")), "p")
            .join(size.select(F.col("item").alias("x"), F.col("size").alias("x_size")), "x")
            .select("p", "x", "overlap", "p_size", "x_size")
        )

    def open_entries(self, index: DataFrame, known: DataFrame, roots: DataFrame) -> DataFrame:
        """Open entries of lists whose members span two or more components, with their root and their overlap with the list's pivot."""
        entries = index.filter("open").join(roots, F.col("item") == F.col("node"), "left").withColumn("root", F.coalesce("root", "item")).drop("node")
        # the pivot of a list's only part has been compared with every member
        lists = entries.filter("salted or item != p").groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b")
        answers = known.select("p", F.col("x").alias("item"), "overlap")
        open_ = entries.join(lists, "token", "semi").join(answers, ["p", "item"], "left")
        open_ = open_.select("token", "item", "n", "place", "weight", "p", "p_n", "root", "overlap")
        return staged(self._with_cells(open_, "item", "").drop("size"), "open")

    def left_pairs(self, entries: DataFrame, known: DataFrame, against: DataFrame | None = None) -> DataFrame:
        """(p, x, sure): pairs of a list in two components, which no pivot's answers exclude and nobody has compared.

        ``sure`` marks pairs that the pivot's answers prove to be linked. With
        ``against``, one entry a list, only pairs with that entry.
        """
        a = (entries if against is None else against).select(*[F.col(c).alias(f"a_{c}") for c in entries.columns])
        b = entries.select(*[F.col(c).alias(f"b_{c}") for c in entries.columns])
        apart = F.col("a_root") < F.col("b_root") if against is None else F.col("a_root") != F.col("b_root")
        place = F.least("a_place", "b_place") + F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
        same = F.col("a_p") == F.col("b_p")
        by_pivot = same & ((F.col("a_item") == F.col("a_p")) | (F.col("b_item") == F.col("b_p")))
        most = F.least("a_overlap", "b_overlap") + F.least(F.col("a_n") - F.col("a_overlap"), F.col("b_n") - F.col("b_overlap"))
        least = F.col("a_overlap") + F.col("b_overlap") - F.col("a_p_n")
        may = ~same | F.coalesce(self._enough(most, "a_n", "b_n"), F.lit(True))
        near = self._near("a_n", "b_n") & self._enough(place, "a_n", "b_n")
        cells = self._cells_allow("a_", "b_", "a_n", "b_n")
        pairs = a.join(b, (F.col("a_token") == F.col("b_token")) & apart & near & ~by_pivot & may & cells)
        sure = same & F.coalesce(self._enough(least, "a_n", "b_n"), F.lit(False))
        pairs = pairs.groupBy(F.least("a_item", "b_item").alias("p"), F.greatest("a_item", "b_item").alias("x")).agg(
            F.max(sure).alias("sure"),
            F.max(F.when(F.col("a_item") < F.col("b_item"), F.col("a_n")).otherwise(F.col("b_n"))).alias("p_size"),
            F.max(F.when(F.col("a_item") < F.col("b_item"), F.col("b_n")).otherwise(F.col("a_n"))).alias("x_size"),
        )
        done = known.select(F.least("p", "x").alias("p"), F.greatest("p", "x").alias("x"))
        return pairs.join(done, ["p", "x"], "anti")

    def other_pivots(self, entries: DataFrame, turn: int) -> DataFrame:
        """One entry of every open list from outside its first pivot's component, each turn another one."""
        mine = entries.filter("item = p").select("token", F.col("root").alias("p_root")).distinct()
        by = F.struct("weight", "item") if turn == 0 else F.xxhash64("token", "item", F.lit(turn))
        chosen = entries.join(mine, "token").filter("root != p_root").groupBy("token").agg(F.max_by("item", by).alias("item"))
        return entries.join(chosen, ["token", "item"]).select(*entries.columns).dropDuplicates(["token"])

    def compare(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(overlaps, links) of ``pairs``, sure ones unseen."""
        sure, pairs = pairs.filter("sure").select("p", "x"), pairs.filter("not sure")
        sides = pairs.select(F.col("p").alias("item"), F.lit(True).alias("as_p")).union(pairs.select("x", F.lit(False)))
        wanted = sides.groupBy("item").agg(F.max("as_p").alias("as_p"), F.max(~F.col("as_p")).alias("as_x"))
        texts = staged(self.texts(staged(wanted, "wanted")), "texts")
        found = staged(self.overlaps(pairs, texts).join(pairs, ["p", "x"]).select("p", "x", "overlap", "p_size", "x_size"), "overlaps")
        links = found.filter(self._enough(F.col("overlap"), "p_size", "x_size")).select("p", "x")
        return found, links.union(sure)

    def links(self) -> DataFrame:
        """(p, x): links between items that hold every component together."""
        index = self.index()
        known, links = self.compare(staged(self.star_pairs(index), "pairs"))
        roots, turn = components(links, "p", "x"), 0
        while turn <= TURNS:
            entries = self.open_entries(index, known, roots)
            if entries.isEmpty():
                break
            against = self.other_pivots(entries, turn) if turn < TURNS else None
            pairs = staged(self.left_pairs(entries, known, against), "pairs")
            turn += 1
            if pairs.isEmpty():  # nothing with the other pivots: on to what is left
                continue
            more_known, more_links = self.compare(pairs)
            known, links = known.union(more_known), links.union(more_links)
            if turn <= TURNS:
                roots = components(links, "p", "x")
        return links

    def result(self) -> DataFrame:
        """Per document: id, n (set size), component (the smallest id), item and check (the set's 128-bit digest)."""
        roots = components(self.links(), "p", "x")
        items = self.items.join(roots, F.col("item") == F.col("node"), "left").withColumn("root", F.coalesce("root", "item"))
        least = items.groupBy("root").agg(F.min("id").alias("component"))
        of_item = items.join(least, "root").select("item", "check", "component")
        filled = self.rows.filter("n > 0").join(of_item, ["item", "check"])
        alone = self.rows.filter("n = 0").withColumn("component", F.col("id"))
        columns = ["id", "n", "component", "item", "check"]
        return filled.select(*columns).union(alone.select(*columns))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` (distinct k-word shingles) and ``component_id``.

    Two texts are linked when 100 * |intersection| >= percent * |union|;
    ``component_id`` is the smallest id reachable by links. A text with fewer
    than k words has its whole sequence as one shingle. Null, empty and
    wordless texts have 0 shingles and their own id as component. Repeated rows
    and repeated ids each give a row; a null id never is the smallest. Other
    columns are not read, whatever their names. An empty table gives no rows.
    """
    found = JaccardJoin(docs, id_col, text_col, k, percent).result()
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
