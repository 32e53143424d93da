"""The trie of shared conversation beginnings, by adaptive radix trees.

A turn becomes a fixed-width big-endian id (16 bytes of SHA-256 over role and
text), a conversation the concatenation of its ids: a byte key. Keys are range
partitioned and sorted together with their conversation ids, so a task holds a
contiguous piece of the trie, also where a third of all conversations have one
key. Every piece is built as an adaptive radix tree: nodes grow from 4 over 16
and 48 to 256 branches, single-branch paths are compressed into a prefix, and
only byte depths that end a turn come out as nodes.

A node that lies on the path of neither the first nor the last key of its piece
is complete there and needs no further shuffle. Those on the two edge paths are
partial; they are few (two paths a piece), are added up by node, and their
subtree sums go to their ancestors along the path they carry.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm.store import staged

WIDTH = 16  # bytes of a turn id
PIECE_KEYS, PIECE_ROWS, PIECE_BYTES = 20_000, 100_000, 16 << 20  # a piece ends at the first of these
FAMILY = 20  # conversations c - c % FAMILY lends its first turns to c
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- adaptive radix tree ---------------------------------------------------

class Sorted:
    """Up to ``room`` branches as sorted bytes with their children: the layouts of 4 and of 16."""

    __slots__ = ("labels", "nodes", "room")

    def __init__(self, room: int = 4):
        self.labels, self.nodes, self.room = bytearray(), [], room

    def get(self, label: int):
        at = bisect_left(self.labels, label)
        return self.nodes[at] if at < len(self.labels) and self.labels[at] == label else None

    def put(self, label: int, node):
        """The layout that now holds the branch: this one or the next larger."""
        at = bisect_left(self.labels, label)
        if at < len(self.labels) and self.labels[at] == label:
            self.nodes[at] = node
            return self
        if len(self.labels) < self.room:
            self.labels.insert(at, label)
            self.nodes.insert(at, node)
            return self
        grown = Sorted(16) if self.room == 4 else Indexed()
        for old, child in zip(self.labels, self.nodes, strict=True):
            grown = grown.put(old, child)
        return grown.put(label, node)

    def children(self) -> list:
        return self.nodes


class Indexed:
    """Up to 48 branches: a byte index into the children."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(b"\xff" * 256), []

    def get(self, label: int):
        at = self.index[label]
        return None if at == 255 else self.nodes[at]

    def put(self, label: int, node):
        at = self.index[label]
        if at != 255:
            self.nodes[at] = node
            return self
        if len(self.nodes) < 48:
            self.index[label] = len(self.nodes)
            self.nodes.append(node)
            return self
        grown = Direct()
        for old in range(256):
            if self.index[old] != 255:
                grown.put(old, self.nodes[self.index[old]])
        return grown.put(label, node)

    def children(self) -> list:
        return [self.nodes[at] for at in self.index if at != 255]


class Direct:
    """One place for each of 256 branches."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, label: int):
        return self.nodes[label]

    def put(self, label: int, node):
        self.nodes[label] = node
        return self

    def children(self) -> list:
        return [n for n in self.nodes if n is not None]


class Node:
    """``prefix``: the compressed bytes after the branch byte; ``ends``: ids whose key ends here."""

    __slots__ = ("prefix", "branches", "ends", "sample", "start", "stop", "n", "least", "leaves", "saved", "tops")

    def __init__(self, prefix: bytes):
        self.prefix, self.branches, self.ends, self.sample = prefix, Sorted(), [], None


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1  # bisected: the first difference is at most at high
    while low < high:
        middle = (low + high) // 2
        if a[: middle + 1] == b[: middle + 1]:
            low = middle + 1
        else:
            high = middle
    return low


class RadixTree:
    """Keys of whole turns, each with the conversations that have it and the words of its turns."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, words: list[int]) -> Node:
        """The node at which ``key`` ends."""
        if self.root is None:
            self.root = Node(key)
            self.root.sample = key, words
            return self.root
        node, above, label, at = self.root, None, 0, 0
        while True:
            rest = key[at:]
            same = _shared(node.prefix, rest)
            if same < len(node.prefix):  # the path forks inside the prefix
                fork = Node(node.prefix[:same])
                fork.branches = fork.branches.put(node.prefix[same], node)
                node.prefix = node.prefix[same + 1 :]
                if above is None:
                    self.root = fork
                else:
                    above.branches = above.branches.put(label, fork)
                node = fork
            at += same
            if at == len(key):
                node.sample = key, words
                return node
            child = node.branches.get(key[at])
            if child is None:
                child = Node(key[at + 1 :])
                child.sample = key, words
                node.branches = node.branches.put(key[at], child)
                return child
            above, label, node, at = node, key[at], child, at + 1

    def measure(self) -> list[Node]:
        """Byte depths and subtree sums of every node; returns the nodes, parents first."""
        order, stack = [], [(self.root, 0, 0)]
        while stack:
            node, start, at = stack.pop()
            node.start, node.stop = start, at + len(node.prefix)
            order.append(node)
            # a child's edge begins behind this node's end and includes the branch byte
            stack.extend((c, node.stop + 1, node.stop + 1) for c in node.branches.children())
        for node in reversed(order):
            below = node.branches.children()
            node.n = len(node.ends) + sum(c.n for c in below)
            node.least = min([*node.ends[:1], *[c.least for c in below]])
            if node.sample is None:
                node.sample = below[0].sample
            node.leaves, node.saved = sum(c.leaves for c in below), sum(c.saved for c in below)
            node.tops = sum(c.tops for c in below)
            depths = turn_depths(node)
            if depths:
                node.leaves = node.leaves if node.tops else 1
                node.saved += (node.n - 1) * sum(node.sample[1][d - 1] for d in depths if d)
                node.tops = 1
        return order


def turn_depths(node: Node) -> range:
    """Turn-aligned depths on the node's edge."""
    return range(-(-node.start // WIDTH), node.stop // WIDTH + 1)


# --- one piece of the sorted keys ------------------------------------------

_FIELDS = [
    ("node", pa.binary()),
    ("depth", pa.int64()),
    ("parent", pa.binary()),
    ("edge", pa.bool_()),
    ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
    ("words", pa.int64()),
    ("path", pa.list_(pa.binary())),
    ("first_end", pa.int64()),
    ("ends", pa.string()),
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = (
    "node binary, depth long, parent binary, edge boolean, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, words long, path array<binary>, first_end long, ends string"
)


def _piece_rows(tree: RadixTree, first: bytes, last: bytes) -> Iterator[tuple]:
    """Rows of all turn-aligned nodes: complete ones, and sums without edge nodes for those on the two edge paths."""
    order = tree.measure()
    edges: dict[bytes, list] = {}
    # (digest state, parent digest, parent's least id or None on an edge, path of the parent on an edge)
    came = {id(tree.root): (hashlib.blake2b(digest_size=WIDTH), None, None, ())}
    for node in order:
        state, parent, parent_id, path = came.pop(id(node))
        key, words = node.sample
        depths = turn_depths(node)
        below = node.branches.children()
        childless = sum(c.tops for c in below)
        saved = node.saved
        for d in depths:
            if d:
                state = state.copy()
                state.update(key[(d - 1) * WIDTH : d * WIDTH])
            digest = state.digest()
            count = words[d - 1] if d else 0
            ends = node.ends if d * WIDTH == node.stop else []
            text = ",".join(map(str, ends)) if ends else None
            if first.startswith(key[: d * WIDTH]) or last.startswith(key[: d * WIDTH]):
                path = (*path, digest)
                edges[digest] = [d, parent, node.least, node.n, 0, 0, 0, count, path, ends[0] if ends else None, text]
                parent, parent_id = digest, None
                saved -= (node.n - 1) * count
                continue
            if parent in edges:  # the shallowest complete node below an edge node
                sums = edges[parent]
                sums[4] += 1
                sums[5] += node.leaves
                sums[6] += saved
            children = childless if d == depths[-1] else 1
            sha = hashlib.sha256(text.encode()).hexdigest() if ends else _EMPTY
            yield (digest, d, parent, False, node.least, parent_id, node.n, children, node.leaves, saved, sha, count, None, None, None)
            parent, parent_id, path = digest, node.least, ()
            saved -= (node.n - 1) * count
        for child in below:
            came[id(child)] = state, parent, parent_id, path
    for digest, (d, parent, least, n, children, leaves, saved, count, path, first_end, text) in edges.items():
        yield (digest, d, parent, True, least, None, n, children, leaves, saved, None, count, list(path), first_end, text)


def _batches_of(rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
            part = []
    if part:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _tree_pass(piece_keys: int, piece_rows: int):
    """Sorted (key, conv_id, words) to node rows, piece by piece."""

    def run(batches):
        tree, node = RadixTree(), None
        first = last = None
        keys = rows = held = 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for key, conv_id, words in zip(*columns, strict=True):
                if keys and (rows >= piece_rows or key != last and (keys >= piece_keys or held >= PIECE_BYTES)):
                    yield from _batches_of(_piece_rows(tree, first, last))
                    tree, node, first, keys, rows, held = RadixTree(), None, None, 0, 0, 0
                if node is None or key != last:
                    node = tree.insert(key, words)
                    keys, held = keys + 1, held + len(key)
                if first is None:
                    first = key
                last = key
                node.ends.append(conv_id)
                rows += 1
        if keys:
            yield from _batches_of(_piece_rows(tree, first, last))

    return run


def _digest_pass(batches):
    """(node, first_end, ends) sorted by these to (node, ends_sha256): the pieces of a node hashed one after another."""
    node, state = None, None
    for batch in batches:
        out = []
        for at, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if at != node:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(text.encode())
            else:
                state.update(b",")
                state.update(text.encode())
        if out:
            yield pa.record_batch([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out])], ["node", "ends_sha256"])
    if node is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


# --- conversations to keys -------------------------------------------------

def _turn_id(role: Column, text: Column) -> Column:
    """32 hex digits; the length in front keeps role and text apart."""
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * WIDTH)


def rebuilt_conversations(conversations: DataFrame, family: int = FAMILY) -> DataFrame:
    """(conv_id, key, words): every conversation as its byte key, its first turns taken from its family's first conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("placed"),
            F.col("turn").cast("long").alias("turn"),
            _turn_id(role, text).alias("id"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("t"),
    )
    own = staged(turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")), "conversations")
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    lent = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    whole = own.withColumns({"base": base, "h": lent}).join(heads.filter(F.col("base") % family == 0), "base", "left")
    none = F.array().cast(own.schema["turns"].dataType)
    kept = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns")))
    rebuilt = whole.select("conv_id", kept.alias("turns"))
    return rebuilt.select(
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
        "conv_id",
        F.transform("turns", lambda t: t["words"].cast("long")).alias("words"),
    )


def trie_nodes(keys: DataFrame, piece_keys: int = PIECE_KEYS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The nodes of the trie over ``keys`` (key, conv_id, words); see ``conversation_trie``."""
    ordered = staged(keys, "keys").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = staged(ordered.mapInArrow(_tree_pass(piece_keys, piece_rows), _DDL), "trie")
    partial = rows.filter("edge")
    edge = partial.groupBy("node").agg(
        F.max("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.max("words").alias("words"),
        F.first("path").alias("path"),
    )
    edge = staged(edge, "edges")
    others = edge.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("edge_children"))
    children = F.col("n_children") + F.coalesce("edge_children", F.lit(0))
    met = edge.join(others, "node", "left").withColumn("n_children", children)
    met = met.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    up = (
        met.select(
            F.explode("path").alias("node"),
            (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        )
        .groupBy("node")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    ends = partial.filter("ends is not null").select("node", "first_end", "ends").repartition("node")
    ends = ends.sortWithinPartitions("node", "first_end").mapInArrow(_digest_pass, "node binary, ends_sha256 string")
    parents = edge.select(F.col("node").alias("parent"), F.col("conv_id").alias("edge_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    edge_nodes = (
        met.drop("n_leaves", "saved_tokens")
        .join(up, "node")
        .join(ends, "node", "left")
        .join(parents, "parent", "left")
        .withColumns({"parent_conv_id": F.col("edge_conv_id"), "ends_sha256": F.coalesce("ends_sha256", F.lit(_EMPTY))})
    )
    inner = rows.filter("not edge").join(parents, "parent", "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "edge_conv_id"))
    return inner.select(*columns).union(edge_nodes.select(*columns))


def conversation_trie(conversations: DataFrame, family: int = FAMILY) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    Turns stand by ``turn``, null first, ties by the hash of role and text; null
    role and text are empty. Rows without a ``conv_id`` take no part. Repeated
    rows are turns of their own. A conversation without turns ends at the root;
    an empty table has no nodes. Other columns are not read, whatever their
    names. A conversation's turn ids (texts never) are in one row: 16 bytes a turn.
    """
    return trie_nodes(rebuilt_conversations(conversations, family))
