"""Best-fit packing into sequences of several permitted lengths.

Texts are cut into pieces of at most the longest length, pieces dealt by hash
into shards of bounded size, and every shard packed by decreasing best fit. A
piece goes into the open sequence it leaves the least space in. If none holds
it, a sequence is opened with the length that costs least a word, as full as the
shard's remaining pieces can make it. In the end a sequence is cut down to the
shortest permitted length that holds its contents. A shard holds tens of
thousands of pieces, so what it loses against one global packing is its last few
open sequences.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.source_mix import n_words
from wellspring.llm.store import staged

LENGTHS = (512, 1024, 2048, 4096)
SHARD_PIECES = 50_000
OVERHEAD, ATTENTION = 64, 16_384  # a sequence of c words costs c + OVERHEAD + c * c / ATTENTION


def cost(length: int) -> float:
    return length + OVERHEAD + length * length / ATTENTION


def pack(sizes: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every piece and each bin's final length. ``sizes`` in falling order, none above the longest length."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room_of: list[int] = []  # by bin
    used: list[int] = []
    open_bins: dict[int, list[int]] = {}
    rooms: list[int] = []  # sorted keys of open_bins
    rest = int(sizes.sum())
    for i, size in enumerate(sizes.tolist()):
        rest -= size
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            number = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
        else:
            length = min((c for c in lengths if c >= size), key=lambda c: (cost(c) / min(c, size + rest), c))
            number = len(used)
            used.append(0)
            room_of.append(length)
            room = length
        bins[i], offsets[i] = number, used[number]
        used[number] += size
        room -= size
        room_of[number] = room
        if room:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append(number)
    permitted = np.array(sorted(lengths))
    return bins, offsets, permitted[np.searchsorted(permitted, np.array(used, np.int64))] if used else np.zeros(0, np.int64)


def _pack_shard(lengths: tuple[int, ...]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_words", "descending"), ("serial", "ascending"), ("piece", "ascending")])
        bins, offsets, final = pack(table["n_words"].to_numpy(), lengths)
        shard = table["shard"].to_numpy()
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "serial": table["serial"],
                "piece": table["piece"],
                "start": table["start"],
                "n_words": table["n_words"],
                "bin_id": pa.array((shard << 32) | bins),
                "bin_offset": pa.array(offsets),
                "bin_length": pa.array(final[bins].astype(np.int64)),
            }
        )

    return run


def best_fit_packing(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place: one row a piece.

    ``piece`` counts a row's pieces from 0, ``start`` is its first word and
    ``n_words`` its length; ``bin_id`` names the sequence, ``bin_offset`` the
    place in it and ``bin_length`` its final length. A null, empty or wordless
    text has one row with 0 words and no sequence. Repeated rows and repeated or
    null ids are packed each by itself (``serial`` tells them apart). Equal
    sizes are placed in the order of ``serial``. An empty table gives no rows.
    Other columns are not read.
    """
    longest = max(lengths)
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_words().alias("size"))
    sized = sized.withColumn("serial", F.monotonically_increasing_id())
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("size") / longest) - 1).cast("int"))
    cut = sized.withColumn("piece", F.explode(pieces)).withColumn("start", F.col("piece").cast("long") * longest)
    cut = cut.withColumn("n_words", F.least(F.lit(longest).cast("long"), F.col("size") - F.col("start"))).drop("size")
    cut = staged(cut, "pieces")
    shards = max(1, -(-cut.count() // SHARD_PIECES))
    filled = cut.filter("n_words > 0").withColumn("shard", F.pmod(F.xxhash64("serial", "piece"), F.lit(shards).cast("long")))
    packed = filled.groupBy("shard").applyInArrow(
        _pack_shard(tuple(sorted(lengths))),
        "doc_id long, serial long, piece int, start long, n_words long, bin_id long, bin_offset long, bin_length long",
    )
    nothing = [F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_offset", "bin_length")]
    return packed.union(cut.filter("n_words = 0").select("doc_id", "serial", "piece", "start", "n_words", *nothing))
