"""Damaged copies of sound files, for the repair and error queries.

Which damage a file gets follows from a hash of its name; every copy is made
in the task that holds the path, chunk by chunk.
"""

from __future__ import annotations

import itertools
import posixpath
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from wellspring.sources.files import read_bytes
from wellspring.sources.traces import open_filesystem


CHUNK = 1 << 20  # a multiple of a line of hex text
FOLDERS = 256  # that many files are spread over, so that no one lists them all

Chunks = Iterator[bytes]


def _with_line_breaks(data: Chunks) -> Chunks:
    """Hex text, 64 bytes a line."""
    rest, started = b"", False
    for chunk in itertools.chain(data, [None]):
        rest += chunk or b""
        whole = len(rest) if chunk is None else len(rest) // 64 * 64
        digits, rest = rest[:whole].hex().encode(), rest[whole:]
        lines = b"\n".join(digits[i : i + 128] for i in range(0, len(digits), 128))
        if lines:
            yield b"\n" + lines if started else lines
            started = True


def _cut(data: Chunks, length: int) -> Chunks:
    for chunk in data:
        yield chunk[:length]
        length -= len(chunk)
        if length <= 0:
            return


def _tail(data: Chunks, more: bytes) -> Chunks:
    return itertools.chain(data, [more])


# (kind, what it makes of a file's chunks and length)
PARQUET_DAMAGE: list[tuple[str, Callable[[Chunks, int], Chunks]]] = [
    ("none", lambda d, n: d),
    ("hex", lambda d, n: _with_line_breaks(d)),
    ("trailing", lambda d, n: _tail(d, b"\n# appended by a broken transfer\n")),
    ("hex_and_trailing", lambda d, n: _with_line_breaks(_tail(d, b"FLAG{NOT_PARQUET}"))),
]

TRACE_DAMAGE: list[tuple[str, Callable[[Chunks, int], Chunks]]] = [
    ("none", lambda d, n: d),
    ("magic", lambda d, n: (b"XXXXXXXX" + c[8:] if i == 0 else c for i, c in enumerate(d))),
    ("short", lambda d, n: _cut(d, 16 + (n - 16) // 2)),
    ("extra", lambda d, n: _tail(d, b"\x00" * 7)),
    ("header", lambda d, n: _cut(d, 10)),
]


def _chunks(handle, length: int) -> Chunks:
    for at in range(0, max(length, 1), CHUNK):
        yield handle.read_at(min(CHUNK, length - at), at)


def _copies(spark: SparkSession, path: str, output: str, glob: str, kinds, every: bool) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for source in batch["path"]:
                system, inner = open_filesystem(source)
                out, folder = open_filesystem(output)
                out.create_dir(folder, recursive=True)
                name = posixpath.basename(inner)
                picked = kinds if every else [kinds[zlib.crc32(name.encode()) % len(kinds)]]
                for kind, damage in picked:
                    with system.open_input_file(inner) as handle, out.open_output_stream(f"{folder}/{kind}-{name}") as target:
                        length = handle.size()
                        for chunk in damage(_chunks(handle, length), length):
                            target.write(chunk)
                    made.append((source, kind))
            yield pd.DataFrame(made, columns=["path", "kind"])

    return read_bytes(spark, path, glob).select("path").mapInPandas(work, "path STRING, kind STRING")


def damage_parquet(spark: SparkSession, path: str, output: str, every: bool = False) -> DataFrame:
    """One damaged copy per file, or one for every kind of damage."""
    return _copies(spark, path, output, "*.parquet", PARQUET_DAMAGE, every)


def damage_traces(spark: SparkSession, path: str, output: str) -> DataFrame:
    """A copy of every file for every kind of damage."""
    return _copies(spark, path, output, "*.sgx", TRACE_DAMAGE, every=True)


def write_files(rows: DataFrame, output: str) -> DataFrame:
    """Every row of ``rows`` (name, content) as a file of its own, in a folder that follows from its name. Run the result once to write."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, folder = open_filesystem(output)
        made = set()
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                part = f"{folder}/{zlib.crc32(str(name).encode()) % FOLDERS:03d}"
                if part not in made:
                    out.create_dir(part, recursive=True)
                    made.add(part)
                with out.open_output_stream(f"{part}/{name}") as handle:
                    handle.write(content)
            yield batch[["name"]]

    return rows.select("name", "content").mapInPandas(work, "name STRING")
