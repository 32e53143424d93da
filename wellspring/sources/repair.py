"""Triage and repair of damaged Parquet files.

Each file is handled on its own, in one task, and gives one manifest row;
a failure is a row, not an exception. Spark distributes the files by size.
"""

from __future__ import annotations

import bisect
import io
import posixpath
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.patterns import DEFAULT_PATTERNS, bytes_as_text, hex_share
from wellspring.sources.files import find_files, read_bytes
from wellspring.sources.ranges import LONGEST_MATCH, RANGE_BYTES, first_matches
from wellspring.sources.traces import list_files, open_filesystem

# The Parquet marker, its hex text's first characters, and the hex test.
MARKER = b"PAR1"
HEX_STARTS = ["50", "35"]
HEX_SAMPLE = 100
HEX_LIMIT = 0.9
_DIGITS = b"0123456789abcdefABCDEF"

CHUNK = 1 << 20

MANIFEST = (
    "path STRING, original_size BIGINT, was_hex BOOLEAN, decoded_size BIGINT, n_markers BIGINT, cut_at BIGINT, "
    "status STRING, message STRING, output STRING, rows BIGINT"
)


def _all_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path, length, content of every file. Spark's scan passes over empty files; they are added here."""
    files = read_bytes(spark, path, glob).select("path", "length", "content")
    empty = [(name,) for name, size in list_files(path, glob) if size == 0]
    if not empty:
        return files
    added = spark.createDataFrame(empty, "path STRING")
    return files.unionByName(
        added.select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content"))
    )


def classify_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Per file: size, hex text or not, number of markers, and what a repair would do.

    Built-in functions over the file's bytes. For hex text the markers are
    counted in the decoded bytes.
    """
    files = _all_files(spark, path, glob)
    text = bytes_as_text("content")
    share = F.coalesce(hex_share(text, HEX_SAMPLE), F.lit(0.0))
    is_hex = F.substring(text, 1, 2).isin(HEX_STARTS) & (share > HEX_LIMIT)
    decoded = F.when(is_hex, bytes_as_text(F.unhex(F.regexp_replace(text, r"\s", "")))).otherwise(text)
    known = files.select("path", F.col("length").alias("original_size"), is_hex.alias("was_hex"), decoded.alias("_text"))
    marker = MARKER.decode()
    counted = known.select(
        "path",
        "original_size",
        "was_hex",
        F.coalesce(F.regexp_count("_text", F.lit(marker)), F.lit(0)).alias("n_markers"),
        (F.position(F.lit(marker), F.col("_text")) - 1).alias("first_marker"),
        F.length("_text").alias("_size"),
        (F.length("_text") - F.length(F.substring_index("_text", marker, -1))).alias("cut_at"),
    )
    status = (
        F.when(F.col("n_markers").isNull() | (F.col("n_markers") == 0), "no_marker")
        .when((F.col("n_markers") > 1) & (F.col("first_marker") != 0), "marker_not_first")
        .when(F.col("n_markers") == 1, "single_marker")
        .when(F.col("was_hex") & (F.col("cut_at") < F.col("_size")), "hex_and_trailing")
        .when(F.col("was_hex"), "hex")
        .when(F.col("cut_at") < F.col("_size"), "trailing")
        .otherwise("whole")
    )
    return counted.withColumn("status", status).select(
        "path", "original_size", "was_hex", "n_markers", "cut_at", "status"
    )


def looks_hex(data: bytes) -> bool:
    sample = data[:HEX_SAMPLE]
    if data[:2].decode("latin-1") not in HEX_STARTS or not sample.isascii():
        return False
    return len(re.findall(rb"[0-9A-Fa-f]", sample)) / len(sample) > HEX_LIMIT


class _View(io.RawIOBase):
    """The first ``size`` bytes of a file, or of what its hex text stands for, read at any place; one chunk of text is held."""

    def __init__(self, handle, length: int):
        self.handle, self.length, self.size, self.at = handle, length, length, 0
        self.places: list[tuple[int, int, int]] = []  # of hex text: byte, and begin and end of the chunk of text
        self.held = (0, b"")

    def decode(self) -> Iterator[bytes]:
        """All bytes that the hex text stands for; notes where its chunks begin."""
        at, kept, size = 0, b"", 0
        while at < self.length:
            begin = at - len(kept)
            text = kept + self.handle.read_at(min(CHUNK, self.length - at), at)
            at = begin + len(text)
            # the digits of a byte stay together
            odd = (len(text) - len(text.rstrip(_DIGITS))) % 2
            kept = text[-1:] if odd and at < self.length else b""
            try:
                chunk = bytes.fromhex(text[: len(text) - len(kept)].decode("ascii"))
            except ValueError as error:
                raise ValueError(self._said(begin, error)) from error
            self.places.append((size, begin, at - len(kept)))
            size += len(chunk)
            yield chunk
        self.size = size

    def _said(self, begin: int, error: ValueError) -> str:
        """The error as decoding the whole text at once gives it."""
        for at in range(0, self.length, CHUNK):
            text = self.handle.read_at(min(CHUNK, self.length - at), at)
            if not text.isascii():
                i = next(i for i, c in enumerate(text) if c > 127)
                return f"'ascii' codec can't decode byte 0x{text[i]:02x} in position {at + i}: ordinal not in range(128)"
        return re.sub(r"position (\d+)", lambda m: f"position {begin + int(m[1])}", str(error))

    def chunks(self) -> Iterator[bytes]:
        for at in range(0, self.size, CHUNK):
            yield self.read_at(min(CHUNK, self.size - at), at)

    def read_at(self, n: int, at: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if not self.places:
            return self.handle.read_at(n, at) if n else b""
        out = []
        while n:
            first, data = self.held
            if not first <= at < first + len(data):
                first, begin, end = self.places[bisect.bisect_right(self.places, at, key=lambda p: p[0]) - 1]
                data = bytes.fromhex(self.handle.read_at(end - begin, begin).decode("ascii"))
                self.held = (first, data)
            out.append(data[at - first : at - first + n])
            at, n = at + len(out[-1]), n - len(out[-1])
        return b"".join(out)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def read(self, n: int = -1) -> bytes:
        data = self.read_at(self.size - self.at if n is None or n < 0 else n, self.at)
        self.at += len(data)
        return data


def _readable(view: _View) -> int | None:
    """Number of rows if the bytes are a readable Parquet file."""
    try:
        rows = 0
        file = pq.ParquetFile(pa.PythonFile(view, mode="r"), buffer_size=CHUNK, pre_buffer=False)
        for batch in file.iter_batches(use_threads=False):
            rows += batch.num_rows
        return rows
    except Exception:
        return None


def _markers(chunks: Iterable[bytes]) -> tuple[int, int, bool]:
    """How many markers, where the last one begins, and whether the first bytes are one. A marker does not overlap itself."""
    n, last, at, end = 0, -1, 0, b""
    first = False
    for chunk in chunks:
        data = end + chunk
        found = data.count(MARKER)
        if found:
            n, last = n + found, at - len(end) + data.rfind(MARKER)
        if at - len(end) == 0:
            first = data.startswith(MARKER)
        at, end = at + len(chunk), data[-len(MARKER) + 1 :]
    return n, last, first


def repair_file(handle, length: int, pre_steps: Sequence[Callable[[bytes], bytes]] = ()) -> tuple[_View | None, dict]:
    """A view of the repaired bytes, or None, and the facts for the manifest. Only ``pre_steps`` get the bytes as a whole."""
    facts = {"original_size": length, "was_hex": False, "decoded_size": length, "n_markers": 0,
             "cut_at": None, "status": "failed", "message": "", "rows": None}
    if pre_steps:
        data = handle.read_at(length, 0) if length else b""
        for step in pre_steps:
            data = step(data)
        handle, length = pa.BufferReader(data), len(data)
    view = _View(handle, length)
    head = view.read_at(HEX_SAMPLE, 0)
    if looks_hex(head):
        facts["was_hex"] = True
        try:
            n, last, first = _markers(view.decode())
        except ValueError as error:
            facts["message"] = f"hex decoding failed: {error}"
            return None, facts
    else:
        n, last, first = _markers(view.chunks())
    facts["decoded_size"] = view.size
    facts["n_markers"] = n
    if n == 0:
        facts["message"] = "no marker"
        return None, facts
    if n > 1:
        if not first:
            facts["message"] = "first marker not at the start"
            return None, facts
        facts["cut_at"] = view.size = last + len(MARKER)
    facts["rows"] = _readable(view)
    if facts["rows"] is None:
        facts["message"] = "not readable after repair"
        return None, facts
    facts["status"] = "repaired"
    facts["message"] = "decoded" if facts["was_hex"] else "read as it is"
    if facts["cut_at"] is not None and facts["cut_at"] < facts["decoded_size"]:
        facts["message"] = f"cut {facts['decoded_size'] - facts['cut_at']} trailing bytes"
    return view, facts


def repair_dir(
    spark: SparkSession,
    path: str,
    output: str,
    glob: str = "*.parquet",
    pre_steps: Sequence[Callable[[bytes], bytes]] = (),
) -> DataFrame:
    """Repair every file of a folder into ``output``; the result is the manifest, one row per file.

    The rows sent to Python are paths; a task opens its files one at a time
    and reads them in chunks.
    Output names carry a hash of the input path, so a retried task rewrites
    its own file and equal names from different folders do not collide. Run the
    returned DataFrame once (for instance by writing it) to do the work.
    """

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            rows = []
            for source in batch["path"]:
                system, inner = open_filesystem(source)
                target = None
                try:
                    with system.open_input_file(inner) as handle:
                        view, facts = repair_file(handle, handle.size(), pre_steps)
                        if view is not None:
                            out, folder = open_filesystem(output)
                            out.create_dir(folder, recursive=True)
                            stem, ending = posixpath.splitext(posixpath.basename(inner))
                            target = f"{folder}/{stem}-{hashlib.md5(source.encode()).hexdigest()[:8]}{ending}"
                            with out.open_output_stream(target) as written:
                                for chunk in view.chunks():
                                    written.write(chunk)
                except Exception as error:
                    facts = {"original_size": None, "was_hex": None, "decoded_size": None, "n_markers": None,
                             "cut_at": None, "status": "failed", "message": str(error), "rows": None}
                    target = None
                rows.append({"path": source, **facts, "output": target})
            yield pd.DataFrame(
                rows,
                columns=["path", "original_size", "was_hex", "decoded_size", "n_markers", "cut_at", "status",
                         "message", "output", "rows"],
            )

    # content is not selected, so the scan lists and groups the files without loading them
    return _all_files(spark, path, glob).select("path").mapInPandas(repair, MANIFEST)


def repair_manifest(manifest: DataFrame) -> DataFrame:
    """The repair log in file order."""
    return manifest.orderBy("path")


def repair_summary(manifest: DataFrame) -> DataFrame:
    """Files per status."""
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


class RepairError(ValueError):
    """No file could be repaired."""


def repair_parquet(
    spark: SparkSession,
    path: str,
    output: str,
    glob: str = "*.parquet",
    pre_steps: Sequence[Callable[[bytes], bytes]] = (),
) -> tuple[DataFrame, DataFrame]:
    """Repair, then scan what came out: (rows, manifest).

    The manifest is written beside the output first, so the files are repaired once.
    """
    manifest_path = f"{output.rstrip('/')}_manifest"
    repair_dir(spark, path, output, glob, pre_steps).write.mode("overwrite").parquet(manifest_path)
    manifest = spark.read.parquet(manifest_path)
    if manifest.filter("status = 'repaired'").isEmpty():
        raise RepairError(f"no file in {path} could be repaired")
    # by name, so that files of an earlier run in the same folder stay out
    written = manifest.filter("status = 'repaired'").select(F.element_at(F.split("output", "/"), -1).alias("_file"))
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # Spark gives it URI-encoded
    rows = spark.read.parquet(output).withColumn("_file", name)
    return rows.join(written, "_file", "semi").drop("_file"), manifest


def scan_files_for_patterns(
    spark: SparkSession,
    path: str,
    glob: str = "*.parquet",
    patterns: Sequence[str] = DEFAULT_PATTERNS,
    range_bytes: int = RANGE_BYTES,
    longest: int = LONGEST_MATCH,
) -> DataFrame:
    """Pattern matches in raw files: source_file, pattern_no, match, byte offset. Files are read in ranges."""
    return first_matches(find_files(spark, path, glob), patterns, range_bytes, longest)
