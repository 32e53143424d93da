"""Raw files in byte ranges: triage and pattern search for files of any size.

A file is cut into ranges and these are dealt to the tasks; nothing holds a
whole file. A range reads a little further than its end, so that a marker or a
match that begins in it is complete, and reports what begins in it only. The
facts of a file's ranges are then folded to one row. Files come as a listing
(path, length), for instance from ``find_files``, which lists them in the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspring.functions.patterns import DEFAULT_PATTERNS, bytes_as_text, extract_all
from wellspring.sources.files import find_files
from wellspring.sources.traces import open_filesystem

# The Parquet marker, its hex text, the first characters of hex text, and the share that makes a text hex.
MARKER, HEX_MARKER = b"PAR1", b"50415231"
HEX_STARTS = [b"50", b"35"]
HEX_LIMIT = 0.9

RANGE_BYTES = 16 << 20
LONGEST_MATCH = 1 << 20
BATCH_BYTES, BATCH_ROWS = 1 << 20, 1000  # of ranges handed on at once


def file_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, length, start) of all ranges of the listed files, dealt to as many tasks as there are shuffle partitions.

    Small ranges that lie within the same RANGE_BYTES of a file go together, so that a task opens it once.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)).cast("long"), F.lit(range_bytes).cast("long"))
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = files.select("path", "length", F.explode(starts).alias("start"))
    return cut.repartition(tasks, F.col("path"), F.floor(F.col("start") / RANGE_BYTES))


class _Opened:
    """The file that a task reads from: opened once for ranges that follow each other."""

    def __init__(self):
        self.path, self.handle = None, None

    def __call__(self, path: str):
        if path != self.path:
            self.close()
            system, inner = open_filesystem(path)
            self.handle, self.path = system.open_input_file(inner), path
        return self.handle

    def close(self) -> None:
        if self.handle is not None:
            self.handle.close()
        self.path, self.handle = None, None

    def __enter__(self):
        return self

    def __exit__(self, *error) -> None:
        self.close()


def read_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES, ahead: int = 0, behind: int = 0) -> DataFrame:
    """(path, start, size, before, content): each range's bytes with up to ``behind`` bytes before and ``ahead`` after it."""

    names = ["path", "start", "size", "before", "content"]
    types = [pa.string(), *[pa.int64()] * 3, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        with _Opened() as opened:
            for batch in batches:
                for path, length, start in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    size = min(range_bytes, length - start)
                    first = max(0, start - behind)
                    content = opened(path).read_at(min(length, start + size + ahead) - first, first) if length else b""
                    rows.append((path, start, size, start - first, content))
                    held += len(content)
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield out()
                        rows, held = [], 0
            if rows:
                yield out()

    return file_ranges(files, range_bytes).mapInArrow(run, "path STRING, start BIGINT, size BIGINT, before BIGINT, content BINARY")


# --- triage ----------------------------------------------------------------

_FACTS = (
    "path STRING, length BIGINT, start BIGINT, head BINARY, hex_digits BIGINT, others BIGINT, markers BIGINT, first BIGINT, last BIGINT, "
    "hex_markers ARRAY<BIGINT>, hex_first ARRAY<BIGINT>, hex_last ARRAY<BIGINT>"
)
_BLANKS, _DIGITS = b" \t\n\r\x0b\x0c", b"0123456789abcdefABCDEF"


def _facts_of(handle, length: int, start: int, range_bytes: int) -> tuple:
    """What begins in one range: markers in its bytes, and in the digits that are left without white space, by parity."""
    stop = min(length, start + range_bytes)
    own = handle.read_at(stop - start, start) if length else b""
    more = handle.read_at(min(length, stop + len(MARKER) - 1) - stop, stop) if stop < length else b""
    raw = [m.start() + start for m in re.finditer(re.escape(MARKER), own + more)]
    squeezed = own.translate(None, _BLANKS)
    digits = len(squeezed) - len(squeezed.translate(None, _DIGITS))
    # seven digits more complete a marker; white space of any length may stand between them
    tail, at = b"", stop
    while len(tail) < len(HEX_MARKER) - 1 and at < length:
        step = min(4096, length - at)
        tail += handle.read_at(step, at).translate(None, _BLANKS)
        at += step
    found: list[list[int]] = [[], []]
    for m in re.finditer(re.escape(HEX_MARKER), squeezed + tail[: len(HEX_MARKER) - 1]):
        found[m.start() & 1].append(m.start())
    return (
        own[:2],
        digits,
        len(squeezed) - digits,
        len(raw),
        raw[0] if raw else None,
        raw[-1] if raw else None,
        [len(f) for f in found],
        [f[0] if f else None for f in found],
        [f[-1] if f else None for f in found],
    )


def triage_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per file: size, hex text or not (by its whole content), markers, and what a repair would do. No size limit.

    In hex text a marker counts where it begins at a whole byte: the number of
    digits in earlier ranges tells which of a range's findings do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FACTS.split(", ")]
        longs = pa.list_(pa.int64())
        types = [pa.string(), *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 5, *[longs] * 3]
        for batch in batches:
            rows = []
            with _Opened() as opened:
                for path, length, start in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    rows.append((path, length, start, *_facts_of(opened(path), length, start, range_bytes)))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    facts = file_ranges(files, range_bytes).mapInArrow(run, _FACTS)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.withColumn("digits_before", F.coalesce(F.sum("hex_digits").over(before), F.lit(0).cast("long")))
    parity = (F.col("digits_before") % 2).cast("int")

    def byte_at(found: str):
        return ((F.col("digits_before") + F.get(found, parity)) / 2).cast("long")

    folded = facts.groupBy("path").agg(
        F.max("length").alias("original_size"),
        F.max(F.when(F.col("start") == 0, F.col("head").isin(HEX_STARTS))).alias("hex_head"),
        F.sum("hex_digits").alias("digits"),
        F.sum("others").alias("others"),
        F.sum("markers").alias("markers"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum(F.get("hex_markers", parity)).alias("hex_markers"),
        F.min(byte_at("hex_first")).alias("hex_first"),
        F.max(byte_at("hex_last")).alias("hex_last"),
    )
    was_hex = F.coalesce(F.col("hex_head") & (F.try_divide(F.col("digits"), F.col("original_size")) > HEX_LIMIT), F.lit(False))
    decodes = (F.col("others") == 0) & (F.col("digits") % 2 == 0)
    folded = folded.withColumn("was_hex", was_hex)
    chosen = folded.select(
        "path",
        "original_size",
        "was_hex",
        F.when(F.col("was_hex"), F.when(decodes, F.col("hex_markers")).otherwise(0)).otherwise(F.col("markers")).alias("n_markers"),
        F.when(F.col("was_hex"), F.col("hex_first")).otherwise(F.col("first")).alias("first_marker"),
        F.when(F.col("was_hex"), F.col("hex_last")).otherwise(F.col("last")).alias("last_marker"),
        F.when(F.col("was_hex"), (F.col("digits") / 2).cast("long")).otherwise(F.col("original_size")).alias("size"),
    )
    cut = F.when(F.col("n_markers") > 0, F.col("last_marker") + len(MARKER)).otherwise(0).cast("long")
    chosen = chosen.withColumn("cut_at", cut)
    status = (
        F.when(F.col("n_markers") == 0, "no_marker")
        .when((F.col("n_markers") > 1) & (F.col("first_marker") != 0), "marker_not_first")
        .when(F.col("n_markers") == 1, "single_marker")
        .when(F.col("was_hex") & (F.col("cut_at") < F.col("size")), "hex_and_trailing")
        .when(F.col("was_hex"), "hex")
        .when(F.col("cut_at") < F.col("size"), "trailing")
        .otherwise("whole")
    )
    return chosen.withColumn("status", status).select("path", "original_size", "was_hex", "n_markers", "cut_at", "status")


# --- patterns --------------------------------------------------------------

def scan_ranges(
    files: DataFrame,
    patterns: Sequence[str] = DEFAULT_PATTERNS,
    range_bytes: int = RANGE_BYTES,
    longest: int = LONGEST_MATCH,
    behind: int = 64,
) -> DataFrame:
    """Every match in the listed files' bytes: path, source_file, pattern_no, match, offset (in bytes).

    A match counts where it begins. One that reaches into the next range takes
    its bytes there, as in a scan from the start. ``longest`` is the longest
    match found across a range's end, ``behind`` the context that a pattern may look back at.
    """
    pieces = read_ranges(files, range_bytes, longest, behind).withColumn("_text", bytes_as_text("content"))
    columns = ["path", "start", "size", "before"]
    found = extract_all(pieces, "_text", patterns, keep=columns)
    inside = F.col("offset") - F.col("before")
    found = found.filter((inside >= 0) & (inside < F.col("size"))).select(
        "path", "start", "size", "pattern_no", "match", (F.col("start") + inside).alias("offset")
    )
    end = F.col("offset") + F.char_length("match")
    over = found.filter(end > F.col("start") + F.col("size")).groupBy(
        "path", "pattern_no", (F.col("start") + F.col("size")).alias("start")
    ).agg(F.max(end).alias("_taken"))  # at most one a range and pattern
    kept = found.join(over, ["path", "pattern_no", "start"], "left").filter(F.col("_taken").isNull() | (F.col("offset") >= F.col("_taken")))
    return kept.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), "pattern_no", "match", "offset")


def _first_from(pattern: str) -> Column:
    """A pattern whose first group is the first match of ``pattern`` that begins in a range, with the context before it."""
    # the group around it moves the numbers of back references
    moved = re.sub(r"((?<!\\)(?:\\\\)*\\)([1-9]\d*)", lambda m: f"{m[1]}{int(m[2]) + 1}", pattern)
    skipped = [F.lit(r"(?s:\A.{"), F.col("before").cast("string"), F.lit("}.{0,"), (F.col("size") - 1).cast("string"), F.lit("}?)")]
    return F.concat(*skipped, F.lit(f"({moved})"))


def first_matches(
    files: DataFrame,
    patterns: Sequence[str] = DEFAULT_PATTERNS,
    range_bytes: int = RANGE_BYTES,
    longest: int = LONGEST_MATCH,
    behind: int = 64,
) -> DataFrame:
    """First match of each pattern per listed file: source_file, pattern_no, match, offset; ``extract_patterns`` of whole files, in ranges.

    The first match is that of the first range in which one begins. The offset
    is where its text first stands in the file, so the ranges up to that one are
    searched for it. ``longest`` and ``behind`` are as in ``scan_ranges``; a file of
    one range has no such limit.
    """
    pieces = read_ranges(files, range_bytes, longest, behind).filter("size > 0").withColumn("_text", bytes_as_text("content"))
    found = []
    for i, p in enumerate(patterns):
        match = F.call_function("regexp_extract", "_text", _first_from(p), F.lit(1))
        # an empty match is none, yet nothing after it is the first
        met = F.call_function("regexp_instr", "_text", _first_from(p)) > 0 if re.search(p, "") else match != ""
        found.append(F.struct(met.alias("met"), F.lit(i).alias("pattern_no"), match.alias("match")))
    hits = pieces.select("path", "start", F.array(*found).alias("_hits"))
    hits = hits.select("path", "start", F.inline(F.filter("_hits", lambda h: h["met"])))
    first = F.min(F.struct("start", "match")).alias("first")
    hits = hits.groupBy("path", "pattern_no").agg(first).filter(F.col("first.match") != "")
    # the same text matched by two patterns counts for the first of them
    once = hits.groupBy("path", F.col("first.match").alias("match")).agg(F.min("pattern_no").alias("pattern_no"), F.min("first.start").alias("upto"))
    wanted = once.groupBy("path").agg(F.collect_list(F.struct("pattern_no", "match", "upto")).alias("wanted"))
    places = file_ranges(files, range_bytes).join(wanted, "path").select("path", "length", "start", "wanted")
    places = places.filter(F.exists("wanted", lambda w: w["upto"] >= F.col("start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, length, start, sought in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                system, inner = open_filesystem(path)
                stop = min(length, start + range_bytes)
                ahead = max(len(w["match"]) for w in sought) - 1
                with system.open_input_file(inner) as handle:
                    content = handle.read_at(min(length, stop + ahead) - start, start)
                for w in sought:
                    text = w["match"].encode("latin-1")
                    at = content.find(text, 0, stop - start + len(text) - 1) if w["upto"] >= start else -1
                    if at >= 0:
                        rows.append((path, w["pattern_no"], w["match"], start + at))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["path", "pattern_no", "match", "offset"])

    placed = places.mapInArrow(run, "path STRING, pattern_no INT, match STRING, offset BIGINT")
    placed = placed.groupBy("path", "pattern_no", "match").agg(F.min("offset").cast("int").alias("offset"))
    return placed.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "pattern_no", "match", "offset")


def triage_files(spark: SparkSession, path: str, glob: str = "*.parquet", range_bytes: int = RANGE_BYTES) -> DataFrame:
    return triage_ranges(find_files(spark, path, glob), range_bytes)


def scan_files(
    spark: SparkSession, path: str, glob: str = "*", patterns: Sequence[str] = DEFAULT_PATTERNS, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    return scan_ranges(find_files(spark, path, glob), patterns, range_bytes)
