"""Fixed-width binary trace files as a Spark data source.

A file is a 16-byte header (magic, survey type, trace count) and then records
of fixed width, so a task can start at any record: big files are split by
record range, small files share a task. Nothing but the file list is looked at
while planning; each task reads its headers and its own byte ranges.
"""

from __future__ import annotations

import fnmatch
import posixpath
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# The file format.
MAGIC = b"CPETRO01"
HEADER = np.dtype([("magic", "S8"), ("survey_type_id", "<u4"), ("trace_count", "<u4")])
LAYOUT = "well_id:u4,depth_ft:f4,amplitude:f4,quality_flag:u1"
EXTENDED_LAYOUT = "well_id:u4,depth_ft:f4,amplitude:f4,frequency:f4,quality_flag:u1"

# Output types by field kind: unsigned 32-bit does not fit INT, float32 is stored as DOUBLE.
_SQL_TYPES = {"u4": "BIGINT", "u2": "INT", "u1": "INT", "i4": "INT", "f4": "DOUBLE", "f8": "DOUBLE"}
_NUMPY_TYPES = {"BIGINT": np.int64, "INT": np.int32, "DOUBLE": np.float64}

TASK_BYTES = 64 << 20
READ_BYTES = 1 << 20  # a batch is some eight times as large, with the file's name in every row


class TraceFileError(ValueError):
    """A trace file that cannot be read as asked."""


def parse_layout(text: str) -> list[tuple[str, str]]:
    """'name:kind,...' to (name, kind) pairs."""
    pairs = [tuple(part.strip().split(":")) for part in text.split(",")]
    for pair in pairs:
        if len(pair) != 2 or pair[1] not in _SQL_TYPES:
            raise ValueError(f"bad layout entry {pair!r}; kinds are {sorted(_SQL_TYPES)}")
    return pairs


def record_dtype(layout: str) -> np.dtype:
    return np.dtype([(name, f"<{kind}") for name, kind in parse_layout(layout)])


def trace_schema(layout: str) -> str:
    fields = parse_layout(layout)
    # survey_type_id comes from the header and follows the well, as in the published table
    columns = [f"{n} {_SQL_TYPES[k]}" for n, k in fields]
    at = [n for n, _ in fields].index("well_id") + 1 if "well_id" in dict(fields) else 0
    columns.insert(at, "survey_type_id BIGINT")
    return ", ".join(["trace_num BIGINT", *columns, "source_file STRING"])


HEADER_SCHEMA = (
    "path STRING, source_file STRING, length BIGINT, survey_type_id BIGINT, trace_count BIGINT, "
    "expected_length BIGINT, whole_traces BIGINT, status STRING, error STRING"
)


def open_filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or a URI (file:, hdfs:, s3: ...)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_files(path: str, glob: str) -> list[tuple[str, int]]:
    """(path, size) of matching files, by path."""
    system, inner = open_filesystem(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(inner, info.size)]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    return sorted(
        (f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(posixpath.basename(f.path), glob)
    )


@dataclass
class Header:
    survey_type_id: int
    trace_count: int
    error: str | None
    whole_traces: int


def read_header(handle, length: int, record_size: int) -> Header:
    """Check magic and size; the error text says what is wrong, and how many records are whole."""
    raw = handle.read_at(HEADER.itemsize, 0) if length >= HEADER.itemsize else b""
    if len(raw) < HEADER.itemsize:
        return Header(0, 0, f"{length} bytes hold no header", 0)
    head = np.frombuffer(raw, HEADER)[0]
    if raw[:8] != MAGIC:
        return Header(0, 0, f"not a trace file, it starts with {raw[:8]!r}", 0)
    count = int(head["trace_count"])
    expected = HEADER.itemsize + count * record_size
    whole = min(count, (length - HEADER.itemsize) // record_size)
    error = f"{length} bytes where the header announces {expected}" if length < expected else None
    return Header(int(head["survey_type_id"]), count, error, whole)


@dataclass
class TraceSlices(InputPartition):
    """Record ranges for one task: (path, file length, first record, records)."""

    slices: list = field(default_factory=list)

    def __init__(self, slices):
        self.slices = slices


def plan_slices(files: list[tuple[str, int]], record_size: int, task_bytes: int) -> list[TraceSlices]:
    """Cut big files by records and pack the pieces into tasks of about ``task_bytes``."""
    per_task = max(1, task_bytes // record_size)
    tasks, current, held = [], [], 0
    for path, length in files:
        records = max(1, (length - HEADER.itemsize) // record_size)  # a bad file still gets its check
        for first in range(0, records, per_task):
            n = min(per_task, records - first)
            if current and held + n > per_task:
                tasks.append(TraceSlices(current))
                current, held = [], 0
            current.append((path, length, first, n))
            held += n
    if current:
        tasks.append(TraceSlices(current))
    return tasks


def slice_batches(
    system: fs.FileSystem,
    path: str,
    length: int,
    first: int,
    n: int,
    layout: str,
    mode: str,
    surveys: frozenset[int] | None = None,
) -> Iterator[pa.RecordBatch]:
    """Records ``first`` to ``first + n - 1`` of one file, after a look at its header; of another survey, the header is all that is read."""
    dtype = record_dtype(layout)
    with system.open_input_file(path) as handle:
        head = read_header(handle, length, dtype.itemsize)
        if head.error and mode == "strict":
            raise TraceFileError(f"{path}: {head.error}")
        if head.error and mode == "skip":
            return
        if surveys is not None and head.survey_type_id not in surveys:
            return
        last = min(first + n, head.whole_traces)  # bytes after the announced traces are ignored
        step = max(1, READ_BYTES // dtype.itemsize)
        for start in range(first, last, step):
            count = min(step, last - start)
            raw = handle.read_at(count * dtype.itemsize, HEADER.itemsize + start * dtype.itemsize)
            yield _record_batch(np.frombuffer(raw, dtype), start, head, posixpath.basename(path), layout)


def _record_batch(records: np.ndarray, start: int, head: Header, name: str, layout: str) -> pa.RecordBatch:
    n = len(records)
    columns = {"trace_num": np.arange(start + 1, start + n + 1, dtype=np.int64)}
    for column, kind in parse_layout(layout):
        columns[column] = records[column].astype(_NUMPY_TYPES[_SQL_TYPES[kind]])
        if column == "well_id":
            columns["survey_type_id"] = np.full(n, head.survey_type_id, dtype=np.int64)
    if "survey_type_id" not in columns:
        columns = {"trace_num": columns.pop("trace_num"),
                   "survey_type_id": np.full(n, head.survey_type_id, dtype=np.int64), **columns}
    arrays = [pa.array(v) for v in columns.values()] + [pa.repeat(pa.scalar(name, pa.string()), n)]
    return pa.RecordBatch.from_arrays(arrays, names=[*columns, "source_file"])


class TraceReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.glob = options.get("glob", "*.sgx")
        self.layout = options.get("layout", LAYOUT)
        self.mode = options.get("mode", "strict")
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        if self.mode not in ("strict", "skip", "salvage"):
            raise ValueError("mode must be strict, skip or salvage")

    def partitions(self):
        files = list_files(self.path, self.glob)
        if not files:
            raise FileNotFoundError(f"nothing matches {self.glob} in {self.path}")
        return plan_slices(files, record_dtype(self.layout).itemsize, self.task_bytes)

    def read(self, partition: TraceSlices) -> Iterator[pa.RecordBatch]:
        system, _ = open_filesystem(self.path)
        for path, length, first, n in partition.slices:
            yield from slice_batches(system, path, length, first, n, self.layout, self.mode)


class HeaderReader(TraceReader):
    """One row per file from its first 16 bytes."""

    def partitions(self):
        files = list_files(self.path, self.glob)
        if not files:
            raise FileNotFoundError(f"nothing matches {self.glob} in {self.path}")
        return [TraceSlices(files[i : i + 500]) for i in range(0, len(files), 500)]

    def read(self, partition: TraceSlices):
        size = record_dtype(self.layout).itemsize
        system, _ = open_filesystem(self.path)
        for path, length in partition.slices:
            with system.open_input_file(path) as handle:
                head = read_header(handle, length, size)
            yield (
                path,
                posixpath.basename(path),
                length,
                head.survey_type_id,
                head.trace_count,
                HEADER.itemsize + head.trace_count * size,
                head.whole_traces,
                "ok" if head.error is None else "bad",
                head.error,
            )


class TraceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "traces"

    def schema(self) -> str | StructType:
        if self.options.get("view") == "headers":
            return HEADER_SCHEMA
        return trace_schema(self.options.get("layout", LAYOUT))

    def reader(self, schema: StructType) -> DataSourceReader:
        return HeaderReader(self.options) if self.options.get("view") == "headers" else TraceReader(self.options)


def _load(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(TraceSource)
    return spark.read.format("traces").options(**options).load(path)


def read_sgx(
    spark: SparkSession,
    path: str,
    glob: str = "*.sgx",
    on_error: str = "strict",
    layout: str = LAYOUT,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Traces of one file or a folder, numbered from 1 within their file.

    ``on_error``: strict fails on the first bad file, skip leaves bad files out
    (``sgx_headers`` names them), salvage keeps the whole records of a file that
    is too short.
    """
    return _load(spark, path, glob=glob, mode=on_error, layout=layout, task_bytes=str(task_bytes))


def sgx_headers(spark: SparkSession, path: str, glob: str = "*.sgx", layout: str = LAYOUT) -> DataFrame:
    """Header, sizes, status and error of every file."""
    return _load(spark, path, glob=glob, layout=layout, view="headers", mode="skip")


def sgx_errors(spark: SparkSession, path: str, glob: str = "*.sgx", layout: str = LAYOUT) -> DataFrame:
    """The files a strict read would fail on."""
    return sgx_headers(spark, path, glob, layout).filter("status <> 'ok'").select("path", "error")


def read_trace_files(
    files: DataFrame,
    layout: str = LAYOUT,
    on_error: str = "strict",
    range_bytes: int = TASK_BYTES,
    surveys: Iterable[int] | None = None,
) -> DataFrame:
    """Traces of the files that ``files`` (path, length) lists; a batch, a stream's micro-batch or a joined listing.

    Files are cut into record ranges, and the ranges are dealt to as many tasks
    as there are shuffle partitions, so one very large file is read by all of
    them. No path comes to the driver. ``on_error`` is as in ``read_sgx``. Files are
    chosen by a filter on ``files``, or with ``surveys`` by their headers.
    """
    if on_error not in ("strict", "skip", "salvage"):
        raise ValueError("on_error must be strict, skip or salvage")
    wanted = None if surveys is None else frozenset(surveys)
    record = record_dtype(layout).itemsize
    step = max(1, range_bytes // record)
    records = F.greatest(F.lit(1).cast("long"), F.floor((F.col("length") - HEADER.itemsize) / record))  # a bad file still gets its check
    first = F.explode(F.sequence(F.lit(0).cast("long"), records - 1, F.lit(step).cast("long")))
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = files.select("path", "length", first.alias("first")).repartition(tasks, "path", "first")

    def run(batches):
        for batch in batches:
            for path, length, start in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                system, inner = open_filesystem(path)
                yield from slice_batches(system, inner, length, start, step, layout, on_error, wanted)

    return ranges.mapInArrow(run, trace_schema(layout))


def check_trace_files(files: DataFrame, layout: str = LAYOUT) -> DataFrame:
    """(path, traces, error): the header's verdict on every listed file; error is null where the file is sound."""
    size = record_dtype(layout).itemsize

    def run(batches):
        for batch in batches:
            heads = []
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, inner = open_filesystem(path)
                with system.open_input_file(inner) as handle:
                    heads.append(read_header(handle, length, size))
            yield pa.record_batch(
                [batch.column(0), pa.array([h.trace_count for h in heads], pa.int64()), pa.array([h.error for h in heads], pa.string())],
                ["path", "traces", "error"],
            )

    return files.select("path", "length").mapInArrow(run, "path STRING, traces BIGINT, error STRING")


def pack_traces(survey_type_id: int, records: np.ndarray) -> bytes:
    """Bytes of one trace file; for tests and for exporting readings to the legacy format."""
    return _header(survey_type_id, len(records)) + records.tobytes()


def _header(survey_type_id: int, count: int) -> bytes:
    return np.array([(MAGIC, survey_type_id, count)], HEADER).tobytes()


def write_sgx(df: DataFrame, path: str, layout: str = LAYOUT, file_traces: int = 1_000_000) -> DataFrame:
    """Write readings as trace files, each task its own; returns (path, survey_type_id, traces) rows.

    A file holds one survey type and, but for each task's last, ``file_traces``
    traces; rows stay in the task they are in, in their order, so nothing is
    shuffled and no survey type is gathered anywhere. Names follow from the
    task's position, so a task that runs again rewrites its own files; ``path``
    should be empty before. Run the returned DataFrame once to write.
    """
    dtype = record_dtype(layout)
    names = [n for n, _ in parse_layout(layout)]
    step = max(1, READ_BYTES // dtype.itemsize)

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        system, inner = open_filesystem(path)
        system.create_dir(inner, recursive=True)
        waiting: dict[int, list[np.ndarray]] = {}
        files: dict[int, int] = {}

        def out(survey: int, records: np.ndarray) -> pa.RecordBatch:
            files[survey] = files.get(survey, 0) + 1
            target = f"{inner}/survey{survey}-{task:05d}-{files[survey]:05d}.sgx"
            with system.open_output_stream(target) as stream:
                stream.write(_header(survey, len(records)))
                for at in range(0, len(records), step):
                    stream.write(records[at : at + step].tobytes())
            return pa.RecordBatch.from_pydict({"path": [target], "survey_type_id": [survey], "traces": [len(records)]})

        for batch in batches:
            surveys = batch.column("survey_type_id").to_numpy(zero_copy_only=False)
            columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            for survey in np.unique(surveys):
                where = np.flatnonzero(surveys == survey)
                records = np.empty(len(where), dtype)
                for n in names:
                    records[n] = columns[n][where]
                held = waiting.setdefault(int(survey), [])
                held.append(records)
                if sum(map(len, held)) >= file_traces:
                    whole = np.concatenate(held)
                    cut = len(whole) // file_traces * file_traces
                    waiting[int(survey)] = [whole[cut:]]
                    for at in range(0, cut, file_traces):
                        yield out(int(survey), whole[at : at + file_traces])
        for survey, held in sorted(waiting.items()):
            if sum(map(len, held)):
                yield out(survey, np.concatenate(held))

    return df.select("survey_type_id", *names).mapInArrow(write, "path STRING, survey_type_id BIGINT, traces BIGINT")
