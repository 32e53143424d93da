"""Whitening of embeddings by spectrum slicing.

Three passes over the vectors sum up on the executors: per-dimension sums, the
centred second moments, and later the covariance of the whitened values. What
comes to the driver is one number per pair of dimensions, whatever the number of
rows.

There, LDLt factors of the shifted covariance V - s tell by the signs of their
pivots how many eigenvalues lie above s. Bisection with these counts isolates
each leading eigenvalue, Rayleigh quotient iteration inside its interval
converges cubically, and two more counts close around the result certify its
number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**52  # entries beyond it stand for it, so that every x and difference is an exact double
LEAST_SHARE = 1e-13  # of the trace; a smaller eigenvalue is rounding, not a direction
CHUNK_ROWS = 8192


# --- inertia ---------------------------------------------------------------

def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: positive pivots of LDLt with 1x1 and 2x2 pivots."""
    a = matrix - shift * np.eye(len(matrix))
    tiny = np.finfo(float).eps * max(float(np.abs(a).max(initial=0.0)), np.finfo(float).tiny)
    wide = (1 + 17**0.5) / 8  # bounds the growth of entries
    above = 0
    while len(a):
        below = np.abs(a[1:, 0])
        largest = float(below.max(initial=0.0))
        if abs(a[0, 0]) < wide * largest:
            r = 1 + int(below.argmax())
            off = np.abs(a[r])
            off[r] = 0.0
            if abs(a[0, 0]) * off.max() < wide * largest**2:
                if abs(a[r, r]) >= wide * off.max():
                    swap = np.arange(len(a))
                    swap[[0, r]] = r, 0
                    a = a[np.ix_(swap, swap)]
                else:
                    swap = np.arange(len(a))
                    swap[[1, r]] = swap[[r, 1]]
                    a = a[np.ix_(swap, swap)]
                    pivot, column = a[:2, :2], a[2:, :2]
                    above += 1  # such a pivot has one eigenvalue of each sign
                    a = a[2:, 2:] - column @ np.linalg.solve(pivot, column.T)
                    continue
        pivot = a[0, 0] if abs(a[0, 0]) > tiny else -tiny  # an eigenvalue at the shift is not above it
        above += pivot > 0
        column = a[1:, 0]
        a = a[1:, 1:] - np.outer(column, column / pivot)
    return int(above)


@dataclass
class Spectrum:
    values: np.ndarray  # leading eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    counts: int  # factorisations made


def leading_eigenpairs(matrix: np.ndarray, wanted: int = COMPONENTS) -> Spectrum:
    """The largest eigenvalues of a covariance and their vectors; those of a rank beyond the matrix's own are left out."""
    d = len(matrix)
    trace = float(np.trace(matrix)) if d else 0.0
    if not d or not trace > 0:
        return Spectrum(np.zeros(0), np.zeros((d, 0)), 0)
    unit = matrix / trace  # eigenvalues between 0 and 1
    floor = LEAST_SHARE
    known: dict[float, int] = {}

    def above(s: float) -> int:
        if s not in known:
            known[s] = count_above(unit, s)
        return known[s]

    top = float(np.abs(unit).sum(axis=1).max())
    known[top * (1 + 1e-12) + 1e-300] = 0
    found = min(wanted, above(floor))
    values, vectors = [], np.zeros((d, 0))
    resolution = 4 * np.finfo(float).eps
    for k in range(1, found + 1):
        rng = np.random.default_rng(k)
        while True:
            low = max(s for s, c in known.items() if c >= k)
            high = min(s for s, c in known.items() if c < k)
            alone = known[low] == k and known[high] == k - 1
            # equal eigenvalues cannot be told apart: their interval shrinks to the resolution
            if not alone and high - low > resolution * max(high, floor):
                middle = (low + high) / 2
                if not low < middle < high:
                    break
                above(middle)
                continue
            pair = _rayleigh(unit, low, high, vectors, rng)
            if pair is not None and _certified(above, pair[0], k, d):
                break
            if high - low <= resolution * max(high, floor):
                break
            above((low + high) / 2)
        if pair is None:
            pair = _inverse(unit, (low + high) / 2, vectors, rng)
        values.append(pair[0])
        vectors = np.column_stack([vectors, pair[1]])
    return Spectrum(np.array(values) * trace, vectors, len(known) - 1)


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    eye = np.eye(len(matrix))
    for nudge in (0.0, 1e-16, 1e-15, 1e-14):
        try:
            y = np.linalg.solve(matrix - (shift + nudge) * eye, x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    return x


def _clear(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - found @ (found.T @ x)
    return x / max(float(np.linalg.norm(x)), np.finfo(float).tiny)


def _inverse(matrix: np.ndarray, shift: float, found: np.ndarray, rng: np.random.Generator, steps: int = 3) -> tuple[float, np.ndarray]:
    x = _clear(rng.standard_normal(len(matrix)), found)
    for _ in range(steps):
        x = _clear(_solve(matrix, shift, x), found)
    return float(x @ matrix @ x), x


def _rayleigh(
    matrix: np.ndarray, low: float, high: float, found: np.ndarray, rng: np.random.Generator
) -> tuple[float, np.ndarray] | None:
    """The eigenpair inside (low, high), or None where the quotient leaves the interval."""
    value, x = _inverse(matrix, (low + high) / 2, found, rng, 2)
    for _ in range(12):
        if not low <= value <= high:
            return None
        if float(np.linalg.norm(matrix @ x - value * x)) <= 8 * np.finfo(float).eps:
            break
        x = _clear(_solve(matrix, value, x), found)
        value = float(x @ matrix @ x)
    return (value, x) if low <= value <= high else None


def _certified(above, value: float, k: int, d: int) -> bool:
    margin = 64 * d * np.finfo(float).eps
    return above(value - margin) >= k and above(value + margin) < k


# --- passes over the vectors -----------------------------------------------

def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & ~bad)


def _matrices(batches: Iterator[pa.RecordBatch], width: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, x) per chunk of rows: x = floor(1024 * c) + 100000 as whole doubles, short vectors filled with c = 0."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            column = part.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            cells = column.flatten().to_numpy(zero_copy_only=False)
            wide = int(sizes.max(initial=0)) if width is None else width
            out = np.full((part.num_rows, wide), float(SHIFT))
            rows = np.repeat(np.arange(part.num_rows), sizes)
            places = np.arange(len(cells)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out[rows, places] = np.clip(np.floor(SCALE * cells), -LARGEST, LARGEST) + SHIFT
            yield part.column(0), out


def _sum_pass(batches):
    """(dim, total): per-dimension sums; dim -1 holds the row count."""
    n, totals = 0, np.zeros(0, object)
    for _, x in _matrices(batches):
        part = x.astype(np.int64).sum(axis=0).astype(object)
        # where an earlier chunk was narrower, its rows stand at SHIFT in the dimensions it lacked
        wide = max(len(part), len(totals))
        part = np.concatenate([part, np.full(wide - len(part), SHIFT * len(x), object)])
        totals = np.concatenate([totals, np.full(wide - len(totals), SHIFT * n, object)]) + part
        n += len(x)
    moved = [int(t) - SHIFT * n for t in totals]  # a task that never saw a dimension adds nothing to it
    yield pa.record_batch(
        [pa.array([-1, *range(len(moved))], pa.int32()), pa.array([n, *moved], pa.int64())], ["dim", "total"]
    )


def _moment_pass(centre: np.ndarray):
    """(cell, value): sums of products of whole numbers near the centred values, upper triangle."""

    def run(batches):
        d = len(centre)
        total = np.zeros((d, d))
        for _, x in _matrices(batches, d):
            y = x - centre
            total += y.T @ y
        at = np.flatnonzero(np.triu(np.ones((d, d), bool)))
        yield pa.record_batch([pa.array(at.astype(np.int64)), pa.array(total.reshape(-1)[at])], ["cell", "value"])

    return run


def _white_moment_pass(mean: np.ndarray, project: np.ndarray):
    def run(batches):
        k = project.shape[1]
        moment, total = np.zeros((k, k)), np.zeros(k)
        for _, x in _matrices(batches, len(mean)):
            w = (x - mean) @ project
            moment += w.T @ w
            total += w.sum(axis=0)
        values = np.concatenate([moment.reshape(-1), total])
        yield pa.record_batch([pa.array(np.arange(len(values))), pa.array(values)], ["cell", "value"])

    return run


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sums of (n * x - S)^2; null where a sum is beyond a long."""
    apart = n * x - sums.astype(float)
    about = (apart * apart).sum(axis=1)
    if float(about.max(initial=0.0)) < 2.0**62:
        exact = n * x.astype(np.int64) - sums
        return pa.array((exact * exact).sum(axis=1))
    out = []
    for row in x:
        value = sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True))
        out.append(value if value < 2**63 else None)
    return pa.array(out, pa.int64())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _white_pass(n: int, sums: np.ndarray, mean: np.ndarray, project: np.ndarray, explained: np.ndarray, error: float):
    def run(batches):
        k = project.shape[1]
        for ids, x in _matrices(batches, len(mean)):
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.record_batch(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    _deviations(x, n, sums).take(pa.array(each)),
                    pa.array(((x - mean) @ project).reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [f.split()[0] for f in _OUT.split(", ")],
            )

    return run


@dataclass
class Whitening:
    """A fitted whitening: the spectrum, and ``apply`` for the rows."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    covariance: np.ndarray
    spectrum: Spectrum
    rows: DataFrame

    @property
    def project(self) -> np.ndarray:
        return self.spectrum.vectors / np.sqrt(self.spectrum.values)

    def identity_error(self) -> float:
        """Largest absolute entry of the whitened values' covariance minus the identity, measured over all rows."""
        k = len(self.spectrum.values)
        if not k:
            return 0.0
        sums = self.rows.mapInArrow(_white_moment_pass(self.mean, self.project), "cell long, value double")
        cells = sums.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        flat = np.zeros(k * k + k)
        flat[cells["cell"].to_numpy()] = cells["value"].to_numpy()
        centre = flat[k * k :] / self.n
        return float(np.abs(flat[: k * k].reshape(k, k) / self.n - np.outer(centre, centre) - np.eye(k)).max())

    def apply(self) -> DataFrame:
        explained = self.spectrum.values / np.trace(self.covariance) if len(self.covariance) else np.zeros(0)
        run = _white_pass(self.n, self.sums, self.mean, self.project, explained, self.identity_error())
        return self.rows.mapInArrow(run, _OUT)


def fit_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on all usable rows of ``vectors``. The driver holds one covariance: 8 bytes for each pair of dimensions."""
    rows = _usable(vectors, id_col, vector_col)
    sums = rows.mapInArrow(_sum_pass, "dim int, total long").groupBy("dim").agg(F.sum("total").alias("total")).toArrow()
    by_dim = dict(zip(sums["dim"].to_pylist(), sums["total"].to_pylist(), strict=True))
    n, d = by_dim.get(-1, 0), len(by_dim) - (-1 in by_dim)
    total = np.array([by_dim[i] + SHIFT * n for i in range(d)], np.int64)
    if not n or not d:
        return Whitening(n, total, np.zeros(d), np.zeros((d, d)), Spectrum(np.zeros(0), np.zeros((d, 0)), 0), rows)
    # Centred by the nearest whole number, so that products are exact; the rest of the centre is taken off the sums.
    centre = np.array([(2 * int(t) + n) // (2 * n) for t in total], np.int64)
    rest = np.array([(int(t) - int(c) * n) / n for t, c in zip(total, centre, strict=True)])
    cells = rows.mapInArrow(_moment_pass(centre.astype(float)), "cell long, value double")
    cells = cells.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    moment = np.zeros(d * d)
    moment[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    moment = moment.reshape(d, d)
    moment = moment + np.triu(moment, 1).T
    covariance = moment / n - np.outer(rest, rest)
    return Whitening(n, total, centre + rest, covariance, leading_eigenpairs(covariance, components), rows)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or hold null or non-finite entries take no part. The
    other ones enter as x = floor(1024 * c) + 100000; entries beyond 2**52 / 1024 count
    as that. Where lengths differ, shorter vectors (empty ones too) count as
    filled up with zeros. Components are numbered by falling eigenvalue; fewer
    come out where the covariance has a lower rank (one row, or only equal rows:
    none). Equal eigenvalues share their space: any orthonormal basis of it may
    come. Repeated rows, repeated and null ids each give their rows; ``deviation``
    is null beyond a long. Other columns are not read, whatever their names. An
    empty table gives no rows.
    """
    return fit_whitening(vectors, id_col, vector_col, components).apply()
