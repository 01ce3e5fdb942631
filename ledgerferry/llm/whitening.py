"""Whitening of embeddings by principal components that FEAST contour integration finds.

Entries become whole numbers. Three passes over the table give, in this order: exact sums; the
covariance, centred before multiplying; and, with the components, the whitened rows and their
covariance. Every task adds up its rows, the tasks' matrices are added row by row, so nothing but
matrices of the vectors' dimension leaves the tasks.

The covariance matrix is solved on the driver. Inertia counts (signs of the pivots of the shifted
matrix, after one reduction to three diagonals) place intervals of the real axis, with their ends in
gaps, that hold a few eigenvalues each. For each, a circle through its ends is integrated by
Gauss-Legendre quadrature of complex shifted solves; this filters a block of vectors down to the
interval's eigenvectors, which a Rayleigh-Ritz step extracts. The block is filtered again until the
residuals are at rounding level. An interval's eigenvalues have to be as many as its inertia count
says, or its block grows. A last Rayleigh-Ritz step over all intervals makes the components orthogonal.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; a null id
stays an id; repeated rows count each; vectors of different dimensions are fitted dimension by
dimension; an entry beyond 2^62 after scaling counts as that; a deviation beyond 64 bits is null; there
are no more components than the covariance has eigenvalues above RANK times its trace, so none for
one vector, for equal vectors or for empty ones; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.common import tidy

COMPONENTS = 32
SCALE, OFFSET, HUGE = 64, 1_000_000, 1 << 62
#: Eigenvalues up to this part of the trace are taken as zero.
RANK = 1e-12
#: Quadrature points on the upper half of the circle, eigenvalues of one interval, filter steps.
NODES, INSIDE, STEPS = 8, 12, 40
SLICE = 4_096
LIMB = 31


def whole(values: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 as 64-bit numbers."""
    return np.clip(np.floor(values * SCALE), -HUGE, HUGE).astype(np.int64) + OFFSET


def vectors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(dimension, ids, whole numbers) of the rows that take part, a matrix of few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            column = part.column(1)
            numbers = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become nan
            sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            begins = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
            bad = np.append(0, np.cumsum(~np.isfinite(numbers)))
            fine = (sizes > 0) & (bad[begins + np.maximum(sizes, 0)] == bad[begins])
            for dim in np.unique(sizes[fine]).tolist():
                rows = np.flatnonzero(fine & (sizes == dim))
                with np.errstate(over="ignore"):
                    x = whole(numbers[begins[rows][:, None] + np.arange(dim)])
                yield dim, part.column(0).take(pa.array(rows)), x


def _added(df: DataFrame, per_task: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """Matrices by dimension, added up over all tasks row by row."""
    names = ["dim", "i", "row"]

    def emit(found: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        dims, rows = zip(*found, strict=True) if found else ((), ())
        values = [v.astype("<f8").tobytes() for v in found.values()]
        return pa.record_batch([pa.array(dims, pa.int32()), pa.array(rows, pa.int32()), pa.array(values, pa.binary())], names)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, matrix in per_task(batches):
            total[dim] = total[dim] + matrix if dim in total else matrix
        for dim, matrix in total.items():
            yield emit({(dim, i): row for i, row in enumerate(matrix)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, i, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[dim, i] = total.get((dim, i), 0.0) + np.frombuffer(row, "<f8")
        yield emit(total)

    kind = "dim int, i int, row binary"
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in df.mapInArrow(tidy(one), kind).repartition("dim", "i").mapInArrow(add, kind).collect():
        out.setdefault(r["dim"], {})[r["i"]] = np.frombuffer(r["row"], "<f8")
    return {dim: np.array([rows[i] for i in sorted(rows)]) for dim, rows in out.items()}


def sums(df: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By dimension: the number of vectors and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for dim, _, x in vectors_of(batches):
            # High and low parts are summed apart, so that nothing passes 64 bits.
            found[dim] = found.get(dim, 0) + np.array([np.full(dim, len(x)), (x >> LIMB).sum(axis=0), (x & ((1 << LIMB) - 1)).sum(axis=0)])
        for dim, (n, high, low) in found.items():
            yield pa.record_batch([pa.array(c, pa.int64()) for c in ([dim] * dim, range(dim), n, high, low)], ["dim", "i", "n", "high", "low"])

    parts = df.mapInArrow(tidy(run), "dim long, i long, n long, high long, low long")
    total = parts.groupBy("dim", "i").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in total.orderBy("dim", "i").collect():
        out.setdefault(r["dim"], (int(r["n"]), []))[1].append((int(r["high"]) << LIMB) + int(r["low"]))
    return out


@dataclass
class Fit:
    """Sums of one dimension, and its components once they are known."""

    n: int
    total: list[int]
    basis: np.ndarray | None = None  # dimension x components, divided by the roots of the eigenvalues
    explained: np.ndarray | None = None

    def __post_init__(self) -> None:
        parts = [divmod(s, self.n) for s in self.total]
        self.low = np.array([q for q, _ in parts], np.int64)
        self.rest = np.array([r / self.n for _, r in parts])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from an exact difference of whole numbers."""
        with np.errstate(over="ignore"):
            near = x - self.low
        far = (x < 0) != (self.low < 0)
        if far.any():  # only numbers of opposite sign can pass 64 bits
            return np.where(far, x.astype(float) - self.low, near) - self.rest
        return near - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
        largest = float(np.abs(self.centred(x)).max(initial=0.0)) + 1.0
        if len(self.total) * (self.n * largest) ** 2 < 2.0**62:
            rest = np.array([s % self.n for s in self.total], np.int64)
            return (((x - self.low) * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.total, strict=True)) for row in x.tolist())
        return [d if d < 1 << 63 else None for d in exact]


def three_diagonals(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Householder's reduction of a symmetric matrix: its diagonal and the one beside it."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        length = np.linalg.norm(x)
        if length == 0.0:
            continue
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k:]
        rest -= 2.0 * np.outer(v, v @ rest)
        rest = a[k:, k + 1 :]
        rest -= 2.0 * np.outer(rest @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Of each shift: how many eigenvalues lie below, counted as negative pivots."""
    tiny = np.finfo(float).tiny ** 0.5
    count, pivot = np.zeros(len(shifts), np.int64), np.ones(len(shifts))
    for k in range(len(diagonal)):
        pivot = diagonal[k] - shifts - (beside[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def intervals(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down to the wanted number, with ends in gaps."""
    n = len(diagonal)
    reach = np.append(0.0, np.abs(beside)) + np.append(np.abs(beside), 0.0)
    bottom, top = float((diagonal - reach).min()), float((diagonal + reach).max())
    span = max(top - bottom, 1e-3 * max(abs(top), abs(bottom)), np.finfo(float).tiny)
    bottom, top = bottom - 0.01 * span, top + 0.01 * span
    # Rough places of all eigenvalues, by halving with inertia counts; from the largest down.
    low, high = np.full(n, bottom), np.full(n, top)
    rank = np.arange(n)[::-1]
    for _ in range(34):
        middle = (low + high) / 2
        above = inertia(diagonal, beside, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    place = (low + high) / 2
    gap = np.append(place[:-1] - place[1:], np.inf)
    ends, start = [], 0
    while start < wanted:
        stop = min(start + INSIDE, n)
        first = max(start + 1, min(stop, wanted) - INSIDE // 2)
        pick = first + int(np.argmax(gap[first - 1 : stop]))
        while gap[pick - 1] < 1e-7 * span and pick < n:  # a close group stays together
            pick += 1
        ends.append(pick)
        start = pick
    edges = [top, *((place[e - 1] + place[e]) / 2 if e < n else bottom for e in ends)]
    counts = inertia(diagonal, beside, np.array(edges))
    return [(edges[k + 1], edges[k], int(counts[k] - counts[k + 1])) for k in range(len(ends))]


def feast(a: np.ndarray, low: float, high: float, inside: int) -> np.ndarray:
    """The eigenvectors to eigenvalues between low and high, `inside` of them."""
    n = len(a)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi * (1 - points) / 2
    shift = centre + radius * np.exp(1j * angle)
    factor = radius * weights / 2 * np.exp(1j * angle) / 2
    solvers = [np.linalg.inv(z * np.eye(n) - a) for z in shift]
    size, scale = min(n, max(inside + 4, inside * 3 // 2)), max(np.abs(a).max(), np.finfo(float).tiny)
    while True:
        block = np.random.default_rng(1).standard_normal((n, size))
        best, found = np.inf, 0
        for _ in range(STEPS):
            block = sum(2 * (f * (s @ block)).real for f, s in zip(factor, solvers, strict=True))
            q, _ = np.linalg.qr(block)
            value, vector = np.linalg.eigh(q.T @ a @ q)
            block = q @ vector
            kept = (value > low) & (value < high)
            found = int(kept.sum())
            worst = np.linalg.norm(a @ block[:, kept] - block[:, kept] * value[kept], axis=0).max(initial=0.0)
            if found == inside and (worst <= 1e-15 * scale or worst > best / 2 and worst <= 1e-12 * scale):
                return block[:, kept]
            best = min(best, worst)
        if size == n:
            raise ArithmeticError(f"{found} eigenvalues found where the inertia counts {inside}")
        size = min(n, size * 2)


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    n, trace = len(a), float(np.trace(a))
    if not n or trace <= 0:
        return np.zeros(0), np.zeros((n, 0))
    unit = a / trace
    parts = [feast(unit, *i) for i in intervals(*three_diagonals(unit), min(wanted, n)) if i[2]]
    q, _ = np.linalg.qr(np.hstack(parts))
    value, vector = np.linalg.eigh(q.T @ unit @ q)
    order = np.argsort(-value, kind="stable")[:wanted]
    order = order[value[order] > RANK]
    return value[order] * trace, (q @ vector)[:, order]


def fit(df: DataFrame, wanted: int = COMPONENTS) -> dict[int, Fit]:
    """Sums, covariance and components of each dimension."""
    fits = {dim: Fit(n, total) for dim, (n, total) in sums(df).items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for dim, _, x in vectors_of(batches):
            c = fits[dim].centred(x)
            yield dim, c.T @ c

    for dim, matrix in _added(df, products).items():
        covariance = (matrix + matrix.T) / (2 * fits[dim].n)
        value, vector = components(covariance, wanted)
        fits[dim].basis = vector / np.sqrt(value)
        fits[dim].explained = value / np.trace(covariance) if len(value) else value
    return fits


def identity_error(df: DataFrame, fits: dict[int, Fit]) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for dim, _, x in vectors_of(batches):
            w = fits[dim].centred(x) @ fits[dim].basis
            if w.shape[1]:
                yield dim, w.T @ w

    found = _added(df, products)
    return max((float(np.abs(m / fits[dim].n - np.eye(len(m))).max()) for dim, m in found.items()), default=0.0)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """Each vector's whitened components, one row for each: id, component, n, deviation, whitened, explained, identity_error."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fits = fit(rows, wanted)
    error = identity_error(rows, fits)
    kind = df.schema[id_col].dataType.simpleString()
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, x in vectors_of(batches):
            f = fits[dim]
            whitened = f.centred(x) @ f.basis
            rows, many = whitened.shape
            if not many:
                continue
            row = pa.array(np.repeat(np.arange(rows), many))
            yield pa.record_batch(
                [
                    ids.take(row),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * many, f.n, np.int64)),
                    pa.array(f.deviation(x), pa.int64()).take(row),
                    pa.array(whitened.reshape(-1)),
                    pa.array(np.tile(f.explained, rows)),
                    pa.array(np.full(rows * many, error)),
                ],
                names,
            )

    return rows.mapInArrow(tidy(run), f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
