"""Operator 12: whitening of embeddings by an incremental eigendecomposition.

1. Each task keeps the spectrum (eigenvalues and eigenvectors) of the scatter of the vectors it has seen.  A vector is a
   rank-one update with its difference to the mean so far: the new eigenvalues are the roots of a secular equation, after
   deflation of directions that the update does not touch and of equal eigenvalues.  Copies in a batch are one weighted update.
2. Spectra of tasks are combined in groups of ``FAN``, level by level, by rank-one updates with the eigenvectors of one and
   with the difference of the means.
3. A distributed Rayleigh-Ritz step projects all vectors on the combined basis (made orthonormal), sums their covariance
   there, and its eigenvectors give the components to double precision.

Every table between the steps has rows of d * d numbers, one a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common

COMPONENTS = 8
#: Spectra or sums that a task combines.
FAN = 16
SCALE, SHIFT = 1024, 100_000
#: Rows that numpy temporaries are made for at once.
_ROWS = 1 << 13
_EPS = np.finfo(float).eps
#: Entries beyond this saturate, as a 64-bit number would.
_MOST = 1 << 61


def roots(poles: np.ndarray, weights: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(weights / (poles - x)), one above each of the ascending poles.

    Also the matrix of poles minus roots, in which small differences keep their digits.  Each root is sought from its nearest
    pole by rational interpolation, inside a bracket that shrinks with every step.
    """
    k = len(poles)
    upper = np.append(poles[1:], poles[-1] + rho * weights.sum() * (1 + 8 * _EPS))
    gap = upper - poles
    with np.errstate(all="ignore"):
        middle = 1 + (rho * weights[:, None] / (poles[:, None] - poles - gap / 2)).sum(0)
        right = middle < 0
        origin = poles.copy()
        from_next = right & (np.arange(k) < k - 1)
        origin[from_next] = upper[from_next]
        apart = poles[:, None] - origin
        near, far = poles - origin, upper - origin
        low = np.where(from_next, -gap / 2, np.where(right, gap / 2, 0))
        high = np.where(from_next, 0, np.where(right, gap, gap / 2))
        below = np.tri(k, dtype=bool).T  # poles up to the root's own, by column
        x, left = (low + high) / 2, np.arange(k)
        for _ in range(60):
            delta = apart[:, left] - x[left]
            term = rho * weights[:, None] / delta
            f = 1 + term.sum(0)
            going = np.abs(f) > 2 * _EPS * k * (1 + np.abs(term).sum(0))
            if not going.any():
                break
            left, f, term, delta = left[going], f[going], term[:, going], delta[:, going]
            at = x[left]
            low[left], high[left] = np.where(f < 0, at, low[left]), np.where(f < 0, high[left], at)
            slope = term / delta
            slopes, before = slope.sum(0), (slope * below[:, left]).sum(0)
            d0, d1 = near[left] - at, far[left] - at
            a = (d0 + d1) * f - d0 * d1 * slopes
            b = d0 * d1 * f
            c = f - d0 * before - d1 * (slopes - before)
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            step = at + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            x[left] = np.where((step > low[left]) & (step < high[left]), step, (low[left] + high[left]) / 2)
        return origin + x, apart - x


class Spectrum:
    """Number, mean and scatter of the vectors seen; the scatter as ascending eigenvalues and eigenvectors."""

    def __init__(self, d: int):
        self.n, self.mean = 0, np.zeros(d)
        self.values, self.vectors = np.zeros(d), np.eye(d)

    def update(self, rho: float, v: np.ndarray) -> None:
        """Add ``rho`` times the outer product of v with itself."""
        z = v @ self.vectors
        length = float(np.sqrt(z @ z))
        if rho <= 0 or length == 0:
            return
        z, rho = z / length, rho * length * length
        tolerance = 8 * _EPS * max(float(self.values[-1]), rho)
        touched = np.flatnonzero(rho * np.abs(z) > tolerance)
        if not len(touched):
            return
        # equal eigenvalues: turn their eigenvectors so that the update meets one of them
        groups = np.split(touched, np.flatnonzero(np.diff(self.values[touched]) > tolerance) + 1)
        for g in groups:
            if len(g) > 1:
                w = z[g].copy()
                w[-1] += np.copysign(np.sqrt(w @ w), w[-1])
                w /= np.sqrt(w @ w)
                self.vectors[:, g] -= 2 * np.outer(self.vectors[:, g] @ w, w)
                z[g] -= 2 * w * (w @ z[g])
        own = np.array([g[-1] for g in groups])
        poles, z = self.values[own], z[own]
        values, delta = roots(poles, z * z, rho)
        # weights for which these roots are exact, so that the eigenvectors are orthogonal
        ratio = poles[:, None] - poles
        np.fill_diagonal(ratio, -rho)
        weight = np.copysign(np.sqrt(np.abs(np.prod(delta / ratio, axis=1))), z)
        turned = weight[:, None] / delta
        turned /= np.sqrt((turned * turned).sum(0))
        self.vectors[:, own] = self.vectors[:, own] @ turned
        self.values[own] = np.maximum(values, 0)
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], np.ascontiguousarray(self.vectors[:, order])

    def add(self, x: np.ndarray, times: int) -> None:
        """See a vector ``times`` times."""
        difference = x - self.mean
        self.update(self.n * times / (self.n + times), difference)
        self.n += times
        self.mean += difference * (times / self.n)

    def join(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.update(float(value), vector)
        difference = other.mean - self.mean
        self.update(self.n * other.n / (self.n + other.n), difference)
        self.mean = self.mean + difference * (other.n / (self.n + other.n))
        self.n += other.n


@dataclass
class Whitening:
    """What whitens a vector: ``n`` and exact sums of the fit list, components by falling eigenvalue, and all variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n for s in self.sums], float) / self.n
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)**2, exact."""
        most = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if most * most * max(len(self.sums), 1) < 1 << 63:
            return pa.array(((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1)).cast(pa.decimal128(38, 0))
        bound = 0
        if most < 1 << 62:
            off = self.n * x - np.array(self.sums, np.int64)
            bound = int(np.abs(off).max(initial=0)) ** 2 * max(len(self.sums), 1)
            if bound < 1 << 63:
                return pa.array((off**2).sum(1)).cast(pa.decimal128(38, 0))
        exact = [sum((self.n * int(a) - s) ** 2 for a, s in zip(row, self.sums, strict=True)) for row in x]
        return pa.array([Decimal(e) if e < 10**38 else None for e in exact], pa.decimal128(38, 0))


def _integers(column: pa.Array, d: int) -> np.ndarray:
    """floor(1024 * c) + 100000 of the entries; what a shorter vector lacks counts as 0."""
    sizes = column.value_lengths().to_numpy()
    c = column.flatten().cast(pa.float64()).to_numpy()
    scaled = np.clip(np.floor(c * SCALE), -_MOST, _MOST).astype(np.int64)
    out = np.full((len(sizes), d), 0, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = scaled
    return out + SHIFT


def _pieces(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    common.forget()
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            some = batch.slice(lo, _ROWS)
            yield some, _integers(some.column("vector"), d)


_STATE = "part long, n long, sums array<long>, first binary, second binary"


def _state(part: int, n: int, sums: list[int], first: np.ndarray, second: np.ndarray) -> dict:
    values = {"part": [part], "n": [n], "sums": [sums], "first": [first.astype("<f8").tobytes()], "second": [second.astype("<f8").tobytes()]}
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
    return {c: pa.array(v, k) for (c, v), k in zip(values.items(), kinds, strict=True)}


def _spectra(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sums = Spectrum(d), [0] * d
        for _, x in _pieces(batches, d):
            sums = [a + b for a, b in zip(sums, x.sum(0).tolist(), strict=True)]
            distinct, times = np.unique(x, axis=0, return_counts=True)
            for v, k in zip((distinct - SHIFT).astype(float), times.tolist(), strict=True):
                seen.add(v, k)
        if seen.n:
            yield common.batch_of(_state(TaskContext.get().partitionId(), seen.n, sums, np.concatenate([seen.mean, seen.values]), seen.vectors))

    return run


def _spectrum(row: dict, d: int) -> Spectrum:
    out, first = Spectrum(d), np.frombuffer(row["first"], "<f8")
    out.n, out.mean, out.values = row["n"], first[:d].copy(), first[d:].copy()
    out.vectors = np.frombuffer(row["second"], "<f8").reshape(d, d).copy()
    return out


def _joined_spectra(d: int) -> Callable[[list[dict]], tuple]:
    def run(rows: list[dict]) -> tuple:
        whole = _spectrum(rows[0], d)
        for row in rows[1:]:
            whole.join(_spectrum(row, d))
        return np.concatenate([whole.mean, whole.values]), whole.vectors

    return run


def _covariances(project: Callable[[np.ndarray], np.ndarray], d: int, k: int):
    """Number, mean and scatter of projected vectors, centred before multiplying."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = 0, np.zeros(k), np.zeros((k, k))
        for _, x in _pieces(batches, d):
            y = project(x)
            n, mean, scatter = _met((n, mean, scatter), (len(y), y.mean(0), (y - y.mean(0)).T @ (y - y.mean(0))))
        if n:
            yield common.batch_of(_state(TaskContext.get().partitionId(), n, [], mean, scatter))

    return run


def _met(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _joined_covariances(k: int) -> Callable[[list[dict]], tuple]:
    def run(rows: list[dict]) -> tuple:
        parts = [(r["n"], np.frombuffer(r["first"], "<f8"), np.frombuffer(r["second"], "<f8").reshape(k, k)) for r in rows]
        whole = parts[0]
        for part in parts[1:]:
            whole = _met(whole, part)
        return whole[1], whole[2]

    return run


def _folded(states: DataFrame, join: Callable[[list[dict]], tuple], stage: common.Stage, name: str) -> dict:
    """One row of all states, combined ``FAN`` at a time."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        first, second = join(rows)
        sums = [sum(x) for x in zip(*(r["sums"] for r in rows), strict=True)]
        return pa.table(_state(rows[0]["part"] // FAN, sum(r["n"] for r in rows), sums, first, second))

    level, states = 0, stage.save(states, f"{name}-0")
    while (most := states.agg(F.max("part")).head()[0]) and most > 0:
        level += 1
        group = (F.col("part") / FAN).cast("long").alias("group")
        states = stage.save(states.groupBy(group).applyInArrow(run, _STATE), f"{name}-{level}")
    return states.head().asDict()


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector`` of rows whose vector is there and has finite entries only."""
    kept = common.keyed(embeddings, "vec_id", "embedding").withColumnRenamed("embedding", "vector")
    odd = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return kept.where(F.col("vector").isNotNull() & ~F.coalesce(odd, F.lit(False)))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vector`` by its first ``components`` components; None without rows or entries.

    Components whose eigenvalue is not above rounding (as of equal vectors) can't be scaled to variance 1 and are left out.
    """
    spark = common.shipped(vectors.sparkSession)
    stage, vectors = common.Stage(spark), vectors.select("vector")
    d = vectors.agg(F.max(F.size("vector"))).head()[0] or 0
    if not d:
        return None
    seen = _folded(vectors.mapInArrow(_spectra(d), _STATE), _joined_spectra(d), stage, "spectra")
    basis, _ = np.linalg.qr(_spectrum(seen, d).vectors[:, ::-1])
    plain = Whitening(seen["n"], list(seen["sums"]), np.ones(d), basis, 0.0)
    ritz = _folded(vectors.mapInArrow(_covariances(plain.whitened, d, d), _STATE), _joined_covariances(d), stage, "ritz")
    values, turns = np.linalg.eigh(np.frombuffer(ritz["second"], "<f8").reshape(d, d) / seen["n"])
    values, turns = values[::-1], turns[:, ::-1]
    trace = float(values.sum())
    kept = int((values[:components] > 16 * d * _EPS * max(trace, _EPS)).sum())
    return Whitening(seen["n"], plain.sums, values[:kept], basis @ turns[:, :kept], trace)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    d, k = len(model.sums), len(model.values)
    if not k:
        return 0.0
    stage = common.Stage(vectors.sparkSession)
    seen = _folded(vectors.select("vector").mapInArrow(_covariances(model.whitened, d, k), _STATE), _joined_covariances(k), stage, "identity")
    return float(np.abs(np.frombuffer(seen["second"], "<f8").reshape(k, k) / seen["n"] - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error`` for each usable row and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped; rows may share a ``vec_id`` or have none, each
    is a row of its own.  A vector shorter than the longest counts as 0 in what it lacks.  Without usable rows, or where all
    vectors are equal, there is no component and so no row.  A deviation of 10**38 and more is null.  Other columns are not read.
    """
    vectors = usable(embeddings)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(vectors, components)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    d, k, error = len(model.sums), len(model.values), identity_error(vectors, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _pieces(batches, d):
            n = len(x)
            row = pa.array(np.repeat(np.arange(n), k))
            yield common.batch_of({
                "vec_id": some.column("vec_id").cast(pa.int64()).take(row), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), n), "n": np.full(n * k, model.n),
                "deviation": model.deviation(x).take(row), "whitened": model.whitened(x).ravel(),
                "explained": np.tile(model.values / model.trace, n), "identity_error": np.full(n * k, error),
            })

    return vectors.mapInArrow(run, schema)
