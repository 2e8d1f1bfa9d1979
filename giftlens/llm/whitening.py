"""Embedding whitening by FEAST contour integration.

Spark sums the vectors' first and second moments in whole numbers, so the
covariance is exact however rows are dealt out.  Its eigenpairs are found on the
driver, whose work is bounded by the vectors' length: inertia counts (signs of the
pivots of the shifted tridiagonal form) cut the upper spectrum into intervals with
known numbers of eigenvalues; for each, quadrature of (zI - V)^-1 Y along a circle
through the interval's ends projects a block onto its eigenvectors, Rayleigh-Ritz
extracts them, and the counts verify that none is missed.  Rows are projected in
Spark, and the covariance of the result is measured over all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import read
from giftlens.llm.vectors import matrix, usable


@dataclass(frozen=True)
class WhiteningParams:
    """``components``: most components; ``scale``, ``shift``: a vector's whole numbers
    are floor(scale * c) + shift; ``interval``: eigenvalues to a contour, about;
    ``nodes``: quadrature points on its upper half; ``floor``: components whose share
    of the trace is smaller are rounding and can't be whitened."""

    components: int = 32
    scale: int = 64
    shift: int = 1_000_000
    interval: int = 8
    nodes: int = 8
    floor: float = 1e-12
    seed: int = 12


# ---- eigenpairs ----------------------------------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar matrix (Householder)."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        to = -np.copysign(size, x[0])
        x[0] -= to
        x /= np.linalg.norm(x)
        p = a[k + 1:, k + 1:] @ x
        w = p - (x @ p) * x
        a[k + 1:, k + 1:] -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = to
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """Numbers of eigenvalues above shifts, from the pivots of T - s I = L D L'."""

    def __init__(self, v: np.ndarray):
        self.diagonal, self.off = tridiagonal(v)
        reach = np.zeros(len(v))
        reach[:-1] += np.abs(self.off)
        reach[1:] += np.abs(self.off)
        self.low = float((self.diagonal - reach).min())
        self.high = float((self.diagonal + reach).max())
        self.size = max(abs(self.low), abs(self.high), np.finfo(float).tiny)

    def above(self, s: float) -> int:
        count, q = 0, 1.0
        for d, e in zip(self.diagonal, np.concatenate(([0.0], self.off))):
            q = d - s - e * e / q
            if q == 0:
                q = np.finfo(float).tiny ** 0.5
            count += q > 0
        return count

    def gap(self, k: int) -> tuple[float, float]:
        """(lower, upper) of the gap below the k-th largest eigenvalue."""
        margin = 1e-9 * self.size

        def edge(holds):
            lo, hi = self.low - margin, self.high + margin
            for _ in range(80):
                mid = (lo + hi) / 2
                if holds(self.above(mid)):
                    lo = mid
                else:
                    hi = mid
            return lo, hi
        return edge(lambda n: n > k)[1], edge(lambda n: n >= k)[0]


def contour(v: np.ndarray, low: float, high: float, want: int, nodes: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` eigenpairs with eigenvalues between ``low`` and ``high``."""
    d = len(v)
    middle, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - x)
    scale = np.abs(v).sum(axis=1).max()
    size = 0
    while size < d:
        size = min(d, max(2 * size, 2 * want, want + 4))
        q = rng.standard_normal((d, size))
        for _ in range(60):
            y, q = q, np.zeros((d, size))
            for a, b in zip(angle, w):
                turn = radius * np.exp(1j * a)
                q += b / 2 * (turn * np.linalg.solve((middle + turn) * np.eye(d) - v, y)).real
            q = np.linalg.qr(q)[0]
            e, small = np.linalg.eigh(q.T @ v @ q)                    # Rayleigh-Ritz
            q = q @ small
            own = (e > low) & (e < high)
            rest = np.linalg.norm(v @ q[:, own] - q[:, own] * e[own], axis=0)
            if own.sum() == want and (rest <= 1e-12 * scale).all():
                return e[own], q[:, own]
    raise ArithmeticError(f"{want} eigenvalues between {low} and {high} were counted, others found")


def principal(v: np.ndarray, p: WhiteningParams = WhiteningParams()) -> tuple[np.ndarray, np.ndarray]:
    """``(e, q)``: the largest eigenvalues that are no rounding, falling, at most
    ``components``, and their unit eigenvectors as columns."""
    d, trace = len(v), float(np.trace(v))
    if d == 0 or not trace > 0:
        return np.zeros(0), np.zeros((d, 0))
    if d == 1:
        return np.array([v[0, 0]]), np.ones((1, 1))
    inertia, rng = Inertia(v), np.random.default_rng(p.seed)
    want = min(p.components, inertia.above(p.floor * trace))
    top, found, parts = inertia.high + 1e-6 * inertia.size, 0, []
    while found < want:
        k = min(found + p.interval, want)
        while k < d:                                                # equal eigenvalues stay together
            low, up = inertia.gap(k)
            if up - low > 1e-11 * inertia.size:
                break
            k += 1
        cut = (low + up) / 2 if k < d else inertia.low - 1e-6 * inertia.size
        k = inertia.above(cut)
        parts.append(contour(v, cut, top, k - found, p.nodes, rng)[1])
        found, top = k, cut
    q = np.linalg.qr(np.hstack(parts))[0]
    e, small = np.linalg.eigh(q.T @ v @ q)
    falling = np.argsort(-e)[:want]
    return e[falling], (q @ small)[:, falling]


# ---- sums over all rows --------------------------------------------------------------------

def _sums(rows: DataFrame, of: Callable, kind: str) -> dict:
    """{cell: sum} over all rows: ``of`` gives a batch's sums, each task adds up its own,
    Spark the tasks'.  Cells are as many as the vectors' length squared, at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = of(b.column(1))
                total = x if total is None else total + x
        if total is not None:
            t = pa.float64() if kind == "double" else pa.decimal128(38, 0)
            values = total.tolist() if kind == "double" else [Decimal(int(x)) for x in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int64()), pa.array(values, t)], names=["cell", "value"])

    out = rows.mapInArrow(run, f"cell long, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    return {r.cell: r.value for r in out.collect()}


def _exact(x: np.ndarray, square: bool) -> np.ndarray:
    """Column sums, or sums of column products, as Python numbers where a long or a
    double can't hold them exactly."""
    most = float(np.abs(x).max(initial=0))
    if not square:
        return (x if most * len(x) < 2**62 else x.astype(object)).sum(axis=0).astype(object)
    if most * most * len(x) < 2**53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).ravel().astype(object)
    x = x.astype(object)
    return (x.T @ x).ravel()


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` vectors of ``size`` entries with sums ``total``; ``values`` and
    ``vectors`` are the covariance's principal eigenpairs, ``trace`` its trace."""

    n: int
    size: int
    total: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    params: WhiteningParams

    def whole(self, column: pa.Array) -> np.ndarray:
        """A batch's vectors as whole numbers less the rounded-down mean."""
        return _whole(column, self.size, self.params) - self._floor()

    def _floor(self) -> np.ndarray:
        return np.array([s // self.n for s in self.total], np.int64)

    def project(self, u: np.ndarray) -> np.ndarray:
        rest = np.array([(s % self.n) / self.n for s in self.total])
        return (u - rest) @ (self.vectors / np.sqrt(self.values))


def _whole(column: pa.Array, size: int, p: WhiteningParams) -> np.ndarray:
    return np.floor(p.scale * matrix(column, size)).astype(np.int64) + p.shift


def _rows(embeddings: DataFrame, p: WhiteningParams) -> tuple[DataFrame, int]:
    rows, size = usable(embeddings)
    fits = F.forall("embedding", lambda x: F.abs(x * p.scale) < float(2**62))
    return rows.where(fits), size


def fit(embeddings: DataFrame, p: WhiteningParams = WhiteningParams()) -> Whitening:
    """The whitening of all usable vectors."""
    rows, size = _rows(embeddings, p)
    none = Whitening(0, size, (), np.zeros(0), np.zeros((size, 0)), 0.0, p)
    if not size:
        return none

    def first(c):
        x = _whole(c, size, p)
        return np.concatenate(([len(x)], _exact(x, False))).astype(object)

    one = _sums(rows, first, "decimal(38,0)")
    if not one:
        return none
    n, total = int(one[0]), tuple(int(one[i + 1]) for i in range(size))
    w = Whitening(n, size, total, np.zeros(0), np.zeros((size, 0)), 0.0, p)
    two = _sums(rows, lambda c: _exact(w.whole(c), True), "decimal(38,0)")
    rest = [s % n for s in total]
    # Centred by whole numbers near the mean, then by what is left of it, exactly.
    v = np.array([[(n * int(two[i * size + j]) - rest[i] * rest[j]) / (n * n) for j in range(size)] for i in range(size)])
    values, vectors = principal(v, p)
    return Whitening(n, size, total, values, vectors, float(np.trace(v)), p)


def identity_error(embeddings: DataFrame, w: Whitening) -> float | None:
    """The largest entry of |covariance of the whitened vectors - identity|."""
    k = len(w.values)
    if not k:
        return None

    def moments(c):
        y = w.project(w.whole(c))
        return np.concatenate((y.sum(axis=0), (y.T @ y).ravel()))

    got = _sums(_rows(embeddings, w.params)[0], moments, "double")
    mean = np.array([got[i] for i in range(k)]) / w.n
    second = np.array([got[k + i] for i in range(k * k)]).reshape(k, k) / w.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, w: Whitening | None = None, p: WhiteningParams = WhiteningParams()) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: for each
    usable row as many rows as the fit has components.

    Left out: null or empty vectors, null and non-finite entries, vectors of another
    length than most, and entries whose whole number is no long.  Null ids and repeated
    rows are rows like others.  ``deviation`` is null where no long holds it.  Directions
    without variance can't be whitened and are no components: equal vectors, or a single
    one, and empty tables give no rows.  Other columns are ignored.
    """
    w = fit(embeddings, p) if w is None else w
    error = identity_error(embeddings, w)
    rows = _rows(embeddings, w.params)[0]
    k = len(w.values)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    share = w.values / w.trace
    rest = np.array([s % w.n for s in w.total], np.int64)

    def deviations(u: np.ndarray) -> list:
        most = int(np.abs(u).max(initial=0)) + 1
        if (most * w.n) ** 2 * w.size < 2**62:
            return ((w.n * u - rest) ** 2).sum(axis=1).tolist()
        big = ((w.n * u.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [x if x < 2**63 else None for x in big]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2_000):
                part = b.slice(at, 2_000)
                m, u = part.num_rows, w.whole(part.column(1))
                pick = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pick), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, w.n, np.int64)), pa.array(deviations(u), pa.int64()).take(pick),
                     pa.array(w.project(u).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
