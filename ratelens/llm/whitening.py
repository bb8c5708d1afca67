"""Whitening of embeddings on their first principal components, found by FEAST.

Components of a vector become whole numbers ``x = floor(64 c) + 1000000``.  The
fit list holds every distinct vector once; Spark sums it, and then the products
of its centred vectors, as partial sums per task joined by a tree.  The matrix
that is left has the dimension's size, whatever the number of rows; it is bound
to ``max_dim`` and solved where the partial sums end.

FEAST: for an eigenvalue interval, a quadrature along a circle around it of
solves with the shifted matrix projects a random block onto the interval's
eigenvectors; Rayleigh-Ritz extracts them, repeatedly until the residuals
vanish.  The inertia of the shifted matrix, brought to tridiagonal form (signs
of its pivots, Sylvester's law), tells how many eigenvalues lie above a shift:
it sets the intervals, which end in gaps, and proves that none was missed.

Defined results for odd rows: rows whose vector is null, empty, or holds a null
or non-finite entry are dropped, and so are vectors with an entry beyond 2^52
after scaling, and those of another length than most rows have (the smaller
length on a tie); repeated rows are returned again, but fitted once; rows with
a null id stay; components whose eigenvalue is zero within the arithmetic are
not returned, so one distinct vector gives no rows; only the id and the vector
are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .vectors import blob_batch, sum_blobs

OFFSET, SCALE = 1_000_000, 64.0
_LARGEST = float(1 << 52)
_OUT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double")
_LOW = np.int64((1 << 24) - 1)


@dataclass(frozen=True)
class Whitening:
    components: int = 16
    per_interval: int = 8     # eigenvalues looked for at once
    nodes: int = 8            # of the quadrature on the upper half circle
    rounds: int = 40          # of projection, at most
    max_dim: int = 4096
    seed: int = 12


# ---- the matrix: inertia and FEAST


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of a tridiagonal matrix with the eigenvalues
    of ``a``, by reflections of one column after the other."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += size if v[0] >= 0 else -size
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, side: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    out = (pivot > 0).astype(np.int64)
    for d, e in zip(diagonal[1:], side * side):
        pivot = np.where(np.abs(pivot) < tiny, tiny, pivot)
        pivot = d - shifts - e / pivot
        out += pivot > 0
    return out


def _bracketed(diagonal: np.ndarray, side: np.ndarray, top: float) -> np.ndarray:
    """Every eigenvalue between 0 and ``top``, falling, by bisection on the inertia."""
    k = np.arange(1, len(diagonal) + 1)
    low, high = np.zeros(len(k)), np.full(len(k), top)
    for _ in range(70):
        mid = (low + high) / 2
        many = inertia(diagonal, side, mid) >= k
        low, high = np.where(many, mid, low), np.where(many, high, mid)
    return low


def feast(a: np.ndarray, low: float, high: float, many: int, s: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` eigenvalues between ``low`` and ``high`` and their vectors."""
    d = len(a)
    rng = np.random.default_rng(s.seed)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, weight = np.polynomial.legendre.leggauss(s.nodes)
    angle = np.pi / 2 * (x + 1)
    points, weight = centre + radius * np.exp(1j * angle), weight / 2
    width = min(d, max(many + 4, 3 * many // 2))
    y = rng.standard_normal((d, width))
    size = np.linalg.norm(a, 2)
    last = np.inf
    for turn in range(s.rounds):
        q = np.zeros_like(y)
        for z, w, t in zip(points, weight, angle):
            q += (w * radius * np.exp(1j * t) * np.linalg.solve(z * np.eye(d) - a, y)).real
        q = np.linalg.qr(q)[0]
        values, ritz = np.linalg.eigh(q.T @ a @ q)
        y = q @ ritz
        inside = (values > low) & (values < high)
        if inside.sum() == many:
            off = np.linalg.norm(a @ y[:, inside] - y[:, inside] * values[inside], axis=0).max()
            if off <= 4e-16 * size or off >= last / 2 and off <= 1e-13 * d ** 0.5 * size:
                return values[inside], y[:, inside]
            last = off
        elif turn % 8 == 7:  # too small a block for what lies just outside
            y = np.hstack([y, rng.standard_normal((d, min(d - y.shape[1], many)))])
    raise RuntimeError(f"found {int(inside.sum())} of {many} eigenvalues between {low} and {high}")


def leading(a: np.ndarray, s: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors
    as rows; zero ones (within the arithmetic) are left out."""
    d = len(a)
    top = float(np.abs(a).sum(axis=1).max())
    if top == 0:
        return np.zeros(0), np.zeros((0, d))
    diagonal, side = tridiagonal(a)
    near = _bracketed(diagonal, side, 1.01 * top)
    floor = top * d * 1e-14
    wanted = min(s.components, int((near > floor).sum()))
    ends = np.append(near, 0.0)
    values, vectors, have, high = [], [], 0, 1.1 * near[0]
    while have < wanted:
        low, many = _interval(ends, have, floor, s)
        # the bounds lie in gaps: what lies between them is known, and must be found
        above = inertia(diagonal, side, np.array([low, high]))
        e, v = feast(a, low, high, int(above[0] - above[1]), s)
        values.append(e)
        vectors.append(v)
        high, have = low, have + many
    # intervals apart, vectors are orthogonal; one last Rayleigh-Ritz over all of them
    q, _ = np.linalg.qr(np.hstack(vectors))
    e, ritz = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-e)[:wanted]
    v = (q @ ritz)[:, order].T
    sign = np.sign(v[np.arange(len(v)), np.argmax(np.abs(v), axis=1)])
    return e[order], v * sign[:, None]


def _interval(near: np.ndarray, have: int, floor: float, s: Whitening) -> tuple[float, int]:
    """Lower bound of the interval that begins after ``have`` eigenvalues, and
    how many it holds: it ends in the widest gap on offer, within one power of
    ten, but never among eigenvalues too close to tell apart."""
    best, at = -1.0, have + 1
    for k in range(have + 1, len(near)):
        gap = (near[k - 1] - near[k]) / near[k - 1]
        if gap > best:
            best, at = gap, k
        if best > 1e-5 and (k - have >= s.per_interval or near[k] < near[have] / 10):
            break
        if near[k] <= floor:
            break
    return (near[at - 1] + near[at]) / 2, at - have


# ---- the rows


def _matrix(column: pa.Array) -> np.ndarray:
    """Numbers of a binary column of whole numbers, 1000000 less, in 16, 32 or 64 bits."""
    blobs = column.to_pylist()
    out = None
    for width in {b[0] for b in blobs}:
        at = [i for i, b in enumerate(blobs) if b[0] == width]
        own = np.frombuffer(b"".join(blobs[i][1:] for i in at), f"<i{width}").reshape(len(at), -1)
        out = np.zeros((len(blobs), own.shape[1]), np.int64) if out is None else out
        out[at] = own
    return np.zeros((0, 0), np.int64) if out is None else out


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, dim, x``: rows that take part, their whole numbers (less the
    offset) as bytes: equal vectors are equal bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            sizes = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False)
            ids = b.column("vec_id")
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at, keep, blobs = 0, [], []
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(flat * SCALE)
                good = np.abs(whole) <= _LARGEST  # false for nulls and non-finite entries
            for i, size in enumerate(sizes.tolist()):
                own = slice(at, at + size)
                at += size
                if size and good[own].all():
                    x = whole[own].astype(np.int64)
                    most = max(abs(int(x.min())), abs(int(x.max())))
                    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
                    keep.append(i)
                    blobs.append(bytes([width]) + x.astype(f"<i{width}").tobytes())
            yield pa.record_batch({
                "vec_id": ids.take(pa.array(keep, pa.int64())),
                "dim": pa.array(sizes[keep].astype(np.int32)), "x": pa.array(blobs, pa.binary())})

    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(vec_col).cast("array<double>").alias("v"))
            .mapInArrow(run, "vec_id long, dim int, x binary"))


def _sums(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int, dtype: str) -> np.ndarray:
    """Sum over all rows of what ``of`` gives for a batch of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size, dtype)
        for b in batches:
            if b.num_rows:
                total += of(_matrix(b.column("x")))
        yield blob_batch(TaskContext.get().partitionId(), total)

    out = sum_blobs(rows.select("x").mapInArrow(run, "part long, blob binary"), dtype)
    return np.zeros(size, dtype) if out is None else out


@dataclass(frozen=True)
class Model:
    """What the fit list gives: its size, exact sums of the numbers (less the
    offset), eigenvalues and unit vectors, and two figures about them."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` with one rounding: the mean's whole part goes first."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return (x - np.array(whole, np.int64)).astype(np.float64) - np.array(rest)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Sum over dimensions of ``(n x - S) ** 2``, exact at any size."""
        whole = [s // self.n for s in self.sums]
        rest = [s - w * self.n for s, w in zip(self.sums, whole)]
        y = x - np.array(whole, np.int64)
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 1 << 62:
            t = y * self.n - np.array(rest, np.int64)
            return [Decimal(v) for v in (t * t).sum(axis=1).tolist()]
        return [Decimal(sum((v * self.n - r) ** 2 for v, r in zip(row, rest))) for row in y.tolist()]


def fit(distinct: DataFrame, dim: int, s: Whitening = Whitening()) -> Model | None:
    """The model of a stored table of distinct vectors ``x``."""
    if dim > s.max_dim:
        raise ValueError(f"vectors of {dim} entries; at most {s.max_dim}")
    # sums of high and low parts, so that no partial sum overflows
    parts = _sums(distinct, lambda x: np.concatenate([(x >> 24).sum(0), (x & _LOW).sum(0), [len(x)]]),
                  2 * dim + 1, "int64").tolist()
    n = parts[-1]
    if not n:
        return None
    sums = [(hi << 24) + lo for hi, lo in zip(parts[:dim], parts[dim:2 * dim])]
    model = Model(n, sums, np.zeros(0), np.zeros((0, dim)), 0.0, 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = model.centred(x)
        return (y.T @ y).ravel()

    v = _sums(distinct, products, dim * dim, "float64").reshape(dim, dim) / n
    values, vectors = leading((v + v.T) / 2, s)
    model = Model(n, sums, values, vectors, float(np.trace(v)), 0.0)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    m = _sums(distinct, moments, k + k * k, "float64") / n
    # the mean is a rounding error, so taking its square off afterwards loses nothing
    off = m[k:].reshape(k, k) - np.outer(m[:k], m[:k]) - np.eye(k)
    return Model(n, sums, values, vectors, model.trace, float(np.abs(off).max(initial=0.0)))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           s: Whitening = Whitening()) -> DataFrame:
    """One row for every vector that takes part and every component: ``vec_id,
    component, n, deviation, whitened, explained, identity_error``."""
    rows = materialize(whole_vectors(vectors, id_col, vec_col), "whole-vectors")
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], _OUT)
    rows = rows.where(F.col("dim") == common["dim"])
    model = fit(materialize(rows.select("x").distinct(), "distinct-vectors"), common["dim"], s)
    shared = spark.sparkContext.broadcast(
        (model.n, model.sums, model.values, model.vectors, model.trace, model.identity_error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        k = len(own.values)
        for b in batches:
            many = b.num_rows
            if not many or not k:
                continue
            x = _matrix(b.column("x"))
            w = own.whitened(x)
            of = np.repeat(np.arange(many), k)
            yield pa.record_batch({
                "vec_id": b.column("vec_id").take(pa.array(of)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                "n": pa.array(np.full(many * k, own.n)),
                "deviation": pa.array(own.deviations(x), pa.decimal128(38, 0)).take(pa.array(of)),
                "whitened": pa.array(w.ravel()),
                "explained": pa.array(np.tile(own.values / own.trace, many)),
                "identity_error": pa.array(np.full(many * k, own.identity_error))})

    return rows.select("vec_id", "x").mapInArrow(project, _OUT)
