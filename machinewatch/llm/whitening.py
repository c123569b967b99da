"""Embedding whitening by QDWH spectral divide-and-conquer.

The covariance of the distinct integer vectors is split by spectral
projectors: the polar factor U of V - sI has eigenvalue 1 above the shift s
and -1 below it, so (U + I) / 2 projects on the invariant subspace of the
larger eigenvalues. U comes from the QR-based dynamically weighted Halley
iteration; both subspaces are split again, the upper one first, until every
component asked for stands alone. The whitening matrix then goes to the tasks.

Job shape: vectors are made distinct by one shuffle with map-side combine and
written, as two passes read them. Each task sums its own vectors (numpy) and
sends one row per dimension, or one matrix; Spark adds these up. The driver
holds matrices of the dimension, never vectors.

Defined results: a vector that is null or empty, or has a null or non-finite
entry, or one whose integer does not fit 53 bits, is dropped; of vectors of
several lengths only the most frequent length stays (of equally frequent ones
the longest). Repeated vectors are fitted once, and every row of them is
returned. A component without variance has ``whitened`` and ``explained`` 0
and takes no part in ``identity_error``. Equal eigenvalues give any orthonormal
basis of their subspace. A component's entry of largest size is positive. A
``deviation`` beyond the range of a long is null. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machinewatch.llm.common import written

#: Components returned per vector.
COMPONENTS = 16
#: x = floor(64 * c) + 1,000,000.
SCALE, SHIFT = 64, 1_000_000
#: Integers up to here are exact doubles.
EXACT = 1 << 53
EPS = float(np.finfo(float).eps)


# --- QDWH on one symmetric matrix ---------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix (its matrix sign function)."""
    n = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return np.eye(n)
    x = a / size
    r = np.linalg.qr(x, mode="r")
    # A lower bound of the smallest singular value; a singular matrix counts as just regular.
    low = EPS
    if np.abs(np.diag(r)).min() > EPS:
        low = min(1.0, max(EPS, 1.0 / np.linalg.norm(np.linalg.solve(r, np.eye(n)))))
    for _ in range(60):
        ratio = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + ratio)
        alpha = root + np.sqrt(max(0.0, 8 - 4 * ratio + 8 * (2 - low * low) / (low * low * root))) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, np.eye(n)]))
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        step, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (alpha + beta * low * low) / (1 + gamma * low * low))
        if step < np.cbrt(EPS) and 1 - low < 10 * EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal basis of a projector's range."""
    q, _ = np.linalg.qr(projector @ rng.standard_normal((len(projector), rank)))
    return np.linalg.qr(projector @ q)[0]


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if all eigenvalues are equal."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= n * EPS * scale:
        return None
    best = None
    # The mean has eigenvalues on both sides; other shifts serve where it meets an eigenvalue.
    for off in (0.0, 0.11, -0.11, 0.29, -0.29, 0.53, -0.53, 0.83, -0.83):
        projector = (polar_factor(a - (mean + off * spread) * np.eye(n)) + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        upper, lower = _basis(projector, rank, rng), _basis(np.eye(n) - projector, n - rank, rng)
        leak = np.linalg.norm(upper.T @ a @ lower) + scale * np.linalg.norm(upper.T @ lower)
        if best is None or leak < best[0]:
            best = leak, upper, lower
        if leak <= 10 * n * EPS * scale:
            break
    return best and best[1:]


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) and their unit eigenvectors (columns)."""
    n, scale, rng = len(v), float(np.linalg.norm(v)), np.random.default_rng(0)
    found: list[np.ndarray] = []
    stack = [np.eye(n)]
    while stack and sum(q.shape[1] for q in found) < k:
        q = stack.pop()
        parts = _split(q.T @ v @ q, scale, rng) if q.shape[1] > 1 else None
        if parts is None:
            found.append(q)
        else:
            # A basis is made orthonormal again after each product, so errors do not add up.
            stack += [np.linalg.qr(q @ parts[1])[0], np.linalg.qr(q @ parts[0])[0]]
    z = np.linalg.qr(np.hstack([np.eye(n)[:, :0], *found]))[0][:, :k]
    values = np.einsum("ij,ij->j", z, v @ z)
    order = np.argsort(-values, kind="stable")
    z = z[:, order]
    z = z * np.where(z[np.abs(z).argmax(axis=0), np.arange(z.shape[1])] < 0, -1.0, 1.0)
    return values[order], z


# --- sums over the tasks' vectors ---------------------------------------------------------------

def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(column))
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that stay; ``x`` is an array of longs."""
    vector = F.col(vector_col)
    scaled = F.transform(vector, lambda e: F.floor(e.cast("double") * SCALE))
    sound = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda e: F.coalesce(
        F.abs(e.cast("double") * SCALE) < EXACT // 2, F.lit(False)) & ~F.isnan(e.cast("double")))
    rows = embeddings.where(F.coalesce(sound, F.lit(False))).select(F.col(id_col).alias("vec_id"), scaled.alias("scaled"))
    size = rows.groupBy(F.size("scaled").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("scaled") == F.lit(size["d"] if size else 0)).select(
        "vec_id", F.transform("scaled", lambda e: e + F.lit(SHIFT).cast("long")).alias("x"))


@dataclass(frozen=True)
class Moments:
    """Rows and exact sums per dimension; vectors are centred as (x - base) - rest without loss."""

    n: int
    sums: np.ndarray

    @property
    def base(self) -> np.ndarray:
        return np.array([int(s) // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(int(s) % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.rest


def moments(fit: DataFrame) -> Moments | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if len(batch):
                x = _matrix(batch, "x")
                n, sums = n + len(x), x.sum(axis=0) + (0 if sums is None else sums)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()),
                                              pa.array(sums, pa.int64())], names=["i", "n", "s"])

    rows = fit.select("x").mapInArrow(run, "i int, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum(
        "s").alias("s")).orderBy("i").collect()
    return Moments(rows[0]["n"], np.array([r["s"] for r in rows], dtype=np.int64)) if rows else None


def covariance(fit: DataFrame, at: Moments, weights: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the centred vectors, or of their products with ``weights``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                y = at.centred(_matrix(batch, "x"))
                y = y if weights is None else y @ weights
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             names=["i", "j", "s"])

    entries = fit.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    size = len(at.sums) if weights is None else weights.shape[1]
    out = np.zeros((size, size))
    for r in entries:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / at.n
    return out


@dataclass(frozen=True)
class Whitening:
    """What the tasks need: centring, one column per component, shares and the measured error."""

    at: Moments
    weights: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit_whitening(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct ``x`` of ``vectors``; None without any."""
    fit = written(vectors.select("x").distinct(), "whitening-fit")
    at = moments(fit)
    if at is None:
        return None
    v = covariance(fit, at)
    values, z = components(v, min(k, len(v)))
    trace = float(np.trace(v))
    # Beyond rounding; a smaller eigenvalue is none.
    live = values > len(v) * EPS * max(trace, 0.0)
    weights = np.where(live, z / np.sqrt(np.where(live, values, 1.0)), 0.0)
    explained = np.where(live, values / (trace or 1.0), 0.0)
    error = np.abs((covariance(fit, at, weights) - np.eye(len(values)))[np.ix_(live, live)])
    return Whitening(at, weights, explained, float(error.max()) if error.size else 0.0)


def _deviations(x: np.ndarray, at: Moments) -> list[int | None]:
    """Exact sum of (n * x - S) ** 2 per row; null beyond a long."""
    off = [int(s) - at.n * int(b) for s, b in zip(at.sums, at.base, strict=True)]
    y = x - at.base
    rough = ((float(at.n) * y - np.array(off, dtype=float)) ** 2).sum(axis=1)
    safe = rough < 2.0 ** 62
    exact = np.zeros(len(x), dtype=np.int64)
    exact[safe] = ((at.n * y[safe] - np.array(off, dtype=np.int64)) ** 2).sum(axis=1)
    out: list[int | None] = exact.tolist()
    for r in np.flatnonzero(~safe):
        total = sum((at.n * int(e) - o) ** 2 for e, o in zip(y[r], off, strict=True))
        out[r] = total if total < 1 << 63 else None
    return out


def whiten(embeddings: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component."""
    vectors = integer_vectors(embeddings, id_col, vector_col)
    fitted = fit_whitening(vectors, k)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    ddl = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return _none(embeddings.sparkSession, ddl)
    model = embeddings.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        size = w.weights.shape[1]
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch, "x")
            rows = np.repeat(np.arange(len(x)), size)
            deviations = pa.array(_deviations(x, w.at), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), w.at.n)), deviations.take(pa.array(rows)),
                pa.array((w.at.centred(x) @ w.weights).ravel()), pa.array(np.tile(w.explained, len(x))),
                pa.array(np.full(len(rows), w.identity_error))], names=names)

    names = [f.rsplit(" ", 1)[0] for f in ddl.split(", ")]
    return vectors.mapInArrow(run, ddl)


def _none(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)
