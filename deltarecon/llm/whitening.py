"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(``SCALE`` * entry) + ``OFFSET``; the covariance V of
their vectors (divisor n) is never formed. A pass multiplies it with a few vectors Q:
every task adds up its part of the centred XᵀXQ, Spark adds up the tasks' parts by
dimension, and dims times columns numbers reach the driver. Each round applies a
Chebyshev polynomial of V to a block of vectors, by its three-term recurrence, one
pass a degree. The polynomial is small on the unwanted part of the spectrum, from a
lower bound (a short Lanczos run less its residual) to the block's least Ritz value,
and grows fast above. QR and Rayleigh-Ritz follow; leading vectors with a residual of
at most ``LOCK`` are locked and projected out of every step of the recurrence. The
degree is such that the largest unlocked value isn't amplified over ``MAX_AMPLIFIED``
times more than the least wanted one, so that QR can still tell them apart. At the
end one more pass over all vectors found settles them together, and another one
certifies: the covariance of the whitened vectors.

The vectors are written once, as blocks of whole numbers, to the shared folder, and
the passes read these. Sums are exact (longs), and every vector is centred by
(n * x - sum) / n before it is multiplied. Work a pass is rows times dims times
columns; nothing grows with the rows on the driver.

Cases: null vectors, vectors with null or non-finite entries, and vectors of another
length than the most frequent one (of ties the greater) are left out; an empty table,
or one without a vector left, gives no rows; repeated rows and ids stand for
themselves; equal eigenvalues have any orthogonal vectors of their space; components
without variance (as of one row, or of constant vectors) have a null ``whitened``;
with fewer dimensions than components there are as many as dimensions; a deviation
beyond a long is null (``deviation_exact`` has it); other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltarecon.session import materialize_to, remove_path, scratch_path

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
BLOCK = 32  # vectors in the filtered block
DEGREE = 12
LANCZOS_STEPS = 10
MAX_AMPLIFIED = 1e8
TOLERANCE = 1e-13  # of residuals, in parts of the largest eigenvalue
LOCK = 1e-11
WORST = 1e-10  # a run that ends above this fails
MAX_ROUNDS = 60
BLOCK_BYTES = 4 << 20
SEED = 11


@dataclass(frozen=True)
class Whitening:
    """``vectors`` (dims x components), ``values`` by falling size, and what was measured."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: whether a row's vector is whole and finite, its length, and the
    whole numbers of all entries of the rows that are, end to end."""
    entries = column.flatten()  # without those of null rows
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False),
                       column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), -1)
    row = np.repeat(np.arange(len(column)), np.maximum(lengths, 0))
    values = entries.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(column)) > 0
    good = (lengths > 0) & ~bad
    x = np.floor(values[good[row]] * SCALE).astype(np.int64) + OFFSET
    return good, lengths, x


def _as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors of one length: their number, sums by dimension, and bytes."""
    for b in batches:
        good, lengths, x = whole_numbers(b.column(0))
        of_row = np.repeat(lengths[good], lengths[good])
        for dims in np.unique(lengths[good]).tolist():
            vectors = x[of_row == dims].reshape(-1, dims)
            step = max(1, BLOCK_BYTES // (8 * dims))
            for at in range(0, len(vectors), step):
                part = vectors[at:at + step]
                small = np.iinfo(np.int32).min <= part.min() and part.max() <= np.iinfo(np.int32).max
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dims], pa.int32()), pa.array([len(part)], pa.int64()), pa.array([part.sum(0)], pa.list_(pa.int64())),
                     pa.array([part.astype("<i4" if small else "<i8").tobytes()], pa.binary())], ["dims", "n", "sums", "x"])


def _centred(data: bytes, rows: int, n: int, sums: np.ndarray) -> np.ndarray:
    x = np.frombuffer(data, "<i4" if len(data) == 4 * rows * len(sums) else "<i8").reshape(rows, -1).astype(np.int64)
    return (n * x - sums) / n


class Passes:
    """Products of the covariance with blocks of vectors, each one job over the written blocks."""

    def __init__(self, blocks: DataFrame, n: int, sums: np.ndarray) -> None:
        self.blocks, self.n, self.sums, self.count = blocks.select("n", "x"), n, sums, 0

    def _sum(self, of_block, columns: int) -> np.ndarray:
        """``of_block(centred)``, dims x columns, summed over all blocks."""
        n, sums = self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(sums), columns))
            for b in batches:
                for rows, data in zip(b.column(0).to_pylist(), b.column(1)):
                    total += of_block(_centred(data.as_py(), rows, n, sums))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(sums), dtype=np.int32)), *(pa.array(c) for c in total.T)],
                ["dim", *(f"c{i}" for i in range(columns))])

        names = [f"c{i}" for i in range(columns)]
        parts = self.blocks.mapInArrow(run, "dim int, " + ", ".join(f"{c} double" for c in names))
        rows = parts.groupBy("dim").agg(*(F.sum(c).alias(c) for c in names)).collect()
        self.count += 1
        out = np.zeros((len(sums), columns))
        for r in rows:
            out[r["dim"]] = r[1:]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q."""
        return self._sum(lambda centred: centred.T @ (centred @ q), q.shape[1]) / self.n

    def variances(self) -> np.ndarray:
        """The diagonal of V."""
        return self._sum(lambda centred: np.square(centred).sum(0)[:, None], 1)[:, 0] / self.n


def _least_bound(passes: Passes, dims: int, rng: np.random.Generator) -> float:
    """About the least eigenvalue, from below: Lanczos' least value less its residual."""
    q = rng.standard_normal(dims)
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS_STEPS, dims)):
        w = passes.times(basis[-1][:, None])[:, 0]
        alphas.append(float(basis[-1] @ w))
        for _ in range(2):  # once more, against rounding
            w -= np.stack(basis, 1) @ (np.stack(basis, 1).T @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * abs(alphas[0]):
            break
        basis.append(w / betas[-1])
    k = len(alphas)
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:k - 1], 1) + np.diag(betas[:k - 1], -1))
    return max(0.0, float(values[0]) - betas[k - 1] * abs(float(vectors[-1, 0])))


def _degree(low: float, cut: float, top: float, wanted: float) -> int:
    """The largest degree that doesn't amplify ``top`` too far over ``wanted``."""
    centre, half = (low + cut) / 2, (cut - low) / 2
    growth = [math.acosh(max(1.0, (v - centre) / half)) for v in (top, wanted)]
    spread = growth[0] - growth[1]
    return max(2, min(DEGREE, int(math.log(MAX_AMPLIFIED) / spread) if spread > 0 else DEGREE))


def _filtered(passes: Passes, q: np.ndarray, vq: np.ndarray, locked: np.ndarray, degree: int, low: float, cut: float,
              top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V, applied to ``q`` (``vq`` is V q), in the space
    orthogonal to the locked vectors: what rounding leaves of them mustn't grow."""
    def apart(y: np.ndarray) -> np.ndarray:
        return y - locked @ (locked.T @ y)

    centre, half = (low + cut) / 2, (cut - low) / 2
    sigma = first = half / (top - centre)  # keeps the top's factor at 1
    before, now = q, apart(vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, apart(passes.times(now) - centre * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The Ritz vectors in the space of ``q`` by falling value, V times them, and the values."""
    values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
    return q @ turn[:, ::-1], vq @ turn[:, ::-1], values[::-1]


def leading_vectors(passes: Passes, dims: int, wanted: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` leading eigenvectors, their values, and the largest residual in
    parts of the largest value."""
    rng = np.random.default_rng(SEED)
    width = min(dims, max(block, wanted + 2))
    low = _least_bound(passes, dims, rng) if width < dims else 0.0
    locked, scale, best = np.zeros((dims, 0)), 0.0, math.inf
    q = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    for _ in range(MAX_ROUNDS):
        q, vq, values = _ritz(q, passes.times(q))
        scale = max(scale, float(values[0]))
        if scale <= 0 or width == dims:  # no variance at all, or the whole space
            break
        residuals = np.linalg.norm(vq - q * values, axis=0) / scale
        need = wanted - locked.shape[1]
        worst = float(residuals[:need].max())
        # The second: rounding that further rounds don't lessen.
        if worst <= TOLERANCE or best < WORST and worst > best / 2:
            break
        best = min(best, worst)
        done = int(np.argmax(np.append(residuals[:need - 1], 1.0) > LOCK))
        locked = np.concatenate([locked, q[:, :done]], 1)
        q, vq, values = q[:, done:], vq[:, done:], values[done:]
        least = min(low, float(values[-1]))
        cut = max(float(values[-1]), least + 1e-6 * scale)
        top = max(float(values[0]), cut + 1e-6 * scale)
        degree = _degree(least, cut, top, float(values[need - done - 1]))
        q = _filtered(passes, q, vq, locked, degree, least, cut, top)
        for _ in range(2):
            q = np.linalg.qr(q - locked @ (locked.T @ q))[0]
    q = np.linalg.qr(np.concatenate([locked, q], 1))[0]
    q, vq, values = _ritz(q, passes.times(q))
    residual = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max()) / scale if scale > 0 else 0.0
    return q[:, :wanted], values[:wanted], residual


def fit(embeddings: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> Whitening | None:
    """Means, components and their check over all whole vectors; None without one."""
    spark = embeddings.sparkSession
    path = scratch_path(spark, "vectors")
    try:
        blocks = materialize_to(embeddings.select("embedding").mapInArrow(_as_blocks, "dims int, n long, sums array<long>, x binary"), path)
        most = blocks.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
        if most is None:
            return None
        dims, n = most
        blocks = blocks.filter(F.col("dims") == dims)
        by_dim = blocks.select(F.posexplode("sums").alias("dim", "s")).groupBy("dim").agg(F.sum("s").alias("s")).collect()
        sums = np.zeros(dims, np.int64)
        for r in by_dim:
            sums[r["dim"]] = r["s"]
        passes, wanted = Passes(blocks, n, sums), min(components, dims)
        trace = float(math.fsum(passes.variances()))
        vectors, values, residual = leading_vectors(passes, dims, wanted, block)
        values = np.where(values > 1e-12 * max(trace, 0.0), values, 0.0)
        if residual > WORST:
            raise RuntimeError(f"components not certified: residual {residual:.1e} of the largest eigenvalue")
        alive = vectors[:, values > 0] / np.sqrt(values[values > 0])
        error = float(np.abs(alive.T @ passes.times(alive) - np.eye(alive.shape[1])).max()) if alive.size else 0.0
        return Whitening(n, sums, vectors, values, trace, error, residual, passes.count)
    finally:
        remove_path(spark, path)


def _deviations(centred: np.ndarray) -> list[int]:
    """Exact sums of squares of whole numbers."""
    top = int(max(centred.max(), -centred.min()))
    if top * top * centred.shape[1] < 1 << 63:
        return np.square(centred).sum(1).tolist()
    return [sum(v * v for v in row) for row in centred.tolist()]


def whiten(embeddings: DataFrame, fitted: Whitening | None) -> DataFrame:
    """A row for each whole vector of the fitted length and each component: ``vec_id``, ``component``,
    ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``, ``deviation_exact``."""
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    ddl = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double, deviation_exact decimal(38,0)")
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], ddl)
    n, sums, k = fitted.n, fitted.sums, len(fitted.values)
    roots = np.sqrt(fitted.values)
    matrix = np.divide(fitted.vectors, roots, out=np.zeros_like(fitted.vectors), where=roots > 0)
    explained = fitted.values / fitted.trace if fitted.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, lengths, x = whole_numbers(b.column(1))
            x = x[np.repeat(lengths[good], lengths[good]) == len(sums)].reshape(-1, len(sums))
            rows = np.flatnonzero(good & (lengths == len(sums)))
            if not len(rows):
                continue
            centred = n * x - sums
            exact = _deviations(centred)
            whitened = pa.array(((centred / n) @ matrix).ravel(), mask=np.tile(roots == 0, len(rows)))
            each = np.repeat(np.arange(len(rows)), k)
            deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            as_decimal = pa.array([Decimal(d) if d < 10 ** 38 else None for d in exact], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(len(each), n)), deviation.take(pa.array(each)), whitened,
                 pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(each), fitted.identity_error)),
                 as_decimal.take(pa.array(each))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return embeddings.select("vec_id", "embedding").mapInArrow(run, ddl)


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """Fits on all rows and whitens them all."""
    return whiten(embeddings, fit(embeddings))
