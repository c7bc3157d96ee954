"""Whitening of embeddings: leading eigenvectors of a covariance that is summed in Spark.

The vectors' sums and the products of their centred entries are summed in tasks and then by entry, so the driver sees one
matrix of the dimensions and never a row. The matrix is brought to tridiagonal form by Householder reflections, its
leading eigenvalues are bisected by Sturm counts, and inverse iteration finds their vectors, those of eigenvalues that
stand close together held orthogonal to one another. The components go to the tasks that project the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import stored, table

#: Dimensions that a vector may have: the driver and each task hold a few matrices of their square.
MOST_DIMENSIONS = 4_096
#: A component has a whitened value if its eigenvalue is above this share of the trace.
FLAT = 1e-12
#: Eigenvalues nearer to one another than this share of the matrix's norm are a cluster.
NEAR = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the Householder vectors (with the row where each begins) of a symmetric matrix."""
    a, n, mirrors = a.astype(np.float64, copy=True), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        if not x[1:].any():
            continue
        v = x / np.abs(x).max()
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ x)
        mirrors.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def count_below(d: np.ndarray, e2: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of `at`: the negative pivots of the Sturm sequence."""
    q = d[0] - at
    found = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = d[i] - at - e2[i - 1] / np.where(np.abs(q) < tiny, -tiny, q)
        found += q < 0
    return found


def leading_values(d: np.ndarray, e: np.ndarray, many: int) -> np.ndarray:
    """The `many` largest eigenvalues, falling, each bisected until its bounds are neighbouring numbers."""
    n, e2 = len(d), e * e
    reach = np.concatenate(([0.0], np.abs(e))) + np.concatenate((np.abs(e), [0.0]))
    norm = max(float((np.abs(d) + reach).max()), np.finfo(float).tiny)
    tiny = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * norm)
    low, high = np.full(many, (d - reach).min() - norm * 1e-15), np.full(many, (d + reach).max() + norm * 1e-15)
    rank = n - 1 - np.arange(many)  # so many eigenvalues are smaller
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = count_below(d, e2, middle, tiny) > rank
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


def solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x of (T - shift) x = b, by elimination with row exchanges; pivots that vanish count as tiny."""
    n = len(d)
    a, u, w, x = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        under, right = e[i], (e[i + 1] if i + 1 < n - 1 else 0.0)
        if abs(under) > abs(a[i]):
            factor, a[i] = a[i] / under, under
            u[i], a[i + 1], w[i] = a[i + 1], u[i] - factor * a[i + 1], right
            u[i + 1] = -factor * right
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            a[i] = a[i] if abs(a[i]) > tiny else tiny
            factor = under / a[i]
            a[i + 1] -= factor * u[i]
            x[i + 1] -= factor * x[i]
    a[-1] = a[-1] if abs(a[-1]) > tiny else tiny
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (u[i] * x[i + 1] if i + 1 < n else 0.0) - (w[i] * x[i + 2] if i + 2 < n else 0.0)) / a[i]
    return x


def leading_components(matrix: np.ndarray, many: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The `many` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    many = min(many, n)
    if not scale:
        return np.zeros(many), np.eye(n)[:many]
    d, e, mirrors = tridiagonal(matrix / scale)
    values = leading_values(d, e, many)
    norm = float(np.abs(d).max() + 2 * (np.abs(e).max() if n > 1 else 0))
    eps = np.finfo(float).eps
    draw, rows, shifts = np.random.default_rng(seed), [], []
    for k in range(many):
        near = [j for j in range(k) if values[j] - values[k] <= NEAR * norm]
        # Equal eigenvalues are kept apart a little, so that their systems differ.
        shift = values[k] if not shifts or shifts[-1] - values[k] > 10 * eps * norm else shifts[-1] - 10 * eps * norm
        x = draw.standard_normal(n)
        for turn in range(12):
            for _ in range(2):
                for j in near:
                    x -= (rows[j] @ x) * rows[j]
            x /= np.sqrt(x @ x)
            residual = d * x - values[k] * x
            residual[:-1] += e * x[1:]
            residual[1:] += e * x[:-1]
            if turn > 2 and np.sqrt(residual @ residual) <= 8 * eps * norm * np.sqrt(n):
                break
            x = solve_shifted(d, e, shift, x, eps * norm)
            x /= np.abs(x).max()
        for j in near:
            x -= (rows[j] @ x) * rows[j]
        rows.append(x / np.sqrt(x @ x))
        shifts.append(shift)
    vectors = np.array(rows)
    for at, v in reversed(mirrors):
        vectors[:, at:] -= 2 * np.outer(vectors[:, at:] @ v, v)
    return values * scale, vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of the vectors of each length, and those vectors as a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, flat[starts[at, None] + np.arange(n)]


def blocks(column: pa.Array, rows: int = 4_096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(column), rows):
        for place, m in by_length(column.slice(at, rows)):
            yield place + at, m


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length of the vectors x (longs): how many there are, and the exact sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, m in blocks(b.column(0)):
                own = np.stack([np.full(m.shape[1], len(m)), (m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)])
                held[m.shape[1]] = held.get(m.shape[1], 0) + own
        for n, (many, high, low) in held.items():
            yield pa.record_batch([pa.array([n] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(many), pa.array(high), pa.array(low)], ["size", "i", "many", "high", "low"])

    parts = rows.select("x").mapInArrow(run, "size int, i int, many long, high long, low long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    found: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(parts.groupBy("size", "i").agg(F.sum("many").alias("many"), whole("high"), whole("low")).collect(), key=lambda r: (r.size, r.i)):
        found.setdefault(r.size, (r.many, []))[1].append((int(r.high) << 32) + int(r.low))
    return found


def products(rows: DataFrame, centred: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """By length of the vectors x: the sum of y y', where y is what `centred` makes of x. Each task sums its own
    products; the tasks' matrices meet entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, m in blocks(b.column(0)):
                y = centred(m.shape[1], m)
                held[m.shape[1]] = held.get(m.shape[1], 0) + y.T @ y
        for n, own in held.items():
            yield pa.record_batch([pa.array([n] * len(own), pa.int32()), pa.array(range(len(own)), pa.int32()), pa.array(list(own), pa.list_(pa.float64()))], ["size", "i", "p"])

    parts = rows.select("x").mapInArrow(run, "size int, i int, p array<double>").select("size", "i", F.posexplode("p").alias("j", "p"))
    lines = parts.groupBy("size", "i", "j").agg(F.sum("p").alias("p")).groupBy("size", "i").agg(F.array_sort(F.collect_list(F.struct("j", "p")))["p"].alias("p"))
    found: dict[int, np.ndarray] = {}
    for r in lines.toLocalIterator():
        found.setdefault(r.size, np.zeros((len(r.p), len(r.p))))[r.i] = r.p
    return {n: (m + m.T) / 2 for n, m in found.items()}


def means(rows: DataFrame, made: Callable[[int, np.ndarray], np.ndarray], count: dict[int, int]) -> dict[int, np.ndarray]:
    """By length of the vectors x: the mean of what `made` makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, m in blocks(b.column(0)):
                held[m.shape[1]] = held.get(m.shape[1], 0) + made(m.shape[1], m).sum(0)
        for n, own in held.items():
            yield pa.record_batch([pa.array([n] * len(own), pa.int32()), pa.array(range(len(own)), pa.int32()), pa.array(own, pa.float64())], ["size", "i", "s"])

    found: dict[int, list[float]] = {}
    for r in sorted(rows.select("x").mapInArrow(run, "size int, i int, s double").groupBy("size", "i").agg(F.sum("s").alias("s")).collect()):
        found.setdefault(r.size, []).append(r.s / count[r.size])
    return {n: np.array(s) for n, s in found.items()}


class Whitening:
    """The fit over vectors x (longs), each of them once: by their length the count, sums, eigenvalues, components."""

    def __init__(self, rows: DataFrame, components: int):
        self.error: dict[int, float] = {}
        found = sums(rows)
        self.count = {d: n for d, (n, _) in found.items()}
        # The mean is a whole number and what is left of it, so that x less the whole number is exact.
        self.whole = {d: np.array([round(Fraction(t, n)) for t in s], np.int64) for d, (n, s) in found.items()}
        self.left = {d: [t - n * int(w) for t, w in zip(s, self.whole[d], strict=True)] for d, (n, s) in found.items()}
        self.components: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.trace = {}
        for d, v in products(rows, self.centred).items():
            v /= self.count[d]
            self.trace[d] = float(np.trace(v))
            values, vectors = leading_components(v, components)
            fine = values > FLAT * self.trace[d]
            self.components[d] = values[fine], vectors[fine]
        middle = means(rows, self.whitened, self.count)
        for d, m in products(rows, lambda d, m: self.whitened(d, m) - middle.get(d, 0.0)).items():
            self.error[d] = float(np.abs(m / self.count[d] - np.eye(len(m))).max(initial=0.0))

    def centred(self, d: int, m: np.ndarray) -> np.ndarray:
        return (m - self.whole[d]).astype(np.float64) - np.array(self.left[d], np.float64) / self.count[d]

    def whitened(self, d: int, m: np.ndarray) -> np.ndarray:
        values, vectors = self.components[d]
        return self.centred(d, m) @ vectors.T / np.sqrt(values)

    def deviations(self, d: int, m: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of each row; None where it passes a long."""
        n, apart, left = self.count[d], m - self.whole[d], self.left[d]
        most = n * (int(np.abs(apart).max(initial=0)) + 1)
        if d * most * most < 1 << 63:
            z = n * apart - np.array(left, np.int64)
            return (z * z).sum(1).tolist()
        exact = ((n * apart.astype(object) - np.array(left, object)) ** 2).sum(1)
        return [t if t < 1 << 63 else None for t in exact.tolist()]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 16, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    Entries c become x = floor(scale c) + offset. Rows with a vector that is null, empty, or holds an entry that is
    null, not finite or beyond a long as x take no part. The fit counts each distinct x once: n of them, sums S, the
    covariance V with divisor n. deviation is the exact sum of (n x - S)^2, null if it passes a long; whitened the
    centred x projected on the component over the root of its eigenvalue; explained the eigenvalue over V's trace;
    identity_error the largest entry by which the covariance of whitened over the fit list misses the identity.

    Components come back as far as their eigenvalues are above FLAT of the trace: none, if all vectors are one.
    Vectors of each length have a fit of their own; one longer than MOST_DIMENSIONS is an error. Repeated rows and
    rows that share or lack an id each come back. Further columns don't matter. An empty table gives an empty result.
    """
    entry = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    fine = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float(1 << 61) / scale))
    rows = df.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).filter(fine)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(entry, lambda c: F.floor(c * scale) + F.lit(offset).cast("long")).alias("x"))
    fit = stored(rows.select("x").distinct(), "vectors")
    longest = fit.agg(F.max(F.size("x"))).first()[0] or 0
    if longest > MOST_DIMENSIONS:
        raise ValueError(f"a vector has {longest} dimensions; whiten() takes {MOST_DIMENSIONS} at most")
    shared = df.sparkSession.sparkContext.broadcast(Whitening(fit, components))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for at, m in blocks(b.column(1)):
                d, rows = m.shape[1], len(m)
                w, values = model.whitened(d, m), model.components[d][0]
                k = len(values)
                made = [
                    b.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.count[d], np.int64)),
                    pa.array(model.deviations(d, m), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(w.ravel()),
                    pa.array(np.tile(values / model.trace[d] if k else values, rows)),
                    pa.array(np.full(rows * k, model.error.get(d, 0.0))),
                ]
                yield pa.record_batch(made, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
