"""Whitening of vectors along their leading components, found by contour integration.

The covariance is summed in tasks: first the number of vectors and the exact sums per dimension, then the
products of what is left after the nearest integers to the means are taken off, which are whole numbers
and add up exactly in doubles. Its size depends on the dimension alone.

Its leading eigenvectors are found by contour integration, each interval of eigenvalues in a task of its own:

* Inertia counts (signs of the pivots of ``V - c``, a symmetric factorisation) say how many eigenvalues
  lie above c. Bisection by them gives the interval that holds the wanted ones, and cuts it into small ones.
* In each, a Gauss-Legendre rule on the half circle over the interval adds up solutions of ``(z - V) Y = Q`` at
  complex shifts z. The sum projects Q onto the eigenvectors of the interval; Rayleigh-Ritz
  extracts them, and the step is repeated until the residuals are at rounding.
* The number found must be the inertia count of the interval; if not, the step starts again with
  a larger Q. At the end one Rayleigh-Ritz step over all intervals makes the vectors orthonormal.

Vectors that are null, empty, of another length than most, or hold null or non-finite components are dropped; so are
those with an entry beyond 2**53 after scaling. Where the vectors vary in fewer directions than asked for, the
further components are any unit vectors orthogonal to the others: their explained share is 0 (null where
nothing varies at all) and their whitened value is null. Repeated rows count as often as they stand. Extra columns are kept. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.pivots import matrix, scaled
from claimweave.llm.tables import Scratch, fresh, quoted

#: Nodes of the quadrature on the half circle, rounds, and eigenvalues an interval should hold at most.
NODES, ROUNDS, PER_INTERVAL = 8, 40, 4
#: Integers that a long holds.
LONG = 1 << 63


def above(v: np.ndarray, c: float) -> int:
    """How many eigenvalues of ``v`` are greater than ``c``: positive pivots of a factorisation of v - c.

    Diagonal pivots of size 1 or 2 are chosen by size; one of size 2 has one positive and one negative eigenvalue.
    """
    a = v - c * np.eye(len(v))
    positive, alpha = 0, (1 + 17**0.5) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(off.argmax(), off.shape)
        if diagonal[p] >= alpha * off[i, j]:
            if diagonal[p] == 0:
                break
            positive += a[p, p] > 0
            rest = np.delete(np.arange(len(a)), p)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, p], a[p, rest]) / a[p, p]
        else:
            positive += 1
            rest = np.delete(np.arange(len(a)), [i, j])
            side = a[np.ix_(rest, [i, j])]
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_([i, j], [i, j])], side.T)
    return int(positive)


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Disjoint intervals (low, high, count) that together hold the ``wanted`` greatest eigenvalues or a few more."""
    radius = np.abs(v).sum(1) - np.abs(np.diag(v))
    high = float((np.diag(v) + radius).max())
    low = float((np.diag(v) - radius).min())
    width = max(abs(high), abs(low), np.finfo(float).tiny)
    low, high = low - 0.01 * width, high + 0.01 * width
    lower, upper, held = low, high, len(v)
    while held > 2 * wanted and upper - lower > 1e-12 * width:
        middle = (lower + upper) / 2
        count = above(v, middle)
        if count >= wanted:
            lower, held = middle, count
        else:
            upper = middle
    out, open_ = [], [(lower, high, held)]
    while open_:
        a, b, count = open_.pop()
        if count <= PER_INTERVAL or b - a < 1e-10 * width:
            if count:
                out.append((a, b, count))
            continue
        # the cut among a few that leaves the halves most alike
        cuts = [(a + (b - a) * f) for f in (0.5, 0.35, 0.65, 0.2, 0.8)]
        counted = [(c, above(v, c) - above(v, b)) for c in cuts]
        c, upper_part = min(counted, key=lambda x: abs(2 * x[1] - count))
        open_ += [(a, c, count - upper_part), (c, b, upper_part)]
    return out


def rayleigh_ritz(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit vectors of ``v`` within the span of ``basis``, by falling eigenvalue."""
    q, _ = np.linalg.qr(basis)
    small = q.T @ v @ q
    e, s = np.linalg.eigh((small + small.T) / 2)
    return e[::-1], (q @ s)[:, ::-1]


def contour(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` between ``low`` and ``high``, and their unit vectors."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    shifts = centre + radius * np.exp(1j * angle)
    rng = np.random.default_rng(0)
    size = min(d, 2 * count + 8)
    while True:
        x = rng.standard_normal((d, size))
        best = np.inf
        for _ in range(ROUNDS):
            total = np.zeros((d, size))
            for z, w, t in zip(shifts, weights, angle, strict=True):
                y = np.linalg.solve(z * np.eye(d) - v, x.astype(complex))
                total += w / 2 * radius * (np.exp(1j * t) * y).real
            e, x = rayleigh_ritz(v, total)
            inside = (e > low) & (e <= high)
            residual = np.linalg.norm(v @ x[:, inside] - x[:, inside] * e[inside], axis=0).max(initial=0)
            if inside.sum() == count and (residual <= 8 * np.finfo(float).eps * np.abs(e).max() or residual >= 0.5 * best):
                return e[inside], x[:, inside]
            best = min(best, residual) if inside.sum() == count else np.inf
        if size == d:
            # rounding at an end of the interval: take those nearest to it
            near = np.argsort(np.maximum(low - e, e - high), kind="stable")[:count]
            near = near[np.argsort(-e[near], kind="stable")]
            return e[near], x[:, near]
        size = min(d, 2 * size)


class Whitening:
    """Mean, leading components and explained shares of a table of vectors."""

    def __init__(self, vectors: DataFrame, components: int = 8, vector: str = "embedding", scale: int = 1024, shift: int = 100_000):
        self.spark, self.vector, self.scale, self.shift = vectors.sparkSession, vector, scale, shift
        x = scaled(quoted(vector), scale)
        rows = vectors.select(x.alias("x")).where("x is not null")
        common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
        self.n, self.d = (common["count"], common["d"]) if common else (0, 0)
        self.sums = np.zeros(self.d, object)
        if self.n:
            rows = rows.where(F.size("x") == self.d)
            # exact sums: one row per dimension reaches the driver
            each = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)") + shift).alias("s"))
            for r in each.collect():
                self.sums[r["i"]] = int(r["s"])
            self.v = self._covariance(rows)
            self.e, self.u = self._components(min(components, self.d))

    def _covariance(self, rows: DataFrame) -> np.ndarray:
        """Covariance with divisor n; its upper triangle, one row per cell, reaches the driver."""
        n, d, shift = self.n, self.d, self.shift
        middle = np.array([(2 * s + n) // (2 * n) for s in self.sums], object)  # nearest whole numbers to the means
        whole = (middle - shift).astype(np.int64)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, d))
            for batch in batches:
                if batch.num_rows:
                    c = (matrix(batch.column(0)) - whole).astype(np.float64)
                    total += c.T @ c
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array((i * d + j).astype(np.int64)), pa.array(total[i, j])], names=["cell", "s"])

        v = np.zeros((d, d))
        for r in rows.mapInArrow(task, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect():
            i, j = divmod(r["cell"], d)
            v[i, j] = v[j, i] = r["s"]
        # what the nearest whole numbers leave of the means, exact before the division
        rest = np.array([float(s - m * n) / n for s, m in zip(self.sums, middle, strict=True)])
        return v / n - np.outer(rest, rest)

    def _components(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues and unit vectors by falling eigenvalue; the intervals are solved in tasks."""
        trace = float(np.trace(self.v))
        if trace <= 0:
            return np.zeros(wanted), np.eye(self.d)[:, :wanted]
        v = self.v / trace
        sent = self.spark.sparkContext.broadcast(v)  # dimension squared
        parts = intervals(v, wanted)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    _, x = contour(sent.value, a, b, count)
                    yield pa.RecordBatch.from_arrays([pa.array([a] * count), pa.array(list(x.T), pa.list_(pa.float64()))], names=["low", "vector"])

        asked = self.spark.createDataFrame(parts, "low double, high double, count long").repartition(len(parts), "low")
        found = asked.mapInArrow(task, "low double, vector array<double>").orderBy("low").collect()  # ``wanted`` or a few more vectors
        e, u = rayleigh_ritz(v, np.array([r["vector"] for r in found]).T)
        e, u = np.maximum(e[:wanted], 0) * trace, u[:, :wanted]
        u = u * np.sign(u[np.abs(u).argmax(0), np.arange(u.shape[1])])
        return e, u

    @property
    def explained(self) -> list[float | None]:
        trace = float(np.trace(self.v)) if self.n else 0.0
        return [float(x) / trace if trace > 0 else None for x in self.e]

    def _varies(self) -> np.ndarray:
        return self.e > 64 * self.d * np.finfo(float).eps * max(float(np.trace(self.v)), np.finfo(float).tiny)

    def apply(self, vectors: DataFrame, name: str = "whitened") -> DataFrame:
        """Rows that take part, with a struct ``name``: deviation (decimal, null beyond 38 digits) and values per component."""
        name, held = fresh(vectors, name), fresh(vectors, "scaled")
        schema = T.StructType([*vectors.schema.fields, T.StructField(name, _KIND)])
        rows = vectors.withColumn(held, scaled(quoted(self.vector), self.scale)).where(F.size(quoted(held)) == self.d)
        if not self.n:
            return vectors.limit(0).withColumn(name, F.lit(None).cast(_KIND))
        n, d, shift, u = self.n, self.d, self.shift, self.u
        sums, deep = self.sums, np.where(self._varies(), np.sqrt(self.e), np.nan)
        middle = np.array([s // n for s in sums], object)
        rest = np.array([s - m * n for s, m in zip(sums, middle, strict=True)], object)  # below n each
        whole = (middle - shift).astype(np.int64)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(batch.num_columns - 1))
                if not len(x):
                    x = np.zeros((0, d), np.int64)
                c = x - whole
                most = int(np.abs(c).max(initial=0)) + 1
                if (most * n) ** 2 * d < LONG:
                    y = c * n - rest.astype(np.int64)
                    deviation = (y * y).sum(1).tolist()
                    exact = y.astype(np.float64) / n
                else:
                    y = c.astype(object) * n - rest
                    deviation = [int(s) if s < 10**38 else None for s in (y * y).sum(1)] if len(y) else []
                    exact = (c.astype(np.float64) - np.array([float(r) / n for r in rest]))
                white = exact @ u / deep
                flat = pa.array(white.ravel(), from_pandas=True)  # not a number: null
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]), flat)
                added = pa.StructArray.from_arrays([pa.array(deviation, pa.decimal128(38, 0)), lists], names=["deviation", "values"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], added], names=[*batch.schema.names[:-1], name])

        return rows.mapInArrow(task, schema)

    def identity_error(self, whitened: DataFrame, name: str = "whitened") -> float | None:
        """Largest entry of |covariance of the whitened values - identity|, measured over ``whitened``; null without values.

        Batches give count, means and centred products; they are merged by the exact rule for two sets.
        """
        used = np.flatnonzero(self._varies()) if self.n else np.empty(0, int)
        k = len(used)
        if not k:
            return None

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = None
            for batch in batches:
                if batch.num_rows:
                    w = matrix(batch.column(0), np.float64)[:, used]
                    mean = w.mean(0)
                    state = merged(state, (len(w), mean, (w - mean).T @ (w - mean)))
            if state:
                yield pa.RecordBatch.from_arrays([pa.array([state[0]]), pa.array([state[1].tolist()]), pa.array([state[2].ravel().tolist()])], names=["n", "mean", "products"])

        def together(table: pa.Table) -> pa.Table:
            state = None
            for r in table.to_pylist():
                state = merged(state, (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)))
            return pa.table({"n": [state[0]], "mean": [state[1].tolist()], "products": [state[2].ravel().tolist()]})

        kind = "n long, mean array<double>, products array<double>"
        parts = whitened.select(F.col(f"`{name}`.values")).mapInArrow(task, kind)
        # in two steps: at most 64 short rows meet at the end
        some = parts.groupBy(F.pmod(F.xxhash64("mean"), F.lit(64))).applyInArrow(together, kind)
        state = None
        for r in some.collect():
            state = merged(state, (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)))
        return float(np.abs(state[2] / state[0] - np.eye(k)).max())


_KIND = T.StructType([T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("values", T.ArrayType(T.DoubleType()))])


def merged(a: tuple | None, b: tuple) -> tuple:
    """Count, mean and centred products of two sets together."""
    if a is None:
        return b
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def whiten(vectors: DataFrame, components: int = 8, vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> tuple[DataFrame, Whitening, float | None]:
    """The whitened rows (written once), the model, and how far their covariance is from the identity."""
    scratch = Scratch(vectors.sparkSession, "whitening")
    model = Whitening(vectors, components, vector, scale, shift)
    name = fresh(vectors, "whitened")
    rows = scratch.cut(model.apply(vectors))
    return rows, model, model.identity_error(rows, name)
