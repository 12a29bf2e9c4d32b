"""Embedding whitening by a bidiagonal qd solver (operator 12).

Components of decorrelated, unit-variance vectors, from the singular values
of the centred rows; no covariance matrix is formed, so small directions keep
their digits.

*Blockwise QR.*  Vectors are put on an integer grid (``floor(scale * c) +
shift``), and each distinct grid vector is a row of the fit once, however
many copies there are.  Their sums are exact.  A task reduces its centred
rows, batch by batch, to one triangular factor; factors are stacked and
reduced again, ``FAN`` at a time, until one of ``d x d`` is left for the driver.

*Solver*, on that one factor: Householder reflections make it bidiagonal;
dqds (quotient-difference steps with shifts, which only multiply, divide and
add) finds the squared singular values to high relative accuracy; a
twisted factorisation, stationary from above and progressive from below,
joined where its pivot is least, gives each direction.  Directions of a
cluster of values are kept apart by steps of inverse iteration.

Rows are whitened by one product with at most ``limit`` directions, and the
whitened fit rows are measured: their covariance against the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import written

SCALE, SHIFT = 64, 1_000_000
#: Factors that one task stacks.
FAN = 64
#: Entries from here on in size aren't held exactly by the grid; their vectors are left out like non-finite ones.
_LARGEST = 2.0**52
_EPS = float(np.finfo(np.float64).eps)


# ---------------------------------------------------------------- the solver

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V' for a square ``r``."""
    a = np.array(r, np.float64)
    d = len(a)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        h = x / size
        h[0] += 1.0 if h[0] >= 0 else -1.0
        return h / np.linalg.norm(h)

    for j in range(d):
        h = reflector(a[j:, j])
        if h is not None:
            a[j:, j:] -= 2 * np.outer(h, h @ a[j:, j:])
        if j + 2 < d:
            h = reflector(a[j, j + 1 :].copy())
            if h is not None:
                a[j:, j + 1 :] -= 2 * np.outer(a[j:, j + 1 :] @ h, h)
                v[:, j + 1 :] -= 2 * np.outer(v[:, j + 1 :] @ h, h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step with a shift: (q, e, least d), or None where
    the shift was above the least value."""
    d = q[0] - shift
    least, qs, es = d, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        t = q[i + 1] / top if top > 0 else 0.0
        qs.append(top)
        es.append(e[i] * t)
        d = (d * t if top > 0 else q[i + 1]) - shift
        least = min(least, d)
    if d < 0:
        return None
    qs.append(d)
    return qs, es, least


def dqds(q: list[float], e: list[float]) -> list[float]:
    """The squared singular values, falling, of the bidiagonal whose squared
    diagonal is ``q`` and squared superdiagonal ``e``."""
    tiny = (10 * _EPS) ** 2
    out, blocks = [], [(list(q), list(e), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        for _ in range(100 * len(q) + 100):
            if not q:
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tiny * (sigma + q[i]) or e[i] <= tiny * (sigma + q[i + 1])), None)
            if len(q) == 1:
                out.append(q[0] + sigma)
                q = []
            elif cut == len(e) - 1:
                out.append(q.pop() + sigma)
                e.pop()
            elif cut is not None:
                blocks.append((q[cut + 1 :], e[cut + 1 :], sigma))
                q, e = q[: cut + 1], e[:cut]
            else:
                if q[-1] > 1.5 * q[0]:
                    q, e = q[::-1], e[::-1]  # the same values; the small end goes last
                # a bound from the last rows is tried as the shift, then smaller ones, which can't fail at zero
                guess = max(0.0, min(q[-1], q[-2]) - 0.5 * np.sqrt(e[-1] * max(q[-1], 0.0)) - 0.25 * e[-1])
                for shift in (min(guess, 0.999 * q[-1]), 0.25 * guess, 0.0):
                    step = _qd_step(q, e, float(shift))
                    if step is not None:
                        q, e, _ = step
                        sigma += float(shift)
                        break
        else:
            raise ArithmeticError("qd steps did not settle")
    return sorted(out, reverse=True)


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Factors of B'B - value: L (subdiagonal) and its pivots from above, U
    (superdiagonal) and its pivots from below, and the twist pivots."""
    n = len(a)
    q, e, ab = a * a, b * b, a[:-1] * b
    small = _EPS * _EPS * max(value, 1e-300)
    down, lower, s = np.empty(n), np.empty(n - 1), -value
    stationary = np.empty(n)
    for i in range(n):
        stationary[i] = s
        down[i] = q[i] + s
        if abs(down[i]) < small:
            down[i] = -small
        if i < n - 1:
            lower[i] = ab[i] / down[i]
            s = e[i] / down[i] * s - value
    up, upper, p = np.empty(n), np.empty(n - 1), q[-1] - value
    progressive = np.empty(n)
    progressive[-1] = p
    for i in range(n - 2, -1, -1):
        up[i + 1] = e[i] + p
        if abs(up[i + 1]) < small:
            up[i + 1] = -small
        upper[i] = ab[i] / up[i + 1]
        p = p * (q[i] / up[i + 1]) - value
        progressive[i] = p
    return lower, down, upper, up, stationary + progressive + value


def _direction(a: np.ndarray, b: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """A unit direction of B'B for ``value``, at right angles to those ``near`` it."""
    n = len(a)
    lower, down, upper, up, pivot = _twisted(a, b, value)
    k = int(np.argmin(np.abs(pivot)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -upper[i] * z[i]
    z /= np.linalg.norm(z)
    if not near:
        return z
    floor = np.where(np.abs(pivot[k]) < _EPS * value, _EPS * value, pivot[k])
    start = np.random.default_rng(n).standard_normal(n)
    for turn in range(6):
        for y in near * 2:
            z = z - (y @ z) * y
        size = np.linalg.norm(z)
        z = z / size if size > 1e-8 else start / np.linalg.norm(start)
        if turn == 5 or (turn >= 2 and size > 0.5):
            break
        # N D N' x = z with N unit, bidiagonal from both ends towards k
        x = z.copy()
        for i in range(1, k + 1):
            x[i] -= lower[i - 1] * x[i - 1]
        for i in range(n - 2, k - 1, -1):
            x[i] -= upper[i] * x[i + 1]
        x[:k] /= down[:k]
        x[k + 1 :] /= up[k + 1 :]
        x[k] /= floor
        for i in range(k - 1, -1, -1):
            x[i] -= lower[i] * x[i + 1]
        for i in range(k, n - 1):
            x[i + 1] -= upper[i] * x[i]
        z = x / np.linalg.norm(x)
        start = start[::-1] + turn
    for y in near * 2:
        z = z - (y @ z) * y
    return z / np.linalg.norm(z)


def singular_directions(r: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values of ``r``, falling; their right directions as
    columns; the sum of all squared values), at most ``limit`` and none that is zero to rounding."""
    a, b, v = bidiagonal(r)
    d, norm = len(a), max(float(np.max(np.abs(a), initial=0.0)), float(np.max(np.abs(b), initial=0.0)))
    if norm == 0:
        return np.empty(0), np.empty((d, 0)), 0.0
    cuts = [0, *(np.flatnonzero(np.abs(b) <= _EPS * norm) + 1).tolist(), d]
    blocks = [slice(x, y) for x, y in zip(cuts, cuts[1:])]
    found = []  # (squared value, block)
    for n, s in enumerate(blocks):
        inner = b[s.start : s.stop - 1]
        found += [(x, n) for x in dqds((a[s] ** 2).tolist(), (inner**2).tolist())]
    found.sort(key=lambda x: (-x[0], x[1]))
    total = sum(x for x, _ in found)
    least = found[0][0] * (10 * d * _EPS) ** 2
    found = [x for x in found[:limit] if x[0] > least]
    out = np.zeros((d, len(found)))
    for i, (value, n) in enumerate(found):
        s = blocks[n]
        near = [out[s, j] for j in range(i) if found[j][1] == n and found[j][0] - value <= 1e-3 * found[j][0]]
        out[s, i] = _direction(a[s], b[s.start : s.stop - 1], value, near) if s.stop - s.start > 1 else 1.0
    return np.array([x for x, _ in found]), v @ out, total


# ------------------------------------------------------------- rows in Spark

def _grid(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first value, size) of the vectors of a list column that can be
    put on the grid, and all values as doubles (nulls: nan)."""
    array = array.cast(pa.list_(pa.float64()))
    offsets = array.offsets.to_numpy()
    values = array.values.to_numpy(zero_copy_only=False)
    bad = ~(np.abs(values * SCALE) < _LARGEST)
    upto = np.concatenate(([0], np.cumsum(bad)))
    fine = array.is_valid().to_numpy(zero_copy_only=False) & (upto[offsets[1:]] == upto[offsets[:-1]]) & (offsets[1:] > offsets[:-1])
    row = np.flatnonzero(fine)
    return row, offsets[row], offsets[row + 1] - offsets[row], values


def _on_grid(values: np.ndarray) -> np.ndarray:
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def grid_rows(vectors: DataFrame, column: str) -> DataFrame:
    """(size, x) of every usable vector: its length and grid entries, as bytes
    of the least width that holds them (equal vectors have equal bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, size, values = _grid(batch.column(0))
            out = []
            for a, n in zip(first.tolist(), size.tolist()):
                x = _on_grid(values[a : a + n]) - SHIFT
                most = int(np.abs(x).max())
                width = "<i1" if most < 2**7 else "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
                out.append(x.astype(width).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int32)), pa.array(out, pa.binary())], ["size", "x"])

    return vectors.select(F.col(f"`{column}`").alias("v")).mapInArrow(run, "size int, x binary")


def _unpacked(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The grid vectors of a batch of ``grid_rows`` of length ``d``."""
    return np.array([np.frombuffer(x, f"<i{len(x) // d}") for x in batch.column("x").to_pylist()], np.int64).reshape(-1, d) + SHIFT


def _sums(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            x = _unpacked(batch, d)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "total"])

    parts = fit.select("x").mapInArrow(run, "n long, total array<long>")
    rows = parts.select("n", F.posexplode("total").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    total = np.zeros(d, np.int64)
    for r in rows:
        total[r.i] = r.s
    return (rows[0].n if rows else 0), total


def _triangle(rows: np.ndarray, d: int) -> np.ndarray:
    """The triangular factor of some rows, as d x d."""
    r = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, d))
    return np.vstack((r, np.zeros((d - len(r), d)))) if len(r) < d else r


def triangular_factor(fit: DataFrame, d: int, n: int, total: np.ndarray) -> np.ndarray:
    """R of the centred rows, reduced in tasks and then ``FAN`` factors at a time."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            r = _triangle(np.vstack((r, (n * _unpacked(batch, d) - total) / n)), d)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for raw in batch.column("r").to_pylist():
                r = _triangle(np.vstack((r, np.frombuffer(raw, np.float64).reshape(d, d))), d)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    factors = written(fit.select("x").mapInArrow(first, "r binary"), "factors")
    while (parts := factors.count()) > FAN:
        factors = written(factors.repartition(-(-parts // FAN)).mapInArrow(again, "r binary"), "factors")
    left = [np.frombuffer(r.r, np.float64).reshape(d, d) for r in factors.collect()]
    return _triangle(np.vstack(left), d) if left else np.zeros((d, d))


@dataclass
class Whitening:
    """A fitted transform: ``n`` grid vectors of length ``d`` with sums
    ``total``; ``directions`` (d x components), their variances ``values`` and
    shares ``explained``; ``identity_error`` of the whitened fit rows."""

    d: int
    n: int
    total: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened grid vectors."""
        return ((self.n * x - self.total) / self.n) @ (self.directions / np.sqrt(self.values))


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened fit rows' covariance less the identity."""
    d, m = model.d, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(m), np.zeros((m, m))
        for batch in batches:  # each batch is centred on its own mean, then joined to those before
            w = model.apply(_unpacked(batch, d))
            if not len(w):
                continue
            centre = w.mean(axis=0)
            w = w - centre
            away = centre - mean
            spread += w.T @ w + np.outer(away, away) * n * len(w) / (n + len(w))
            mean += away * len(w) / (n + len(w))
            n += len(w)
        sums = np.concatenate((n * mean, (spread + n * np.outer(mean, mean)).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["s"])

    parts = fit.select("x").mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "s"))
    sums = np.zeros(m + m * m)
    for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect():
        sums[r.i] = r.s
    mean = sums[:m] / model.n
    return float(np.abs(sums[m:].reshape(m, m) / model.n - np.outer(mean, mean) - np.eye(m)).max())


def fit(vectors: DataFrame, column: str = "embedding", limit: int = 16) -> Whitening | None:
    """The whitening of the distinct grid vectors of ``column``, with at most
    ``limit`` components; None if no row has a usable vector.

    Not usable: null and empty vectors, those with null or non-finite entries
    (or entries of 2^52 / 64 or more, which the grid can't hold), and vectors
    of another length than most rows have (of equals, the longest).
    Directions without variance, to rounding, are no components."""
    grid = written(grid_rows(vectors, column).groupBy("size", "x").agg(F.count("*").alias("copies")), "grid")
    sizes = grid.groupBy("size").agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not sizes:
        return None
    d = sizes[0]["size"]
    rows = grid.where(F.col("size") == d)
    n, total = _sums(rows, d)
    squares, directions, everything = singular_directions(triangular_factor(rows, d, n, total), limit)
    model = Whitening(d, n, total, directions, squares / n, squares / everything if everything else squares)
    if len(squares):
        model.identity_error = _identity_error(rows, model)
    return model


def whiten(vectors: DataFrame, model: Whitening | None, keep: list[str], column: str = "embedding") -> DataFrame:
    """The columns ``keep`` of every row with a usable vector, with ``deviation``
    (long: the exact sum of (n x - total)^2; null where a long can't hold it)
    and ``whitened`` (an array of a number for each component)."""
    names = [f"c{i}" for i in range(len(keep))]
    rows = vectors.select(F.col(f"`{column}`").alias("v"), *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)])
    schema = T.StructType([f for f in rows.schema.fields if f.name != "v"])
    schema = schema.add("deviation", "long").add("whitened", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, size, values = _grid(batch.column(0))
            fits = size == model.d
            row, first = row[fits], first[fits]
            x = _on_grid(values[first[:, None] + np.arange(model.d)])
            away = model.n * x - model.total
            about = model.n * x.astype(np.float64) - model.total
            held = (np.abs(about) < 2.0**62).all(axis=1) & ((about * about).sum(axis=1) < 2.0**63 * (1 - 1e-9))
            deviation = pa.array((away * away).sum(axis=1), mask=~held)
            w = model.apply(x)
            m = w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * m), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n).take(pa.array(row)) for n in names), deviation, lists], schema.names)

    out = rows.mapInArrow(run, schema) if model else vectors.sparkSession.createDataFrame([], schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "deviation", "whitened")


def component_rows(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: the key, ``component`` (from
    1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    rows = whiten(vectors, model, [key], column).withColumnRenamed(key, "id").select(
        "id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in model.explained]) if model and len(model.explained) else F.array().cast("array<double>")
    return rows.select(
        F.col("id").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"))
