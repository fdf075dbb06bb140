"""Whitening of embeddings by a bidiagonal qd solver.

The fit list is each distinct vector once, as whole numbers. Its sums give the mean. Blocks of centred rows
are reduced to triangular factors by QR, the factors of all tasks by further QR steps in a tree, so no
product of rows is ever formed and no task holds more than a few factors of d x d. Householder reflections
make the last factor bidiagonal; the differential quotient-difference algorithm with shifts (dqds) finds its
singular values to high relative accuracy; a twisted factorisation at each of the largest ones gives its
direction, and the reflections bring the directions back to the vectors' space. The whitened fit list is
measured once more, in Spark, for the error of its covariance.

Defined results: vectors that are null, empty or hold null or non-finite entries are dropped, and so are
vectors of another length than the most frequent one (of equally frequent ones the longest) and those
with an entry beyond 2 ** 44, which no exact sum here could hold; equal vectors and rows that share an id, or
have none, are returned each by itself. A component without variance cannot be whitened and is not
returned, so equal vectors only, or none, give no rows. A deviation beyond 64 bits is null. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakepipe.session import written_once

BLOCK, FAN_IN = 4096, 16  # rows of a block; factors that one task joins
_EPS = float(np.finfo(float).eps)


# --- the solver on one small triangular factor ---------------------------------------------------


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of U' * matrix * V for a square matrix, by Householder reflections; V is orthogonal."""
    a = np.array(matrix, float)
    n = len(a)
    v = np.eye(n)
    for j in range(n):
        u, beta = _reflector(a[j:, j])
        a[j:, j:] -= beta * np.outer(u, u @ a[j:, j:])
        if j < n - 2:
            u, beta = _reflector(a[j, j + 1 :])
            a[j:, j + 1 :] -= beta * np.outer(a[j:, j + 1 :] @ u, u)
            v[:, j + 1 :] -= beta * np.outer(v[:, j + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(u, beta): I - beta * u * u' maps ``x`` to a multiple of the first axis."""
    u = np.array(x, float)
    size = float(np.abs(u).max(initial=0.0))
    if size == 0.0:
        return u, 0.0
    u /= size
    u[0] += math.copysign(float(np.linalg.norm(u)), u[0])
    return u, 2.0 / float(u @ u)


def dqds(q: list[float], e: list[float]) -> list[float]:
    """The squared singular values of a bidiagonal matrix from its squared diagonal and superdiagonal, largest first.

    Shifts are Newton's steps to the smallest value: the sum of the reciprocals of an unshifted step's d is the
    trace of the inverse, so its reciprocal never passes the smallest value.
    """
    tolerance = (10 * _EPS) ** 2
    found: list[float] = []
    blocks = [(list(q), list(e), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + moved)
                break
            if e[-1] <= tolerance * (moved + q[-1]):
                found.append(q.pop() + moved)
                e.pop()
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= tolerance * (moved + min(q[i], q[i + 1]))), -1)
            if cut >= 0:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            plain = _step(q, e, 0.0)
            shift = 0.0
            if plain[2] and min(plain[2]) > 0.0:
                shift = (1.0 - 4 * n * _EPS) / sum(1.0 / d for d in plain[2])
            taken = _step(q, e, shift) if shift > _EPS * _EPS * moved else plain
            if min(taken[2]) < 0.0:
                taken, shift = plain, 0.0
            elif taken is plain:
                shift = 0.0
            q, e, moved = taken[0], taken[1], moved + shift
    return sorted((max(0.0, value) for value in found), reverse=True)


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step: the new q and e, and the d on the way."""
    new_q, new_e, all_d = [], [], []
    d = q[0] - shift
    for i in range(len(e)):
        all_d.append(d)
        total = d + e[i]
        ratio = q[i + 1] / total if total else 0.0
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    all_d.append(d)
    new_q.append(d)
    return new_q, new_e, all_d


def twisted_vector(q: np.ndarray, low: np.ndarray, value: float, skip: int = 0) -> np.ndarray:
    """The unit eigenvector of L * diag(q) * L' for an eigenvalue, where L has the subdiagonal ``low``.

    The factorisations from the top and from the bottom meet where the twist's pivot is smallest; ``skip`` takes the
    next smallest instead, for values too close to tell apart.
    """
    n = len(q)
    tiny = _EPS * _EPS * max(float(np.abs(q).max()), 1e-300)

    def solid(x: float) -> float:
        return x if abs(x) > tiny else math.copysign(tiny, x)

    down, s = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        down[i] = q[i] * low[i] / solid(s[i] + q[i])
        s[i + 1] = down[i] * low[i] * s[i] - value
    up, p = np.zeros(n), np.zeros(n)
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        ratio = q[i] / solid(q[i] * low[i] ** 2 + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    twist = int(np.argsort(np.abs(s + p + value), kind="stable")[min(skip, n - 1)])
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def leading_directions(factor: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, directions as columns, sum of all squares) of the ``count`` largest of a square matrix."""
    a, b, v = bidiagonal(factor)
    total = float((a**2).sum() + (b**2).sum())
    scale = math.sqrt(total)
    if scale == 0.0:
        return np.zeros(0), np.zeros((len(a), 0)), 0.0
    a, b = a / scale, b / scale
    a = np.where(np.abs(a) < _EPS * _EPS, _EPS * _EPS, a)
    split = np.abs(b) <= _EPS * (np.abs(a[:-1]) + np.abs(a[1:])) / 8
    edges = [0, *(np.flatnonzero(split) + 1).tolist(), len(a)]
    pairs = []  # (value, block's begin and end) of every block that does not fall apart
    for begin, end in zip(edges[:-1], edges[1:], strict=True):
        squares = dqds((a[begin:end] ** 2).tolist(), (b[begin : end - 1] ** 2).tolist())
        pairs += [(value, begin, end) for value in squares]
    pairs.sort(key=lambda pair: -pair[0])
    pairs = [p for p in pairs[:count] if p[0] > (len(a) * _EPS) ** 2]
    z = np.zeros((len(a), len(pairs)))
    for j, (value, begin, end) in enumerate(pairs):
        # Values next to each other in one block: other twists span the same space.
        near = [i for i in range(j) if pairs[i][1] == begin and abs(pairs[i][0] - value) <= 1e-8 * value]
        for skip in range(end - begin):
            x = twisted_vector(a[begin:end] ** 2, b[begin : end - 1] / a[begin : end - 1], value, skip)
            z[begin:end, j] = x
            for _ in range(2):
                for i in near:
                    z[:, j] -= z[:, i] * (z[:, i] @ z[:, j])
            size = float(np.linalg.norm(z[:, j]))
            if size > 0.1 or not near:
                break
        z[:, j] /= max(size, 1e-300)
    return np.array([p[0] for p in pairs]) * total, v @ z, total


# --- the passes over the vectors ------------------------------------------------------------------


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): floor(256 * entry) of the vectors that can be used, as lists of longs."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where("size(v) > 0")
    usable = F.forall("v", lambda c: F.coalesce(F.abs(c) < 2.0**36, F.lit(False)))
    rows = rows.where(usable).select("vec_id", F.transform("v", lambda c: F.floor(c * 256).cast("long")).alias("x"))
    return rows


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of equal length as rows of a matrix."""
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def _square(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data, float)
    return flat.reshape(math.isqrt(len(flat)), -1)


def triangular_factor(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all rows of ``fit`` (x) minus ``mean``."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, len(mean)))
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                rows = _matrix(batch.slice(begin, BLOCK).column("x")) - mean
                factor = np.linalg.qr(np.vstack([factor, rows]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_arrays([pa.array([_padded(factor).tobytes()], pa.binary())], names=["factor"])

    def join(table: pa.Table) -> pa.Table:
        stacked = np.vstack([_square(f) for f in table.column("factor").to_pylist()])
        return pa.table({"factor": pa.array([_padded(np.linalg.qr(stacked, mode="r")).tobytes()], pa.binary())})

    factors = written_once(fit.select("x").mapInArrow(reduce, "factor binary"), "factors")
    while (n := factors.count()) > 1:
        dealt = factors.withColumn("part", F.pmod(F.xxhash64("factor"), F.lit(math.ceil(n / FAN_IN))))
        factors = written_once(dealt.groupBy("part").applyInArrow(join, "factor binary"), "factors")
    return _square(factors.first()["factor"])


def _padded(factor: np.ndarray) -> np.ndarray:
    """Square, with rows of zeros below."""
    return np.vstack([factor, np.zeros((factor.shape[1] - len(factor), factor.shape[1]))])


def _identity_error(fit: DataFrame, mean: np.ndarray, scaled: np.ndarray, n: int) -> float:
    """The largest absolute entry of the covariance of the whitened rows of ``fit`` minus the identity."""
    k = scaled.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k + k * k)
        for batch in batches:
            w = (_matrix(batch.column("x")) - mean) @ scaled
            sums += np.concatenate([w.sum(0), (w.T @ w).reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["place", "part"])

    parts = fit.select("x").mapInArrow(measure, "place long, part double").groupBy("place").agg(F.sum("part").alias("part"))
    sums = np.zeros(k + k * k)
    for row in parts.collect():
        sums[row["place"]] = row["part"]
    centre = sums[:k] / n
    covariance = sums[k:].reshape(k, k) / n - np.outer(centre, centre)
    return float(np.abs(covariance - np.eye(k)).max())


WHITENED = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding) and component.

    Columns: vec_id, component, n (distinct vectors), deviation (sum of (n * x - S)^2, exact), whitened, explained
    (the component's share of the variance), identity_error.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = WHITENED.format(id=kind)
    rows = whole_numbers(vectors)
    widths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not widths:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == widths[0]["d"])
    fit = written_once(rows.select("x").distinct(), "fit")
    n = fit.count()
    sums = fit.select(F.posexplode("x").alias("place", "x")).groupBy("place").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.max(F.abs("x")).alias("most")
    )
    sums = {r["place"]: (int(r["s"]), r["most"]) for r in sums.collect()}  # one row per dimension
    total = [sums[i][0] for i in range(len(sums))]
    mean = np.array([s / n for s in total])  # of whole numbers, correctly rounded
    values, directions, trace = leading_directions(triangular_factor(fit, mean), components)
    if not len(values):
        return spark.createDataFrame([], schema)
    scaled = directions / np.sqrt(values / n)
    error = _identity_error(fit, mean, scaled, n)
    largest = max(n * sums[i][1] + abs(total[i]) for i in range(len(total)))
    narrow = largest**2 * len(total) < 2**63
    shift = np.array(total, np.int64 if narrow else object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                x = _matrix(part.column("x"))
                whitened = (x - mean) @ scaled
                off = (n * x.astype(shift.dtype) - shift) ** 2
                deviation = off.sum(1).tolist()
                deviation = pa.array([d if d < 2**63 else None for d in deviation], pa.int64())
                each = pa.array(np.repeat(np.arange(part.num_rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                        pa.array(np.full(part.num_rows * k, n, np.int64)),
                        deviation.take(each),
                        pa.array(whitened.reshape(-1)),
                        pa.array(np.tile(values / trace, part.num_rows)),
                        pa.array(np.full(part.num_rows * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)
