"""Embedding whitening: a distributed centred covariance, its leading eigenvectors, and the projection of every row.

The covariance is a square matrix of the vectors' length, whatever the number of rows; only it reaches the driver. There Householder
reflections make it tridiagonal, Sturm counts bracket its leading eigenvalues by bisection, and inverse iteration
gives their vectors, which are made orthogonal again within clusters of close eigenvalues.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import stored
from inventrace.llm.vectors import gridded, lists, matrix, norms, reach

#: Partial matrices that one task adds up before they are added up by matrix row alone.
FAN = 64
#: Eigenvalues closer than this share of the largest are a cluster, whose vectors are kept orthogonal.
CLUSTER = 1e-3
#: Entries of a vector that a Python step holds as one matrix.
SLICE_VALUES = 1 << 20

SQUARES = pa.decimal128(38, 0)


# --- the leading eigenvectors of a symmetric matrix -----------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of the tridiagonal matrix that Householder reflections make of ``a``.

    Reflector k is a unit vector over the places from k + 1 on, or empty where nothing has to be cleared.
    """
    a = np.array(a, np.float64)
    reflectors = []
    for k in range(len(a) - 2):
        column = a[k + 1 :, k]
        if not column[1:].any():
            reflectors.append(np.zeros(0))
            continue
        v = column / np.abs(column).max()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        reflectors.append(v)
        a[k + 1 :, k:] -= 2.0 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are smaller than each number of ``at`` (a Sturm count)."""
    tiny = np.finfo(np.float64).tiny / np.finfo(np.float64).eps
    squares = np.concatenate([[0.0], off * off])
    pivot, count = np.ones_like(at), np.zeros(len(at), np.int64)
    for d, s in zip(diagonal, squares, strict=True):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of the tridiagonal matrix, falling, by bisection until the brackets cannot be halved."""
    n = len(diagonal)
    around = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    wide = max(float(np.abs(diagonal).max() + around.max()), np.finfo(np.float64).tiny)
    low, high = np.full(k, -1.001 * wide), np.full(k, 1.001 * wide)
    rank = n - 1 - np.arange(k)  # the place of each in rising order
    while True:
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= np.finfo(np.float64).eps * wide / 16)):
            return middle
        right = below(diagonal, off, middle) <= rank
        low, high = np.where(right, middle, low), np.where(right, high, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, small: float):
    """Solves (T - shift) y = b by elimination with row exchanges; pivots of zero become ``small``."""
    n = len(diagonal)
    first, second, third = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    factor, swap = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        lower = off[i]
        if abs(lower) > abs(first[i]):
            swap[i] = True
            factor[i] = first[i] / lower
            first[i], old = lower, second[i]
            second[i], third[i] = first[i + 1], second[i + 1]
            first[i + 1], second[i + 1] = old - factor[i] * second[i], -factor[i] * third[i]
        else:
            if abs(first[i]) < small:
                first[i] = small
            factor[i] = lower / first[i]
            first[i + 1] -= factor[i] * second[i]
    if abs(first[-1]) < small:
        first[-1] = small

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i in range(n - 1):
            if swap[i]:
                y[i], y[i + 1] = y[i + 1], y[i] - factor[i] * y[i + 1]
            else:
                y[i + 1] -= factor[i] * y[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                y[i] -= second[i] * y[i + 1]
            if i + 2 < n:
                y[i] -= third[i] * y[i + 2]
            y[i] /= first[i]
        return y

    return solve


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a row, of falling eigenvalues; within a cluster each is kept orthogonal to those before it."""
    n = len(diagonal)
    wide = max(float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)), np.finfo(np.float64).tiny)
    small = np.finfo(np.float64).eps * wide
    found: list[np.ndarray] = []
    begin = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * wide:
            begin = k
        # Equal eigenvalues are moved apart by rounding size, so that their systems differ.
        solve = _solver(diagonal, off, value - (k - begin) * 2 * small, small)
        y = np.random.default_rng(k).uniform(0.5, 1.0, n) * np.where(np.arange(n) % (k + 2) == k % 2, -1.0, 1.0)
        for _ in range(6):
            y = solve(y / np.linalg.norm(y))
            for other in found[begin:k] * 2:
                y -= (other @ y) * other
            y /= np.linalg.norm(y)
        found.append(y)
    return np.array(found).reshape(len(values), n)


def eigen(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the ``k`` largest eigenvalues, falling; their unit eigenvectors, one a row) of a symmetric matrix.

    Of the two signs of a vector the one is taken whose entry of largest size (the first of equals) is positive.
    """
    size = float(np.abs(a).max(initial=0.0))
    k = min(k, len(a))
    if not size:
        return np.zeros(k), np.eye(len(a))[:k]
    diagonal, off, reflectors = tridiagonal(a / size)
    values = leading(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        if len(v):
            vectors[:, at + 1 :] -= 2.0 * np.outer(vectors[:, at + 1 :] @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    largest = np.argmax(np.abs(vectors), axis=1)
    vectors *= np.sign(vectors[np.arange(k), largest])[:, None]
    return values * size, vectors


# --- sums over all vectors ------------------------------------------------------------------------------------------


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """(number of vectors, their exact sum by dimension)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(size, object)
        for batch in batches:
            x = matrix(batch.column("x"), size)
            count += len(x)
            total = total + (x.sum(axis=0) if reach(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)).astype(object)
        if count:
            at = pa.array(range(-1, size), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([Decimal(count), *(Decimal(int(t)) for t in total)], SQUARES)], ["at", "v"])

    parts = fit.select("x").mapInArrow(run, "at int, v decimal(38,0)")
    found = {r["at"]: int(r["v"]) for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(size)]


def _chunks(x: np.ndarray) -> Iterator[np.ndarray]:
    step = max(1, SLICE_VALUES // max(x.shape[1], 1))
    for at in range(0, len(x), step):
        yield x[at : at + step]


def _covariance(fit: DataFrame, size: int, n: int, mean: np.ndarray) -> np.ndarray:
    """Covariance of the vectors, divisor ``n``, each centred before it is multiplied.

    Every task adds up one matrix; its rows are added up by (row, group of tasks) and then by row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            for x in _chunks(matrix(batch.column("x"), size)):
                centred = x - mean
                total += centred.T @ centred
                seen = True
        if seen:
            task = pa.array(np.full(size, TaskContext.get().partitionId() % FAN, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), task, lists(total)], ["at", "fan", "v"])

    def add(table: pa.Table) -> pa.Table:
        row = matrix(table.column("v").combine_chunks(), size).sum(axis=0)
        return table.slice(0, 1).set_column(2, "v", lists(row[None, :]))

    kind = "at int, fan int, v array<double>"
    parts = fit.select("x").mapInArrow(run, kind)
    rows = parts.groupBy("at", "fan").applyInArrow(add, kind).groupBy("at").applyInArrow(add, kind).collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["at"]] = r["v"]
    return (out + out.T) / (2 * n)


@dataclass(frozen=True)
class Whitening:
    """A fitted projection: ``n`` vectors with sums ``sums``; ``vectors`` by falling ``values``, of a covariance with trace ``trace``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s / self.n for s in self.sums])) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over dimensions of (n * x - sum) squared."""
        if self.n * reach(x) + reach(np.array(self.sums, object)) < 1 << 62:
            return [int(v) for v in norms(self.n * x - np.array(self.sums, np.int64))]
        wide = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (wide * wide).sum(axis=1)]


def fit(vectors: DataFrame, size: int, components: int = 4) -> Whitening | None:
    """The whitening of the distinct grid vectors (column ``x``, ``size`` longs each); None without vectors.

    Components whose eigenvalue is zero up to rounding have no unit scale and are left out, so there may be fewer than asked for.
    Copies are dropped before the shuffle, so a vector that many rows share costs no more than others.
    """
    distinct = stored(vectors.select("x").distinct(), "whitening")
    n, sums = _sums(distinct, size)
    if not n or not size:
        return None
    covariance = _covariance(distinct, size, n, np.array([s / n for s in sums]))
    trace = float(np.trace(covariance))
    values, found = eigen(covariance, components)
    kept = values > 16 * size * np.finfo(np.float64).eps * max(trace, np.finfo(np.float64).tiny)
    model = Whitening(n, tuple(sums), values[kept], found[kept], trace, 0.0)
    k = len(model.values)
    if not k:
        return model
    w = _projected(distinct, model).select(*[F.col("w")[i].alias(f"w{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = w.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return Whitening(model.n, model.sums, model.values, model.vectors, trace, float(error))


def _projected(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` with w, the whitened vector of x, and deviation; null where 38 digits cannot hold it."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            step = max(1, SLICE_VALUES // model.size)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = matrix(part.column("x"), model.size)
                exact = [Decimal(d) if d < 10**38 else None for d in model.deviations(x)]
                columns = [part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, lists(model.project(x)), pa.array(exact, SQUARES)], [*part.schema.names, "w", "deviation"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, w array<double>, deviation decimal(38,0)")


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """row (all columns of ``df``), component (from 1), whitened, and of the fit n, deviation, explained, identity_error.

    One output row per input row with a whole vector and component; the fit takes each distinct grid vector once. Rows whose vector is
    null, or holds null or non-finite entries, and rows of another length than most (see :func:`vectors.gridded`) take no part. Repeated rows
    each get theirs. Components without variance are left out; a table without any (empty, one vector, all equal) gives no rows.
    Columns of ``df`` may have any names: they come back inside ``row``.
    """
    kind = "struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in df.schema.fields) + ">"
    boxed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{vector_col}`").alias("vector"))
    rows, size = gridded(boxed, "vector")
    rows = rows.drop("vector")
    model = fit(rows, size, components)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], f"row {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    part = F.col("component")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    spread = _projected(rows, model).select("row", "deviation", F.posexplode("w").alias("at", "whitened")).withColumn("component", F.col("at") + 1)
    return spread.select(
        "row", part, F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", _at(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error")
    )


def _at(values: Column, place: Column) -> Column:
    return F.get(values, place)
