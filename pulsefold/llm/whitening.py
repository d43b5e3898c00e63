"""Whitening of embeddings by shifted CholeskyQR: passes over the rows, never an eigenproblem of the rows themselves.

Each vector c becomes the integers x = floor(scale * c) + offset; the fit list holds each distinct x once. With A the
centred fit list, a pass sums the Gram matrix of Q = A R1^-1 R2^-1 ... (by triangular solves on the rows of a batch),
and its Cholesky factor becomes the next R. The first pass adds the shift that lets the factor exist however badly A is
conditioned; the later ones bring Q to orthonormal columns. The composed R has the singular values and right vectors of
A, which its SVD (dimension x dimension) gives. What meets on the driver is as large as that matrix, whatever the rows.

Centring is done on integers, (n * x - S) / n, so it loses nothing before the division.

Defined results: rows whose vector is null or holds null or non-finite entries go; so do vectors of another length than
the commonest one of the fit list (ties: the longer). Repeated rows are answered each and count once in the fit. An empty
table, or a fit list without any spread, gives no rows. Components without variance (constant or dependent dimensions)
are left out, so there may be fewer than asked for. Equal eigenvalues are numbered in the order of the SVD. Entries of
2^45 or more raise an error, as does a deviation beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import own_columns, stored
from pulsefold.llm.texts import lists

EPS = float(np.finfo(np.float64).eps) / 2


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    offset: int = 0
    components: int = 4
    passes: int = 6


@dataclass(frozen=True)
class Whitening:
    """n and the integer sums S of the fit list, its variances and components (dimensions x components)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the rows whose vector is neither null nor empty and all finite, the lengths of these, and their entries as
    doubles end to end."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    length = np.where(valid, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    ends = np.cumsum(length)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = valid & (length > 0) & (bad[ends] == bad[ends - length])
    return np.flatnonzero(good), length[good], values[np.repeat(good, length)]


def on_grid(values: np.ndarray, settings: Settings) -> np.ndarray:
    scaled = np.floor(values * settings.scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0**45:
        raise OverflowError("entries of 2^45 or more after scaling are not supported")
    return scaled.astype(np.int64) + settings.offset


def fit_list(embeddings: DataFrame, settings: Settings) -> DataFrame:
    """Each distinct vector of integers once: x, length."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            _, length, values = usable(batch.column(0))
            yield pa.RecordBatch.from_arrays([lists(on_grid(values, settings), length)], ["x"])

    return own_columns(embeddings, "embedding").mapInArrow(run, "x array<long>").distinct().withColumn("length", F.size("x"))


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of every dimension."""
    def run(batches):
        n, sums = 0, [0] * d
        for batch in batches:
            x = matrix(batch.column(0), d)
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, x.sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(s) for s in sums])], ["dim", "n", "s"])

    rows = fit.select("x").mapInArrow(run, "dim int, n long, s string").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("dim").collect()
    return (int(rows[0]["n"]), [int(r["s"]) for r in rows]) if rows else (0, [0] * d)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where that holds it, else Python integers."""
    s = np.array(sums, dtype=object)
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if largest < 2**62:
        return n * x - s.astype(np.int64)
    return x.astype(object) * n - s


def solve_upper(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q with Q R = rows, column by column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram(fit: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of the outer products of `of(x)`: partial sums by task, added row by row of the matrix."""
    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            q = of(matrix(batch.column(0), d))
            total += q.T @ q
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([part] * size, pa.int32()), lists(total.ravel(), np.full(size, size))], ["row", "part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part").combine_chunks()
        sums = matrix(table.column("sums").combine_chunks(), size).sum(0)
        return pa.table({"row": table.column("row")[:1], "sums": lists(sums, np.array([size]))})

    rows = fit.select("x").mapInArrow(run, "row int, part int, sums array<double>").groupBy("row").applyInArrow(
        add, "row int, sums array<double>").collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["row"]] = r["sums"]
    return (out + out.T) / 2


def upper(g: np.ndarray, shift: float, least: float) -> np.ndarray:
    """R with R'R = g + shift I; a larger shift where that is not positive definite."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, least)


def fitted(embeddings: DataFrame, settings: Settings = Settings()) -> Whitening | None:
    """The whitening of `embeddings` (embedding); None where the fit list has no spread."""
    fit = stored(fit_list(embeddings, settings), "fit-list")
    length = fit.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    if length is None:
        return None
    d = length["length"]
    fit = fit.where(F.col("length") == d)
    n, sums = totals(fit, d)
    factors: list[np.ndarray] = []

    def orthogonal(x):
        q = deviations(x, n, sums).astype(np.float64) / n
        for factor in factors:
            q = solve_upper(q, factor)
        return q

    for k in range(settings.passes):
        g = gram(fit, d, orthogonal, d)
        if not g.any():
            return None
        if k and np.abs(g - np.eye(d)).max() <= 64 * d * EPS:
            break
        # The bound of the rounding errors of the Gram matrix and its factor.
        shift = 11 * (n * d + d * (d + 1)) * EPS * np.linalg.norm(g, 2)
        factors.append(upper(g, shift if k == 0 else 0.0, shift))
    else:
        g = gram(fit, d, orthogonal, d)
    # What is left of Q'Q: the identity but for rounding, or a projection where A has not full rank.
    e, u = np.linalg.eigh(g)
    r = (u * np.sqrt(np.maximum(e, 0))) @ u.T
    for factor in reversed(factors):
        r = r @ factor
    _, s, vt = np.linalg.svd(r)
    kept = int(min(settings.components, (s > s[0] * 8 * max(n, d) * EPS).sum()))
    values, vectors = s[:kept] ** 2 / n, vt[:kept].T.copy()

    def ones_and_whitened(x):
        w = whitened(x, n, sums, values, vectors)
        return np.column_stack([w, np.ones(len(w))])

    g = gram(fit, d, ones_and_whitened, kept + 1)
    mean = g[:kept, kept] / n
    error = np.abs(g[:kept, :kept] / n - np.outer(mean, mean) - np.eye(kept)).max()
    return Whitening(n, sums, values, vectors, float((s**2).sum() / n), float(error))


def whitened(x: np.ndarray, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (deviations(x, n, sums).astype(np.float64) / n) @ vectors / np.sqrt(values)


def whiten(embeddings: DataFrame, settings: Settings = Settings(), fit: Whitening | None = None) -> DataFrame:
    """For every usable row of `embeddings` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened,
    explained, identity_error. `fit` applies a whitening found before."""
    rows = own_columns(embeddings, "vec_id", "embedding")
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = fit or fitted(embeddings, settings)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    d, k = fit.vectors.shape

    def run(batches):
        for batch in batches:
            at, length, values = usable(batch.column(1))
            same = length == d
            x = on_grid(values[np.repeat(same, length)], settings).reshape(-1, d)
            if not len(x):
                continue
            away = deviations(x, fit.n, fit.sums)
            if away.dtype != object and d * int(np.abs(away).max()) ** 2 >= 2**63:
                away = away.astype(object)
            far = (away * away).sum(1)
            ids = batch.column(0).take(pa.array(np.repeat(at[same], k)))
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)),
                pa.array([int(v) for v in np.repeat(far, k)] if far.dtype == object else np.repeat(far, k), pa.int64()),
                pa.array(whitened(x, fit.n, fit.sums, fit.values, fit.vectors).ravel()),
                pa.array(np.tile(fit.values / fit.trace, m)), pa.array(np.full(m * k, fit.identity_error))], names)

    return rows.mapInArrow(run, schema)
