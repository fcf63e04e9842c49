"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors become whole numbers, each distinct one counts once. Number, sums and scatter are reductions in Spark. The scatter
V = P L L' P' is factored with the largest remaining diagonal first; plane rotations from the right make the columns of L
orthogonal; then their squared norms are the eigenvalues of V, and the columns over their norms its eigenvectors.

Scale: vectors are made distinct with map-side combining, so a vector that a third of all rows share is one row a task. Each
task adds up its own scatter; what meets are dims * dims / 2 sums a task. The driver factors one matrix of dims * dims
numbers, whose size depends on the vectors' length alone; the tasks get four components of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import dropped, map_arrow, settled, table

#: Fixed by the contract: steps of a unit, components given out.
STEPS, COMPONENTS = 256, 4
#: Largest whole numbers that are handled without Python's own.
PLAIN = 2**62


class Whitening(NamedTuple):
    """n vectors with sums S; columns of ``axes`` are unit eigenvectors of their covariance, by falling eigenvalue."""

    n: int
    sums: list[int]
    axes: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = max(int(np.abs(x).max(initial=0)), 1) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < PLAIN else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x).astype(np.float64) / self.n) @ self.axes / np.sqrt(self.eigenvalues)


def whole_numbers(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows remain, the lengths of their vectors, and their entries floor(256 * c), one vector after the other."""
    lists = batch.column(column)
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
    with np.errstate(over="ignore"):
        x = np.floor(entries * STEPS)
    bad = np.bincount(row[~(np.abs(x) < 2.0**63)], minlength=len(sizes)) > 0
    keep = (sizes >= 0) & ~bad
    return keep, sizes[keep], x[keep[row]].astype(np.int64)


def _integers(vectors: DataFrame, column: str) -> DataFrame:
    """x: the remaining rows' whole numbers."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            _, sizes, x = whole_numbers(batch, column)
            at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(at), pa.array(x))], ["x"])

    return map_arrow(vectors.select(column), run, "x array<long>")


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def _moments(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors, and the exact sum of each dimension."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for batch in parts:
            x = _matrix(batch, dims)
            n += len(x)
            high, low = (x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)
            sums = [s + (int(a) << 31) + int(b) for s, a, b in zip(sums, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([n] * dims, pa.int64()), pa.array(range(dims), pa.int32()), pa.array(map(str, sums), pa.string())], ["n", "i", "s"])

    found = map_arrow(fit, run, "n long, i int, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return found[0].n, [int(r.s) for r in found]


def _covariance(fit: DataFrame, plain: Whitening) -> np.ndarray:
    """Covariance of the fit list, centred exactly before anything is multiplied."""
    dims = plain.dims
    a, b = np.triu_indices(dims)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in parts:
            y = plain.centred(_matrix(batch, dims)).astype(np.float64) / plain.n
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[a, b])], ["i", "j", "v"])

    out = np.zeros((dims, dims))
    for i, j, v in map_arrow(fit, run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = out[j, i] = v / plain.n
    return out


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """order and L with matrix[order][:, order] = L @ L.T, L lower triangular with one column for each rank."""
    rest, dims = matrix.astype(np.float64), len(matrix)
    order, low = np.arange(dims), np.zeros_like(rest)
    least = dims * np.finfo(float).eps * max(rest.diagonal().max(initial=0), 0)
    for k in range(dims):
        p = k + int(rest.diagonal()[k:].argmax())
        if rest[p, p] <= least:
            return order, low[:, :k]
        swap = [p, k]
        order[[k, p]] = order[swap]
        rest[[k, p]] = rest[swap]
        rest[:, [k, p]] = rest[:, swap]
        low[[k, p]] = low[swap]
        low[k, k] = np.sqrt(rest[k, k])
        low[k + 1 :, k] = rest[k + 1 :, k] / low[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return order, low


def one_sided_jacobi(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The matrix times rotations that make its columns orthogonal. Disjoint pairs of columns are rotated together; each round
    pairs every column with another one, as in a tournament."""
    columns = low.shape[1] + low.shape[1] % 2
    work = np.zeros((columns, low.shape[0]))  # a row for each column, one of zeros if their number is odd
    work[: low.shape[1]] = low.T
    seat = np.arange(columns)
    for _ in range(sweeps):
        turned = False
        for _ in range(max(columns - 1, 0)):
            a, b = seat[: columns // 2], seat[columns // 2 :][::-1]
            x, y = work[a], work[b]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if turn.any():
                turned = True
                safe = np.where(turn, xy, 1.0)
                zeta = (yy - xx) / (2 * safe)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)[:, None]
                s = np.where(turn, t, 0.0)[:, None] * c
                work[a], work[b] = c * x - s * y, s * x + c * y
            seat = np.concatenate([seat[:1], seat[-1:], seat[1:-1]])
        if not turned:
            break
    return work[: low.shape[1]].T


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues, falling, and unit eigenvectors as columns, each with its largest entry above zero."""
    order, low = pivoted_cholesky(matrix)
    turned = one_sided_jacobi(low)
    norms = np.sqrt((turned * turned).sum(axis=0))
    axes = np.zeros_like(turned)
    axes[order] = turned / norms
    rank = np.argsort(-norms, kind="stable")
    axes = axes[:, rank]
    if axes.size:
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return norms[rank] ** 2, axes


def fit_list(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """Settled distinct x of the vectors of one length, and that length: the commonest among distinct vectors, of ties the longest."""
    fit = settled(_integers(vectors, column).distinct())
    size = fit.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return fit.filter(F.size("x") == (size.size if size else 0)), size.size if size else 0


def learn(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """None where no direction has a spread: no vectors, or a single distinct one."""
    if not dims:
        return None
    n, sums = _moments(fit, dims)
    cov = _covariance(fit, Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0))
    values, axes = eigen(cov)
    return Whitening(n, sums, axes[:, :components], values[:components], float(np.trace(cov))) if len(values) else None


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.eigenvalues)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            w = model.whitened(_matrix(batch, model.dims))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(w[:, i])) for i in range(k)], [f"w{i}" for i in range(k)])

    rows = map_arrow(fit, run, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining row and component: the id, component, n, deviation, whitened, explained, identity_error.

    Dropped: null vectors; vectors with a null, an infinite entry or NaN, or one whose whole number is no long; vectors of
    another length than the commonest one among distinct vectors. Equal rows count once in the fit and have results of their own. With
    fewer directions of spread than ``components`` there are fewer rows; none with a single distinct vector or an empty
    table. A deviation that is no long is null. Null ids are kept, extra columns ignored.
    """
    fit, dims = fit_list(vectors, column)
    model = learn(fit, dims, components)
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None:
        dropped(fit)
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, model), len(model.eigenvalues)
    dropped(fit)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keep, sizes, entries = whole_numbers(batch, column)
            x = entries[np.repeat(sizes == model.dims, sizes)].reshape(-1, model.dims)
            rows = np.flatnonzero(keep)[sizes == model.dims]
            y = model.centred(x)
            if int(np.abs(y).max(initial=0)) ** 2 * model.dims >= PLAIN:
                y = y.astype(object)
            far = [d if d < 2**63 else None for d in (y * y).sum(axis=1).tolist()]
            ids = batch.column(id_column).take(pa.array(np.repeat(rows, k)))
            columns = [
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, model.n, np.int64)), pa.array([d for d in far for _ in range(k)], pa.int64()),
                pa.array(model.whitened(x).reshape(-1)), pa.array(np.tile(model.eigenvalues / model.trace, len(x))), pa.array(np.full(len(x) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(vectors.select(id_column, column), run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
