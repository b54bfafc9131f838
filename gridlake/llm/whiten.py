"""Whitening of embedding vectors.

Vectors are put on a grid of whole numbers, and each distinct one counts once.
Tasks add up the vectors, then the products of the centred ones; the driver
holds these sums only, whose number is that of pairs of dimensions. The scatter is
factored by Cholesky with diagonal pivots, which ends where nothing but
rounding is left, and the columns of the triangular factor are rotated against
each other (one-sided Jacobi) until all are orthogonal: their squared norms
are the eigenvalues, and the columns over their norms the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lists, longs, store

#: steps of the grid in a unit
GRID = 256
COMPONENTS = 4
_EPS = float(np.finfo(np.float64).eps)
_MOST = np.iinfo(np.int64)


@dataclass
class Whitening:
    """What the fit list says: its size and sums, and the components (rows)
    with their eigenvalues by falling value."""
    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], dtype=np.float64)


def _on_grid(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a list column that are finite throughout, and their numbers
    on the grid: row places, flat numbers, number of them in each row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    value = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(length)), length)
    good = ~column.is_null().to_numpy(zero_copy_only=False) & (np.bincount(row, ~np.isfinite(value), len(length)) == 0)
    value = np.floor(value[good[row]] * GRID)
    x = np.clip(value, -2.0 ** 63, 2.0 ** 62).astype(np.int64)
    beyond = value > 2.0 ** 62
    x[beyond] = np.where(value[beyond] >= 2.0 ** 63, _MOST.max, np.minimum(value[beyond], 2.0 ** 63 - 1024).astype(np.int64))
    return np.flatnonzero(good), x, length[good]


def _matrices(batches, width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _grid_rows(vector: str):
    def run(batches):
        for batch in batches:
            _, x, length = _on_grid(batch.column(vector))
            yield pa.RecordBatch.from_pydict({"x": lists(longs(x), length)})
    return run


def _sums(width: int):
    """Per task: the number of vectors (place -1) and the sum of each dimension."""
    def run(batches):
        n, high, low = 0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for x in _matrices(batches, width):
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        total = [n] + [int(h) * (1 << 32) + int(v) for h, v in zip(high, low)]
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(-1, width), type=pa.int32()),
                                          "total": pa.array(total, type=pa.decimal128(38, 0))})
    return run


def _products(width: int, view, size: int):
    """Per task: the sums of ``view(x)`` and of the products of its columns,
    each pair once."""
    upper = np.triu_indices(size)

    def run(batches):
        s, p = np.zeros(size), np.zeros((size, size))
        for x in _matrices(batches, width):
            v = view(x)
            s += v.sum(0)
            p += v.T @ v
        flat = np.concatenate([s, p[upper]])
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(len(flat), dtype=np.int32)), "total": pa.array(flat)})
    return run


def _covariance(fit_list: DataFrame, width: int, n: int, view, size: int) -> np.ndarray:
    """Covariance, divisor n, of ``view(x)``, which is centred up to rounding."""
    got = fit_list.mapInArrow(_products(width, view, size), "place int, total double").groupBy("place").agg(
        F.sum("total").alias("total")).collect()
    flat = np.zeros(size + size * (size + 1) // 2)
    for r in got:
        flat[r.place] = r.total
    p = np.zeros((size, size))
    p[np.triu_indices(size)] = flat[size:]
    p = (p + np.triu(p, 1).T) / n
    rest = flat[:size] / n
    return p - np.outer(rest, rest)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """A factor f of full column rank with ``f @ f.T = a`` up to rounding; with
    its rows in the order of the pivots it is lower triangular."""
    d = len(a)
    rest, order = np.diag(a).copy(), np.arange(d)
    f = np.zeros((d, d))
    least = d * _EPS * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        j = k + int(np.argmax(rest[order[k:]]))
        order[k], order[j] = order[j], order[k]
        p, after = order[k], order[k + 1:]
        if not rest[p] > least:
            return f[:, :k]
        f[p, k] = np.sqrt(rest[p])
        f[after, k] = (a[after, p] - f[after, :k] @ f[p, :k]) / f[p, k]
        rest[after] -= f[after, k] ** 2
    return f


def one_sided_jacobi(f: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of f rotated until all pairs are orthogonal. A sweep meets
    every pair once, in rounds of disjoint pairs that turn at once."""
    f = f.copy()
    r = f.shape[1]
    ring = np.arange(r + r % 2)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            p, q = ring[:len(ring) // 2], ring[len(ring) // 2:][::-1]
            both = (p < r) & (q < r)
            p, q = p[both], q[both]
            a, b = f[:, p], f[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, off.max(initial=0.0))
            turn = off > _EPS
            safe = np.where(turn, ab, 1.0)
            zeta = (bb - aa) / (2 * safe)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            f[:, p], f[:, q] = c * (a - t * b), c * (t * a + b)
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if worst <= np.sqrt(len(f)) * _EPS:
            break
    return f


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling value and their unit vectors as rows, for the
    rank that rounding leaves; each vector's largest entry is positive."""
    f = one_sided_jacobi(pivoted_cholesky(covariance))
    norm = np.sqrt((f * f).sum(0))
    order = np.argsort(-norm, kind="stable")
    vectors = (f / norm)[:, order].T
    if len(vectors):
        vectors = vectors * np.where(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)] < 0, -1.0, 1.0)[:, None]
    return norm[order] ** 2, vectors


def fit(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the table's vectors; None if there is none to fit."""
    grid = embeddings.select(vector).mapInArrow(_grid_rows(vector), "x array<long>")
    listed = store(grid.distinct(), "fit-list")
    sizes = listed.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).filter("width > 0")
    most = sizes.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return None
    width = most.width
    listed = listed.filter(F.size("x") == width)
    got = {r.place: int(r.total) for r in listed.mapInArrow(_sums(width), "place int, total decimal(38,0)").groupBy("place").agg(
        F.sum("total").alias("total")).collect()}
    n, sums = got[-1], [got[i] for i in range(width)]
    mean = np.array([s / n for s in sums], dtype=np.float64)
    covariance = _covariance(listed, width, n, lambda x: x - mean, width)
    values, vectors = principal(covariance)
    model = Whitening(n, sums, values[:components], vectors[:components], float(np.trace(covariance)))
    k = len(model.values)
    if k:
        turned = model.vectors.T / np.sqrt(model.values)
        own = _covariance(listed, width, n, lambda x: (x - mean) @ turned, k)
        model.identity_error = float(np.abs(own - np.eye(k)).max())
    return model


def _whitened(model: Whitening, vector: str, vec_id: str):
    n, k, width = model.n, len(model.values), len(model.sums)
    mean, turned = model.mean, model.vectors.T / np.sqrt(model.values)
    wrapped = np.array([s & (1 << 64) - 1 for s in model.sums], dtype=np.uint64)

    def run(batches):
        for batch in batches:
            row, x, length = _on_grid(batch.column(vector))
            fits = length == width
            x = x[np.repeat(fits, length)].reshape(-1, width)
            row = np.repeat(row[fits], k)
            # exact modulo 2^64, so exact wherever the result is a long
            off = x.view(np.uint64) * np.uint64(n & (1 << 64) - 1) - wrapped
            deviation = (off * off).sum(1).view(np.int64)
            centred = x - mean
            too_large = ((centred * n) ** 2).sum(1) >= 2.0 ** 63
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(vec_id).cast(pa.int64()).take(pa.array(row)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "deviation": pa.array(np.repeat(deviation, k), mask=np.repeat(too_large, k)),
                "whitened": pa.array((centred @ turned).ravel()),
                "explained": pa.array(np.tile(model.values / model.trace, len(x)))})
    return run


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error
    for each usable row and component.

    Numbers are ``floor(GRID * entry)``; the fit list holds each distinct
    vector once, and everything is measured over it.

    * a null vector, or one with a null, NaN or infinite entry: no row, not in
      the fit list; an empty vector neither;
    * vectors of another length than most distinct ones have (the longer in a
      tie): no row, not in the fit list;
    * null vec_id: returned as any other; repeated rows: each returned;
    * components without variance have no whitened values and are not
      returned: none at all if all vectors are alike;
    * a deviation that no long holds is null; grid numbers end at the limits
      of a long;
    * extra columns are not read; an empty table gives an empty result.
    """
    schema = "vec_id long, component int, deviation long, whitened double, explained double"
    rows = embeddings.select(vec_id, vector)
    model = fit(rows, vector, components)
    if model is None or not len(model.values):
        out, n, error = embeddings.sparkSession.createDataFrame([], schema), 0, 0.0
    else:
        out, n, error = rows.mapInArrow(_whitened(model, vector, vec_id), schema), model.n, model.identity_error
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
                      F.lit(error).cast("double").alias("identity_error"))
