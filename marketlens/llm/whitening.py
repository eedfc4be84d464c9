"""Embedding whitening by pivoted Cholesky and one-sided Jacobi (operator 11).

Vectors become integers first (floor(64 c) + 1000000), so that counts, sums and the scatter matrix are exact and don't
depend on how rows are dealt to tasks. The fit list holds each distinct vector once. Its centred scatter is summed by
tasks: each centres its rows by the whole part of the mean before multiplying, and what the fractions add is taken away
exactly in integers. The scatter, as large as the dimension squared, is factored on the driver: a Cholesky factor with
diagonal pivoting, whose columns are then rotated against each other until all are orthogonal (one-sided Jacobi, no
product of the factor with itself is formed). The rotated columns' squared norms are the eigenvalues, the normalised
columns the components.

Edge cases: rows with a null vector, or null, non-finite or huge entries (2^50 and up, which the integers don't hold),
are dropped; so are rows of another length than the most frequent one (of equally frequent ones the longest). Null and
repeated ids are rows like others; repeated vectors count once in the fit. Components without variance (of a pivot
under the rounding error of the first) have no whitened value and are left out, so an empty table, a single distinct
vector and vectors of no entries give no rows. A deviation beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.vectors import ROWS, decimals, exact_gram, exact_squares, longs, matrix, scaled, slabs, whole
from marketlens.session import cut_lineage

# The integers that entries become.
FACTOR, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rotations stop when no two columns have a cosine above this; rarely more than ten sweeps are needed.
ORTHOGONAL, SWEEPS = 2.0 ** -52, 60


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): a[order][:, order] = L L^T, the largest remaining diagonal entry taken each time. L has as many columns
    as pivots stay above the rounding error of the first."""
    a = np.array(a, np.float64)
    p = len(a)
    order, factor, rest = np.arange(p), np.zeros((p, p)), np.diag(a).copy() if p else np.zeros(0)
    least = p * 2.0 ** -52 * (rest.max() if p else 0.0)
    for k in range(p):
        at = k + int(np.argmax(rest[k:]))
        if not rest[at] > least:
            return factor[:, :k], order
        if at != k:
            for m in (a, factor):
                m[[k, at]] = m[[at, k]]
            a[:, [k, at]] = a[:, [at, k]]
            rest[[k, at]], order[[k, at]] = rest[[at, k]], order[[at, k]]
        factor[k, k] = np.sqrt(rest[k])
        factor[k + 1:, k] = (a[k + 1:, k] - factor[k + 1:, :k] @ factor[k, :k]) / factor[k, k]
        rest[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def _rounds(n: int):
    """Disjoint pairs in n - 1 rounds (n even): every pair of columns meets once in a sweep."""
    seats = np.arange(n)
    for _ in range(n - 1):
        yield seats[:n // 2].copy(), seats[::-1][:n // 2].copy()
        seats[1:] = np.roll(seats[1:], 1)


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns after plane rotations from the right that make them orthogonal, by falling norm."""
    p, r = factor.shape
    m = np.zeros((r + r % 2, p))                         # columns as rows; an odd one out plays against zeros
    m[:r] = factor.T
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in _rounds(len(m)):
            x, y = m[i], m[j]
            xx, yy, xy = (np.einsum("ij,ij->i", *q) for q in ((x, x), (y, y), (x, y)))
            size = np.sqrt(xx * yy)
            cosine = np.abs(xy) / np.where(size > 0, size, 1.0)
            worst = max(worst, float(cosine.max(initial=0.0)))
            turn = cosine > ORTHOGONAL
            if not turn.any():
                continue
            x, y, xx, yy, xy = x[turn], y[turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2.0 * xy)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1.0 / np.hypot(1.0, t)
            s = c * t
            m[i[turn]] = c[:, None] * x - s[:, None] * y
            m[j[turn]] = s[:, None] * x + c[:, None] * y
        if worst <= p * ORTHOGONAL:
            break
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))
    return m[np.argsort(-norms, kind="stable")[:r]].T


@dataclasses.dataclass(frozen=True)
class Whitening:
    """A fit: count and sums of the distinct vectors, eigenvalues, components as columns, trace, and the measured error."""

    width: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        top = max([abs(v) for v in self.sums] + [self.n * (int(np.abs(x).max()) if x.size else 0)])
        kind = np.int64 if top < 1 << 62 else object
        return x.astype(kind) * (self.n if kind is object else np.int64(self.n)) - np.array(self.sums, kind)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ (self.components / np.sqrt(self.eigenvalues))


def integer_vectors(df: DataFrame, vector: str = "embedding", *keep: str) -> tuple[DataFrame, int]:
    """(the kept columns and x of the rows with a whole vector of the most frequent length, that length)."""
    rows = df.where(whole(vector))
    found = rows.groupBy(F.size(F.col(vector)).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = found["width"] if found else 0
    return rows.where(F.size(F.col(vector)) == width).select(*keep, scaled(vector, FACTOR, SHIFT).alias("x")), width


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Count and sums of the entries."""

    def add(batches):
        n, total = 0, np.zeros(width, object)
        for b in slabs(batches):
            x = matrix(b.column(0), width)
            n += len(x)
            top = int(np.abs(x).max()) if x.size else 0
            total += x.sum(axis=0).astype(object) if top * len(x) < 1 << 63 else x.astype(object).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), decimals([n, *total])], ["i", "v"])

    got = {r["i"]: int(r["v"]) for r in fit.mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(width)]


def _scatter(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the fit list: the exact centred scatter over n, rounded once."""
    width = len(sums)
    middle = np.array([s // n for s in sums], np.int64)   # the whole part of the mean
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    rows, cols = np.triu_indices(width)

    def add(batches):
        total = np.zeros((width, width), object)
        for b in slabs(batches):
            total = total + exact_gram(matrix(b.column(0), width) - middle)
        for i in range(0, len(rows), 100_000):
            r, c = rows[i:i + 100_000], cols[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(c, pa.int32()), decimals(total[r, c])], ["i", "j", "v"])

    got = fit.mapInArrow(add, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for r in got:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = (n * int(r["v"]) - rest[r["i"]] * rest[r["j"]]) / (n * n)
    return out


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, over all its rows."""
    k, width = len(model.eigenvalues), model.width

    def add(batches):
        total = np.zeros((k, k))
        for b in slabs(batches):
            w = model.whiten(model.centred(matrix(b.column(0), width)))
            total += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    got = fit.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    return max((abs(r["v"] / model.n - (r["i"] == r["j"])) for r in got), default=0.0)


def fit_whitening(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Fit over each distinct x once. The list is written once and read by three passes."""
    fit = cut_lineage(vectors.select("x").distinct())
    n, sums = _sums(fit, width)
    if not n:
        return Whitening(width, 0, tuple(sums), np.zeros(0), np.zeros((width, 0)), 0.0)
    covariance = _scatter(fit, n, sums)
    factor, order = pivoted_cholesky(covariance)
    columns = orthogonal_columns(factor)
    norms = np.sqrt(np.einsum("ij,ij->j", columns, columns))
    unit = np.zeros_like(columns)
    unit[order] = columns / norms
    k = min(components, len(norms))
    model = Whitening(width, n, tuple(sums), norms[:k] ** 2, unit[:, :k], float(np.trace(covariance)))
    return dataclasses.replace(model, identity_error=_identity_error(fit, model) if k else 0.0)


def whiten(df: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): each kept row's coordinate on each component."""
    rows, width = integer_vectors(df, vector, vec_id)
    model = fit_whitening(rows, width, components)
    schema = T.StructType([df.schema[vec_id], *T.StructType.fromDDL(
        "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")])
    k = len(model.eigenvalues)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    explained = model.eigenvalues / model.trace
    shared = df.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        m = shared.value
        for b in slabs(batches, ROWS // 4):
            d = m.centred(matrix(b.column(1), m.width))
            at, size = np.repeat(np.arange(len(d)), k), len(d) * k
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(d)), pa.int32()), pa.array(np.full(size, m.n), pa.int64()),
                 longs(exact_squares(d)).take(pa.array(at)), pa.array(m.whiten(d).ravel()), pa.array(np.tile(explained, len(d))),
                 pa.array(np.full(size, m.identity_error))], schema.names)

    return rows.mapInArrow(project, schema)
