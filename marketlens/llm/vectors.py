"""Vector columns as integer matrices, for operators whose sums must not depend on how rows are dealt."""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entries of this size or more don't fit the integers below and count as not finite.
MOST = 2.0 ** 50
#: Rows of a batch that are worked on at once.
ROWS = 8_192


def whole(vector: str | Column) -> Column:
    """True where a vector is there and all its entries are numbers below MOST; null vectors give false."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(MOST), F.lit(False)))   # NaN is above all numbers
    return F.coalesce(fine, F.lit(False))


def scaled(vector: str, factor: int, shift: int = 0) -> Column:
    """floor(factor * entry) + shift of every entry, as longs."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(factor))).cast("bigint") + F.lit(shift).cast("bigint"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of equally long integer lists as a matrix."""
    return np.asarray(column.flatten(), np.int64).reshape(len(column), width)


def slabs(batches, rows: int = ROWS):
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)


def exact_gram(x: np.ndarray) -> np.ndarray:
    """x^T x of integers, exactly, as Python integers: by floating products while no sum can reach 2^53."""
    out = np.zeros((x.shape[1],) * 2, object)
    top = int(np.abs(x).max()) if x.size else 0
    step = (1 << 53) // (top * top) if top else len(x)
    if step < 16:                                        # entries too large for floats
        big = x.astype(object)
        return out + big.T.dot(big) if len(x) else out
    for i in range(0, len(x), max(step, 1)):
        part = x[i:i + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def exact_squares(x: np.ndarray) -> np.ndarray:
    """Sum of squares of every row, exactly; Python integers where longs would not do."""
    top = int(np.abs(x).max()) if x.size else 0
    if top * top * max(x.shape[1], 1) < 1 << 63:
        return np.einsum("ij,ij->i", x.astype(np.int64), x.astype(np.int64))
    big = x.astype(object)
    return (big * big).sum(axis=1)


def longs(values: np.ndarray) -> pa.Array:
    """Integers as an Arrow column of longs; null where one doesn't fit."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if -1 << 63 <= v < 1 << 63 else None for v in values], pa.int64())


def decimals(values) -> pa.Array:
    return pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))
