"""Ranges of an integer key whose bounds are known before the rows are dealt."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """Up to n - 1 increasing bounds that deal the rows into ranges of about equal counts; reads the key column only.
    Range i holds the keys k with exactly i bounds below k."""
    if n < 2:
        return []
    found = df.agg(F.percentile_approx(F.col(key), [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0]
    return sorted(set(found or []))


def range_tops(ids: DataFrame, bounds: np.ndarray) -> list[tuple[int, int | None]]:
    """(range, largest key in it) of the ranges that have rows, null in the first; the one column of ``ids`` is the key. The
    bounds go to the tasks as an array, not into the plan."""
    shared = ids.sparkSession.sparkContext.broadcast(bounds)

    def tops(batches):
        best: dict[int, int | None] = {}
        for b in batches:
            key = b.column(0)
            if key.null_count:
                best.setdefault(0, None)
            k = key.drop_null().to_numpy(zero_copy_only=False)
            at = np.searchsorted(shared.value, k, side="left")
            order = np.lexsort([k, at])
            last = np.flatnonzero(np.diff(at[order], append=-1))
            for r, top in zip(at[order][last].tolist(), k[order][last].tolist(), strict=True):
                best[r] = top if best.get(r) is None else max(best[r], top)
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array(list(best.values()), pa.int64())], ["b", "top"])

    found = ids.mapInArrow(tops, "b int, top bigint").groupBy("b").agg(F.max("top").alias("top")).collect()
    return [(r["b"], r["top"]) for r in found]
