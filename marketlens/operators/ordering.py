"""Sort, limit, top-k and set operations (T-01 .. T-08).

A limit after a sort is planned as TakeOrderedAndProject: each task keeps its
own top n and only n rows per task reach the final merge, so top-k never
sorts the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:            # T-01
    """Order by the aggregate with a key to break ties, keep n."""
    return df.orderBy(*order).limit(n)


def sort_mixed(df: DataFrame, order: Sequence[Column]) -> DataFrame:               # T-02
    return df.orderBy(*order)


def head_with_buffer(df: DataFrame, n_vehicles: int, capacity: int,
                     order: Sequence[Column], buffer: float = 0.1) -> DataFrame:   # T-03
    total = n_vehicles * capacity
    return df.orderBy(*order).limit(total - int(buffer * total))


def argmax_row(df: DataFrame, value: str, tie: Sequence[str] = ()) -> DataFrame:   # T-04
    return df.orderBy(F.desc(value), *[F.asc(t) for t in tie]).limit(1)


def top_keys_series(df: DataFrame, key: str, n: int, series: Sequence[Column],
                    aggs: Sequence[Column]) -> DataFrame:                           # T-05
    """n most frequent keys (ties by key), then their grouped series."""
    top = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), F.asc(key)).limit(n)
    return df.join(F.broadcast(top.select(key)), key, "left_semi").groupBy(key, *series).agg(*aggs)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:                           # T-06
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def key_sets(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:  # T-07
    """(keys in both, keys only in a), on distinct keys."""
    da, db = a.select(*keys).distinct(), b.select(*keys).distinct()
    return da.intersect(db), da.join(db, list(keys), "left_anti")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:               # T-08
    return df.select(*cols).distinct()
