"""Window operators (W-01 .. W-10). Every window is partitioned by a key;
global min/max come from one-row aggregates broadcast back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_in_period(df: DataFrame, keys: Sequence[str], period: Column, value: str,
                    time: str, out: str = "first_value") -> DataFrame:          # W-01
    """Value at the earliest time of each (keys, period): ``min_by``, an aggregate."""
    return df.groupBy(*keys, period.alias("period")).agg(F.min_by(value, time).alias(out))


def lag_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                out: str = "prev", drop_first: bool = True) -> DataFrame:       # W-02
    w = Window.partitionBy(*keys).orderBy(*order)
    r = df.withColumn(out, F.lag(value, 1).over(w))
    return r.where(F.col(out).isNotNull()) if drop_first else r


def pct_change(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               out: str | None = None) -> DataFrame:                           # W-03
    """(x - prev) / prev per key; first row, zero and null divisors give 0."""
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = F.lag(value, 1).over(w)
    return df.withColumn(out or f"{value}_pct_change",
                         F.coalesce(F.try_divide(F.col(value) - prev, prev), F.lit(0.0)))


def previous_or_self(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                     out: str = "prev") -> DataFrame:                          # W-04
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.coalesce(F.lag(value, 1).over(w), F.col(value)))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  out: str = "running") -> DataFrame:                          # W-05
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def previous_month_total(monthly: DataFrame, keys: Sequence[str], month: str, value: str,
                         out: str = "prev_month") -> DataFrame:               # W-06
    """Total of the calendar month before (0 when that month had no row)."""
    prev = monthly.select(*keys, F.add_months(F.col(month), 1).alias(month), F.col(value).alias(out))
    return monthly.join(prev, [*keys, month], "left").fillna({out: 0})


def min_max_scaled(df: DataFrame, col: str, out: str, invert: bool = False) -> DataFrame:  # W-07
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    s = F.try_divide(F.col(col) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.crossJoin(F.broadcast(mm)).withColumn(out, (F.lit(1.0) - s) if invert else s).drop("_lo", "_hi")


def equal_width_bins(df: DataFrame, keys: Sequence[str], col: str, bins: int = 20,
                     out: str = "bin", few_groups: bool = False) -> DataFrame:  # W-08
    """Per-group pd.cut(x, bins) labels 0..bins-1 with group min/max from an
    aggregate joined back (a hash join on the group key, not a sort window).
    ``few_groups``: the keys come from a fixed short list, so the aggregate is
    broadcast and the rows aren't shuffled by a handful of keys."""
    from marketlens.functions.numeric import equal_width_bin
    mm = df.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return (df.join(F.broadcast(mm) if few_groups else mm, list(keys)) if keys else df.crossJoin(F.broadcast(mm))).withColumn(
        out, equal_width_bin(F.col(col), F.col("_lo"), F.col("_hi"), bins)).drop("_lo", "_hi")


def relabel_by_mean(df: DataFrame, cluster: str, field: str, ascending: bool = True,
                    out: str | None = None) -> DataFrame:                       # W-09
    """Cluster ids renumbered 0..k-1 by the mean of ``field``. k rows: small."""
    means = df.groupBy(cluster).agg(F.avg(field).alias("_m"))
    order = F.asc("_m") if ascending else F.desc("_m")
    ranked = means.withColumn("_new", (F.row_number().over(Window.orderBy(order, cluster)) - 1).cast("bigint"))
    return (df.join(F.broadcast(ranked.select(cluster, "_new")), cluster)
            .withColumnRenamed("_new", out or f"{cluster}_ranked"))


def assign_vehicles(df: DataFrame, order: Sequence[Column], n_vehicles: int, capacity: int,
                    partition: Sequence[str] = (), out: str = "vehicle") -> DataFrame:  # W-10
    """Row i (0-based, in ``order``) -> vehicle floor(i / capacity) when < n_vehicles, else null."""
    w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
    i = F.row_number().over(w) - 1
    v = F.floor(i / F.lit(capacity)).cast("bigint")
    return df.withColumn("stop_index", i.cast("bigint")).withColumn(
        out, F.when(v < n_vehicles, v))
