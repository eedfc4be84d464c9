"""Aggregations (A-01 .. A-23).

All are ``groupBy().agg()`` with map-side partial aggregation, so a hot key
costs one partial row per task before the shuffle. Global scalars are one-row
aggregates joined back by broadcast, never a window without ``partitionBy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:  # A-01, A-22
    """Named multi-aggregate."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def count_distinct(df: DataFrame, col: str, keys: Sequence[str] = (),
                   out: str = "n_distinct") -> DataFrame:                       # A-02
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(out))


def conditional_count_pivot(df: DataFrame, key: str, col: str, values: Sequence,
                            prefix: str = "") -> DataFrame:                    # A-03
    """One ``count_if(col = v)`` column per listed value (no pivot discovery pass)."""
    return df.groupBy(key).agg(*[F.count_if(F.col(col) == F.lit(v)).cast("bigint").alias(f"{prefix}{v}")
                                 for v in values])


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, distinct_of: str | None = None,
             prefix: str = "", other: str | None = None) -> DataFrame:         # A-04
    """group + size (or nunique) + unstack with zero fill; pivot values listed.
    ``other`` names a column that counts the rows of all values not listed."""
    if distinct_of is None:
        listed = F.coalesce(F.col(col).isin(list(values)), F.lit(False))
        counts = [F.count_if(F.col(col) == F.lit(v)).cast("bigint").alias(f"{prefix}{v}") for v in values]
        return df.groupBy(row).agg(*counts, *([F.count_if(~listed).cast("bigint").alias(other)] if other else []))
    g = df.groupBy(row).pivot(col, list(values))
    out = g.agg(F.count_distinct(distinct_of))
    out = out.fillna(0)
    return out.select(row, *[F.col(str(v)).cast("bigint").alias(f"{prefix}{v}") for v in values])


def flag_rate(df: DataFrame, keys: Sequence[str], flag: str, percent: bool = True,
              out: str = "rate") -> DataFrame:                                 # A-05
    scale = 100.0 if percent else 1.0
    return df.groupBy(*keys).agg((F.avg(F.col(flag).cast("double")) * F.lit(scale)).alias(out))


def row_share(df: DataFrame, cols: Sequence[str], percent: bool = True) -> DataFrame:  # A-06
    """Each cell over its row total."""
    total = sum((F.col(c) for c in cols), F.lit(0))
    scale = F.lit(100.0 if percent else 1.0)
    return df.withColumns({f"{c}_share": F.try_divide(F.col(c) * scale, total) for c in cols})


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str,
                  out: str = "weighted_mean") -> DataFrame:                    # A-07
    return df.groupBy(*keys).agg(F.try_divide(F.sum(value), F.sum(weight)).alias(out))


def last_by_time(df: DataFrame, keys: Sequence[str], value: str, time: Column,
                 out: str = "last_value") -> DataFrame:                        # A-08
    return df.groupBy(*keys).agg(F.max_by(F.col(value), time).alias(out))


def mode_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:  # A-09
    """Most frequent value tuple per key; ties by the values ascending."""
    c = df.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), *[F.asc(v) for v in values])
    return c.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_n")


def first_non_null_two_sources(primary: DataFrame, secondary: DataFrame, key: str,
                               value_cols: Sequence[str], order_col: str) -> DataFrame:  # A-10
    """First row (by ``order_col``) per key from each source; primary wins, else secondary."""
    def firsts(df, tag):
        s = F.struct(F.col(order_col).alias("o"), *[F.col(v).alias(v) for v in value_cols])
        return df.where(F.col(value_cols[0]).isNotNull()).groupBy(key).agg(
            F.min(s).alias(tag))
    p, s = firsts(primary, "_p"), firsts(secondary, "_s")
    j = p.join(s, key, "full")
    return j.select(key, *[F.coalesce(F.col(f"_p.{v}"), F.col(f"_s.{v}")).alias(v) for v in value_cols])


def value_counts(df: DataFrame, col: str, digits: int = 2) -> DataFrame:        # A-11
    """Counts and rounded percent of total (total as a one-row broadcast)."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = c.agg(F.sum("count").alias("_t"))
    return (c.crossJoin(F.broadcast(total))
            .withColumn("percent", F.round(F.col("count") * F.lit(100.0) / F.col("_t"), digits))
            .drop("_t"))


def collect_per_key(df: DataFrame, keys: Sequence[str], col: str, out: str = "ids") -> DataFrame:  # A-12
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(col)).alias(out))


def pearson_r(df: DataFrame, x: str, y: str) -> DataFrame:                      # A-13
    return df.agg(F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"))


def linear_trend(df: DataFrame, keys: Sequence[str], y: str, order: str) -> DataFrame:  # A-14
    """Slope, intercept and r of y over its position 0..n-1 in ``order`` per key."""
    w = Window.partitionBy(*keys).orderBy(order)
    idx = df.withColumn("_x", (F.row_number().over(w) - 1).cast("double"))
    return idx.groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col("_x")).alias("slope"),
        F.regr_intercept(F.col(y), F.col("_x")).alias("intercept"),
        F.corr(F.col("_x"), F.col(y)).alias("r"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:                  # A-15
    """Equal-width counts over [min, max] (numpy edges: last bin right-closed)."""
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = df.select(col).crossJoin(F.broadcast(mm))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1)))
    h = x.where(F.col(col).isNotNull()).groupBy(b.cast("bigint").alias("bin"), "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("count"))
    return h.select("bin",
                    (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / F.lit(bins)).alias("lower"),
                    (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / F.lit(bins)).alias("upper"),
                    "count")


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:      # A-16
    """Per column: type, distinct, nulls, min, max, mean (numeric) in one pass,
    unpivoted to one row per column."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    aggs = []
    for c in cols:
        aggs += [F.count_distinct(c).alias(f"{c}__d"),
                 F.count_if(F.col(c).isNull()).alias(f"{c}__n"),
                 F.min(F.col(c).cast("string") if types[c] not in numeric else F.col(c)).cast("string").alias(f"{c}__lo"),
                 F.max(F.col(c).cast("string") if types[c] not in numeric else F.col(c)).cast("string").alias(f"{c}__hi"),
                 (F.avg(c) if types[c] in numeric else F.lit(None).cast("double")).alias(f"{c}__m")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                     F.col(f"{c}__d").cast("bigint").alias("n_distinct"),
                     F.col(f"{c}__n").cast("bigint").alias("n_null"),
                     F.col(f"{c}__lo").alias("min_value"), F.col(f"{c}__hi").alias("max_value"),
                     F.col(f"{c}__m").alias("mean")) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame) -> DataFrame:                                      # A-17
    one = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null"))
                                          for c in df.columns])).alias("r")).select("r.*")


def distinct_counts(df: DataFrame) -> DataFrame:                                  # A-18
    one = df.agg(*[F.count_distinct(c).cast("bigint").alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct"))
                                          for c in df.columns])).alias("r")).select("r.*")


def columns_equal(df: DataFrame, a: str, b: str) -> DataFrame:                    # A-19
    """True when the columns agree on every row; nulls on both sides count as equal."""
    return df.agg(F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias("equal"))


def global_scalars(df: DataFrame, col: str) -> DataFrame:                        # A-20
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"),
                  F.avg(col).alias("mean"), F.sum(col).alias("sum"))


def with_overall_row(groups: DataFrame, key: str, value: str, label: str = "Overall",
                     digits: int = 2) -> DataFrame:                               # A-21
    """Total row = unweighted mean of the (rounded) group means, not a weighted rollup."""
    from marketlens.functions.numeric import round_half_even
    exact = F.sum(F.col(value).cast("decimal(34,12)")).cast("double")            # a sum in any order
    overall = groups.agg(round_half_even(exact / F.count(value), digits).alias(value)).select(
        F.lit(label).alias(key), value)
    return groups.select(key, value).unionByName(overall)


def any_value_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 order: str) -> DataFrame:                                       # A-23
    """Columns beside GROUP BY: a stated value (the one at the smallest ``order``)."""
    return df.groupBy(*keys).agg(*[F.min_by(F.col(c), F.col(order)).alias(c) for c in cols])
