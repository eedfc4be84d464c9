"""Projections, filters and cleaning (F-01 .. F-16).

Thin, explicit DataFrame operators; Catalyst prunes columns and pushes the
filters to the parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:          # F-01
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:       # F-02
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:            # F-03
    return df.drop(*cols)


def filter_rows(df: DataFrame, cond: Column) -> DataFrame:                    # F-04
    return df.where(cond)


def between_window(df: DataFrame, col: str, start, end) -> DataFrame:         # F-05
    """Inclusive on both ends, on DATE values."""
    return df.where(F.to_date(F.col(col)).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def keep_known(df: DataFrame, ref: DataFrame, keys: Sequence[str]) -> DataFrame:  # F-06
    return df.join(ref.select(*keys), list(keys), "left_semi")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:  # F-07
    return df.dropna(how="any", subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: dict[str, object] | None = None,
               from_columns: dict[str, str] | None = None) -> DataFrame:      # F-08
    """Constant fill per column, or fill from another column."""
    out = df
    if from_columns:
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(src)) for c, src in from_columns.items()})
    if values:
        out = out.fillna(values)
    return out


def parse_dates(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:  # F-09
    """Text to timestamp; bad text becomes null (coerce)."""
    if fmt:
        return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in cols})
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in cols})


def _map_frame(df: DataFrame, mapping: dict) -> DataFrame:
    spark = df.sparkSession
    return F.broadcast(spark.createDataFrame(list(mapping.items()), "k string, v string"))


def replace_values(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:  # F-10
    """Dictionary replace: values outside the map are kept."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(col, F.coalesce(m[F.col(col)], F.col(col)))


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:  # F-11
    """Dictionary map: values outside the map become null."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out or col, m[F.col(col)])


def map_with_fallback(rule: Column, key: Column, mapping: dict, missing=(0, "N/A")) -> Column:  # F-12
    """Rule result first; where it gives 0 / 'N/A' / null, the mapped value of key."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    bad = rule.isNull()
    for v in missing:
        bad = bad | (rule.cast("string") == F.lit(str(v)))
    return F.when(bad, m[key]).otherwise(rule)


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:            # F-13
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None,
                    order: Sequence[Column] | None = None) -> DataFrame:      # F-14
    """Distinct rows, or the first row per key under an explicit, total order."""
    if not keys:
        return df.distinct()
    if order is None:
        order = [F.col(c) for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def add_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index",
                  start: int = 1) -> DataFrame:                              # F-15
    """1..n in a stated (total) order without a single-partition window.

    A global sort range-partitions the rows; inside a partition
    ``monotonically_increasing_id`` counts rows in sorted order, and a small
    per-partition count table (one row per partition, broadcast) gives each
    partition its offset. All of it stays in the JVM. The sorted rows are
    checkpointed, so that counts and rows come from one partitioning.
    """
    from marketlens.session import cut_lineage
    s = cut_lineage(df.orderBy(*order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = F.broadcast(offsets.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off")))
    return (s.join(offsets, "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local") + F.lit(start)).cast("bigint"))
            .drop("_pid", "_mid", "_local", "_off"))


def preview(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:     # F-16
    return df.orderBy(*order).limit(n)
