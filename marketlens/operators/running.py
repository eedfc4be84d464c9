"""Running sums over a sorted frame without one task for a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import cut_lineage


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, str], partitions: int | None = None) -> DataFrame:
    """``sums`` maps new columns to the columns whose sums up to and including the row they hold, in the order of ``order``
    within ``group``; rows equal in both share a partition and are added one by one.

    Rows are dealt into ranges of (group, order). Each range sums its own rows; what the ranges before add to a group comes
    from the ranges' totals, a frame of one row for each range and group in it. A group of any size is spread over ranges.
    """
    keys = [*group, *order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy(*group, "_range").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)       # ranges of one group
    offsets = totals.select(*group, "_range", *[F.sum(f"_t_{o}").over(before).alias(f"_b_{o}") for o in sums])
    own = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = placed.select("*", *[F.sum(c).over(own).alias(f"_o_{o}") for o, c in sums.items()])
    same = (F.col("a._range") == F.col("b._range"))
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    joined = run.alias("a").join(offsets.alias("b"), same)
    zero = lambda o: F.coalesce(F.col(f"b._b_{o}"), F.lit(0))
    return joined.select(*[F.col(f"a.{c}") for c in df.columns], *[(F.col(f"a._o_{o}") + zero(o)).alias(o) for o in sums])
