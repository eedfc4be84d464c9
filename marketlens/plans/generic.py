"""General operators (S, F, A, T) applied to the driver tables, registered so
each has its own checked query. Every one reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import aggregates as A
from marketlens.operators import frame as FR
from marketlens.operators import ordering as T
from marketlens.sources import missing_keys
from marketlens.sources import standins as V
from marketlens.sources.tables import Tables

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def s01_read_orders(t: Tables) -> DataFrame:
    return t.orders


def s08_missing_nations(t: Tables) -> DataFrame:
    """Customer nations that no supplier is in yet (key tuples not in the known table)."""
    return missing_keys(t.customer.select(F.col("c_nationkey").alias("nationkey")),
                        t.supplier.select(F.col("s_nationkey").alias("nationkey")), ["nationkey"])


def f07_drop_nulls(t: Tables) -> DataFrame:
    return FR.drop_nulls(V.orders(t))


def f14_first_per_key(t: Tables) -> DataFrame:
    """First lineitem row per (order, line number) under a total order of the other columns."""
    li = t.lineitem
    order = [F.col(c) for c in li.columns if c not in ("l_orderkey", "l_linenumber")]
    return FR.drop_duplicates(li, ["l_orderkey", "l_linenumber"], order)


def a04_status_priority_crosstab(t: Tables) -> DataFrame:
    return A.crosstab(t.orders, "o_orderstatus", "o_orderpriority", PRIORITIES, prefix="n_", other="n_other")


def a15_totalprice_histogram(t: Tables) -> DataFrame:
    return A.histogram(t.orders, "o_totalprice", 20)


def a17_null_counts(t: Tables) -> DataFrame:
    return A.null_counts(V.orders(t))


def a18_distinct_counts(t: Tables) -> DataFrame:
    return A.distinct_counts(t.customer)


def a19_columns_equal(t: Tables) -> DataFrame:
    i = V.order_items(t).withColumn("_price_copy", F.col("price_before_discount"))
    return A.columns_equal(i, "price_before_discount", "_price_copy").crossJoin(
        A.columns_equal(i, "price_before_discount", "price_after_discount").withColumnRenamed("equal", "equal_after"))


def t07_nation_key_sets(t: Tables) -> DataFrame:
    both, only = T.key_sets(t.customer.select(F.col("c_nationkey").alias("nationkey")),
                            t.supplier.select(F.col("s_nationkey").alias("nationkey")), ["nationkey"])
    return both.withColumn("side", F.lit("both")).unionByName(only.withColumn("side", F.lit("customers_only")))


QUERIES = {
    "s01_read_orders": s01_read_orders,
    "s08_missing_nations": s08_missing_nations,
    "f07_drop_nulls": f07_drop_nulls,
    "f14_first_per_key": f14_first_per_key,
    "a04_status_priority_crosstab": a04_status_priority_crosstab,
    "a15_totalprice_histogram": a15_totalprice_histogram,
    "a17_null_counts": a17_null_counts,
    "a18_distinct_counts": a18_distinct_counts,
    "a19_columns_equal": a19_columns_equal,
    "t07_nation_key_sets": t07_nation_key_sets,
}
