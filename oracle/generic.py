"""DuckDB oracle SQL of the general operators (S, F, A, T)."""

_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_ORD_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
             "order_delivered_customer_date", "order_estimated_delivery_date"]
_CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

SQL = {
    "s01_read_orders": ("SELECT * FROM orders", ["o_totalprice"]),
    "s08_missing_nations": ("""
        SELECT DISTINCT c_nationkey AS nationkey FROM customer
        WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)""", []),
    "f07_drop_nulls": ("SELECT * FROM v_orders WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _ORD_COLS), []),
    "f14_first_per_key": ("""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                                l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) x
        WHERE rn = 1""", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "a04_status_priority_crosstab": ("SELECT o_orderstatus, " + ", ".join(
        f"CAST(count(*) FILTER (WHERE o_orderpriority = '{p}') AS BIGINT) AS \"n_{p}\"" for p in _PRI)
        + ", CAST(count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ("
        + ", ".join(f"'{p}'" for p in _PRI) + ")) AS BIGINT) AS n_other FROM orders GROUP BY 1", []),
    "a15_totalprice_histogram": ("""
        WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
             b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) END AS BIGINT) AS bin, lo, hi
                   FROM orders CROSS JOIN mm WHERE o_totalprice IS NOT NULL)
        SELECT bin, lo + bin * (hi - lo) / 20 AS lower, lo + (bin + 1) * (hi - lo) / 20 AS upper, count(*) AS count
        FROM b GROUP BY bin, lo, hi""", ["lower", "upper"]),
    "a17_null_counts": (" UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM v_orders"
        for c in _ORD_COLS), []),
    "a18_distinct_counts": (" UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM customer" for c in _CUST_COLS), []),
    "a19_columns_equal": ("""
        SELECT coalesce(bool_and(price_before_discount IS NOT DISTINCT FROM price_before_discount), true) AS equal,
               coalesce(bool_and(price_before_discount IS NOT DISTINCT FROM price_after_discount), true) AS equal_after
        FROM v_items""", []),
    "t07_nation_key_sets": ("""
        SELECT nationkey, 'both' AS side FROM (SELECT c_nationkey AS nationkey FROM customer
                                               INTERSECT SELECT s_nationkey FROM supplier) a
        UNION ALL
        SELECT nationkey, 'customers_only' FROM (SELECT DISTINCT c_nationkey AS nationkey FROM customer
                                                 EXCEPT SELECT s_nationkey FROM supplier) b""", []),
}
