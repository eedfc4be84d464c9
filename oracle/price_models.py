"""DuckDB oracle SQL of splits, errors and scenarios (P-12, P-13, P-15)."""

from oracle.pricing import OWN, SQL as PRICING, bins

FEATURES = ("item_discount", "discount_rate", "quantity", "price_before_discount", "price_bins")
_EACH = " UNION ALL ".join(f"SELECT {i} AS f, '{name}' AS feature, CAST({name} AS DOUBLE) AS v, y FROM own" for i, name in enumerate(FEATURES))

SPLIT = f"""
    WITH own AS MATERIALIZED (SELECT *, CAST(final_price AS DECIMAL(24,6)) AS y FROM {bins('price_before_discount', 'product_category', OWN)} b
                              WHERE final_price IS NOT NULL),
         cells AS (SELECT f, feature, v, count(*) AS n, sum(y) AS s FROM ({_EACH}) e GROUP BY 1, 2, 3),
         run AS (SELECT f, feature, v, CAST(sum(n) OVER w AS BIGINT) AS nl, sum(s) OVER w AS sl, CAST(sum(n) OVER (PARTITION BY f) AS BIGINT) AS n,
                        sum(s) OVER (PARTITION BY f) AS s FROM cells WINDOW w AS (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
         c AS (SELECT *, CAST(sl AS DOUBLE) / nl AS mean_left, CAST(s - sl AS DOUBLE) / (n - nl) AS mean_right FROM run WHERE nl < n),
         r AS (SELECT *, (CAST(nl AS DOUBLE) / n) * (CAST(n - nl AS DOUBLE) / n) * (mean_left - mean_right) * (mean_left - mean_right) AS reduction FROM c),
         best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY reduction DESC, v) AS k FROM r) x WHERE k = 1)
    SELECT feature, v AS threshold, reduction, nl AS n_left, mean_left, n - nl AS n_right, mean_right,
           row_number() OVER (ORDER BY reduction DESC, f) = 1 AS chosen FROM best"""

BEST = """
    WITH o AS (SELECT CASE WHEN order_item_quantity = 0 THEN NULL ELSE sales / order_item_quantity END AS unit FROM v_order_data WHERE product_name = 'red plate'),
         base AS (SELECT round(avg(unit), 2) AS base FROM o),
         g AS (SELECT 5 + d.i * CAST(0.5 AS DOUBLE) AS own_avg_item_discount, (2 + r.i) / CAST(100.0 AS DOUBLE) AS own_avg_item_discount_rate,
                      CAST(100 + 100 * q.i AS INTEGER) AS own_demand, CAST(-20 + 5 * p.i AS DOUBLE) AS ped, CAST(100 + 100 * m.i AS INTEGER) AS market_demand,
                      (2 + a.i) / CAST(100.0 AS DOUBLE) AS market_avg_discount_rate, CAST(s.i AS INTEGER) AS season_code,
                      ((((((d.i * 8 + r.i) * 9 + q.i) * 8 + p.i) * 9 + m.i) * 8 + a.i) * 5 + s.i) AS scenario
               FROM range(20) d(i), range(8) r(i), range(9) q(i), range(8) p(i), range(9) m(i), range(8) a(i), range(5) s(i)),
         x AS (SELECT g.*, (base * (CAST(1.0 AS DOUBLE) - own_avg_item_discount_rate) - own_avg_item_discount)
                           * (CAST(1.0 AS DOUBLE) + season_code / CAST(100.0 AS DOUBLE)) AS predicted_price FROM g CROSS JOIN base),
         y AS (SELECT *, predicted_price * own_demand * own_avg_item_discount_rate AS predicted_revenue FROM x)
    SELECT scenario, * EXCLUDE (scenario) FROM y WHERE predicted_revenue IS NOT NULL ORDER BY predicted_revenue DESC, scenario LIMIT 1"""

SQL = {
    "p12_variance_split": (SPLIT, ["threshold", "reduction", "mean_left", "mean_right"]),
    "p13_regression_errors": (f"""
        SELECT product_category, count(*) AS n, avg(abs(own_price_before - market_price_before_discount)) AS mae,
               avg(abs(own_price_before - market_price_before_discount) / greatest(abs(own_price_before), CAST(2.220446049250313e-16 AS DOUBLE))) AS mape
        FROM ({PRICING['p07_merge_market'][0]}) p WHERE market_price_before_discount > 0 AND own_price_before IS NOT NULL GROUP BY 1""", ["mae", "mape"]),
    "p15_max_revenue_scenario": (BEST, ["own_avg_item_discount", "own_avg_item_discount_rate", "ped", "market_avg_discount_rate", "predicted_price",
                                        "predicted_revenue"]),
}
