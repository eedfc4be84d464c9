"""DuckDB oracle SQL of pricing (P-*)."""

MONTHS = ("CASE month({c}) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April' "
          "WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September' "
          "WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END")


def bins(x: str, key: str, src: str) -> str:
    """rows of ``src`` with per-``key`` 20-bin labels of ``x``."""
    return f"""(SELECT s.*, CAST(CASE WHEN mm.hi - mm.lo = 0 THEN 9
                          ELSE greatest(ceil((s.{x} - mm.lo) / (mm.hi - mm.lo) * 20) - 1, 0) END AS BIGINT) AS price_bins
               FROM {src} s JOIN (SELECT {key}, min({x}) AS lo, max({x}) AS hi FROM {src} z GROUP BY 1) mm
                 ON s.{key} = mm.{key})"""


OWN = """(SELECT order_date, category_name AS product_category, sales * discount_rate AS item_discount, discount_rate,
                 order_item_quantity AS quantity, sales AS price_before_discount,
                 (round_even((CASE WHEN order_item_quantity = 0 THEN NULL ELSE order_item_total / order_item_quantity END) * 100.0, 0) / 100.0) AS final_price
          FROM v_order_data WHERE year(order_date) BETWEEN 1998 AND 2000 AND sales <= 60000.0)"""

BIN_DEMAND = f"""(SELECT order_date, {MONTHS.format(c='order_date')} AS order_month, product_category, price_bins,
                         CAST(sum(CAST(item_discount AS DECIMAL(24,6))) AS DOUBLE) / count(item_discount) AS own_avg_item_discount, avg(discount_rate) AS own_avg_item_discount_rate,
                         sum(quantity) AS own_demand, avg(price_before_discount) AS own_price_before,
                         avg(final_price) AS final_price
                  FROM {bins('price_before_discount', 'product_category', OWN)} b GROUP BY 1, 2, 3, 4)"""

_W = "OVER (PARTITION BY product_category, price_bins ORDER BY month(order_date), order_date)"


def _pct(c: str) -> str:
    return (f"coalesce(CASE WHEN lag({c}) {_W} = 0 THEN NULL ELSE ({c} - lag({c}) {_W}) / lag({c}) {_W} END, "
            f"CAST(0.0 AS DOUBLE))")


ELAST_MAP = ("CASE product_category WHEN 'ECONOMY' THEN 'Inelastic' WHEN 'LARGE' THEN 'Elastic' "
             "WHEN 'MEDIUM' THEN 'Elastic' WHEN 'PROMO' THEN 'Elastic' WHEN 'SMALL' THEN 'Inelastic' "
             "WHEN 'STANDARD' THEN 'Inelastic' END")

SEASON = ("CASE WHEN month({c}) = 12 AND day({c}) >= 24 THEN 'Holiday - Christmas' "
          "WHEN month({c}) = 11 AND day({c}) = 29 THEN 'Holiday - Black Friday' "
          "WHEN month({c}) = 11 AND day({c}) = 30 THEN 'Holiday - Cyber Monday' "
          "WHEN month({c}) = 8 THEN 'Seasonal - Back to School' "
          "WHEN month({c}) IN (5, 6) THEN 'Seasonal - Summer Sales' ELSE 'Regular' END")

ELAST = f"""
    (WITH c AS (SELECT b.*, {_pct('own_avg_item_discount')} AS discount_change, {_pct('own_demand')} AS quantity_change
                FROM {BIN_DEMAND} b),
          p AS (SELECT c.*, coalesce(CASE WHEN discount_change = 0 THEN NULL ELSE quantity_change / discount_change END,
                                     CAST(0.0 AS DOUBLE)) AS ped FROM c),
          l AS (SELECT p.*, CASE WHEN abs(ped) > 1 THEN 'Elastic' WHEN abs(ped) < 1 THEN 'Inelastic' ELSE 'N/A' END AS lab FROM p)
     SELECT order_date, product_category, price_bins, own_avg_item_discount, own_avg_item_discount_rate,
            own_demand, own_price_before, final_price, discount_change, quantity_change,
            CASE WHEN ped = 0 OR lab = 'N/A' THEN {ELAST_MAP} ELSE lab END AS price_elasticity,
            {SEASON.format(c='order_date')} AS seasonality, strftime(order_date, '%m-%Y') AS order_month_key
     FROM l)"""

CATMAP = """(SELECT p.product_id, t.product_category_name_english,
                    CASE t.product_category_name_english WHEN 'economy_goods' THEN 'ECONOMY' WHEN 'large_items' THEN 'LARGE'
                         WHEN 'medium_items' THEN 'MEDIUM' WHEN 'promo_items' THEN 'PROMO' WHEN 'small_items' THEN 'SMALL'
                         WHEN 'standard_goods' THEN 'STANDARD' END AS product_category
             FROM v_products p JOIN v_cat t ON p.product_category_name = t.product_category_name)"""

MARKET = f"""(SELECT i.*, o.order_purchase_timestamp, cm.product_category
              FROM v_items i JOIN v_orders o ON i.order_id = o.order_id JOIN {CATMAP} cm ON i.product_id = cm.product_id)"""

MARKET_B = bins("price_before_discount", "product_category", MARKET)

_ELAST_D = ["own_avg_item_discount", "own_avg_item_discount_rate", "own_demand", "own_price_before",
            "final_price", "discount_change", "quantity_change"]

P08 = f"""
    (WITH o AS (SELECT order_date, order_item_quantity, discount_rate,
                       CASE WHEN order_item_quantity = 0 THEN NULL ELSE sales / order_item_quantity END AS unit_price,
                       CASE WHEN order_item_quantity = 0 THEN NULL ELSE sales * discount_rate / order_item_quantity END AS unit_discount
                FROM v_order_data WHERE product_name = 'red plate'),
          g AS (SELECT {MONTHS.format(c='order_date')} AS order_month, CAST(month(order_date) AS BIGINT) AS month_number,
                       avg(unit_price) AS avg_unit_price, avg(unit_discount) AS avg_unit_discount,
                       avg(discount_rate) AS avg_discount_rate, sum(order_item_quantity) AS demand
                FROM o GROUP BY 1, 2),
          c AS (SELECT g.*,
                  coalesce(CASE WHEN lag(avg_unit_discount) OVER w = 0 THEN NULL ELSE (avg_unit_discount - lag(avg_unit_discount) OVER w) / lag(avg_unit_discount) OVER w END, CAST(0.0 AS DOUBLE)) AS discount_change,
                  coalesce(CASE WHEN lag(demand) OVER w = 0 THEN NULL ELSE (demand - lag(demand) OVER w) / lag(demand) OVER w END, CAST(0.0 AS DOUBLE)) AS quantity_change
                FROM g WINDOW w AS (ORDER BY month_number))
     SELECT c.*, coalesce(CASE WHEN discount_change = 0 THEN NULL ELSE quantity_change / discount_change END, CAST(0.0 AS DOUBLE)) AS ped
     FROM c)"""

P09 = f"""(SELECT {MONTHS.format(c='order_purchase_timestamp')} AS order_month, avg(i.price_after_discount) AS market_avg_price,
                  avg(i.discount_rate) AS market_avg_discount_rate, count(*) AS market_demand
           FROM v_items i JOIN v_orders o ON i.order_id = o.order_id JOIN {CATMAP} cm ON i.product_id = cm.product_id
           WHERE cm.product_category_name_english = 'economy_goods' AND i.price_after_discount BETWEEN 20000.0 AND 60000.0
           GROUP BY 1)"""

_P08_D = ["avg_unit_price", "avg_unit_discount", "avg_discount_rate", "demand", "discount_change", "quantity_change", "ped"]

SEASON_M = ("CASE order_month WHEN 'December' THEN 'Holiday - Christmas' WHEN 'November' THEN 'Holiday - Cyber Monday' "
            "WHEN 'August' THEN 'Seasonal - Back to School' WHEN 'May' THEN 'Seasonal - Summer Sales' "
            "WHEN 'June' THEN 'Seasonal - Summer Sales' ELSE 'Regular' END")

SQL = {
    "p01_unit_price": ("""
        SELECT order_id, order_item_id, product_id, order_item_total, order_item_quantity,
               (round_even((CASE WHEN order_item_quantity = 0 THEN NULL ELSE order_item_total / order_item_quantity END) * 100.0, 0) / 100.0) AS final_price
        FROM v_order_data""", ["order_item_total", "order_item_quantity", "final_price"]),
    "p02_price_bin_demand": (f"SELECT * FROM {BIN_DEMAND} x",
                             ["own_avg_item_discount", "own_avg_item_discount_rate", "own_demand",
                              "own_price_before", "final_price"]),
    "p03_elasticity": (f"SELECT * FROM {ELAST} x", _ELAST_D),
    "p04_market_price_bins": (f"""
        SELECT order_purchase_timestamp AS order_date, product_category, price_bins,
               CAST(sum(order_item_id) AS BIGINT) AS market_product_demand, avg(price_before_discount) AS market_price_before_discount,
               avg(discount_rate) AS avg_discount_rate, avg(price_after_discount) AS avg_price_after_discount
        FROM {MARKET_B} m GROUP BY 1, 2, 3""",
        ["market_price_before_discount", "avg_discount_rate", "avg_price_after_discount"]),
    "p05_market_category_map": (f"SELECT * FROM {CATMAP} c", []),
    "p06_pricing_features": (f"""
        SELECT e.order_date, e.price_bins, e.own_avg_item_discount, e.own_avg_item_discount_rate, e.own_demand,
               e.own_price_before, e.final_price, e.discount_change, e.quantity_change, e.order_month_key,
               CAST(dense_rank() OVER (ORDER BY e.product_category) - 1 AS BIGINT) AS product_category_encoded,
               CAST(seasonality = 'Holiday - Christmas' AS INTEGER) AS "seasonality_Holiday - Christmas",
               CAST(seasonality = 'Holiday - Cyber Monday' AS INTEGER) AS "seasonality_Holiday - Cyber Monday",
               CAST(seasonality = 'Regular' AS INTEGER) AS "seasonality_Regular",
               CAST(seasonality = 'Seasonal - Back to School' AS INTEGER) AS "seasonality_Seasonal - Back to School",
               CAST(seasonality = 'Seasonal - Summer Sales' AS INTEGER) AS "seasonality_Seasonal - Summer Sales",
               CAST(price_elasticity = 'Inelastic' AS INTEGER) AS "price_elasticity_Inelastic"
        FROM {ELAST} e""", _ELAST_D),
    "p07_merge_market": (f"""
        WITH m AS (SELECT product_category, strftime(order_purchase_timestamp, '%m-%Y') AS order_month_key, price_bins,
                          CAST(sum(order_item_id) AS BIGINT) AS market_product_demand, avg(price_before_discount) AS market_price_before_discount,
                          avg(discount_rate) AS market_avg_discount_rate
                   FROM {MARKET_B} mb GROUP BY 1, 2, 3)
        SELECT e.*, CAST(coalesce(m.market_product_demand, 0) AS BIGINT) AS market_product_demand,
               coalesce(m.market_price_before_discount, 0) AS market_price_before_discount,
               coalesce(m.market_avg_discount_rate, 0) AS market_avg_discount_rate
        FROM {ELAST} e LEFT JOIN m ON e.product_category = m.product_category AND e.order_month_key = m.order_month_key
          AND e.price_bins = m.price_bins""", _ELAST_D + ["market_price_before_discount", "market_avg_discount_rate"]),
    "p08_product_month_elasticity": (f"SELECT * FROM {P08} x", _P08_D),
    "p09_market_month_profile": (f"SELECT * FROM {P09} x", ["market_avg_price", "market_avg_discount_rate"]),
    "p10_merge_product_market": (f"""
        SELECT p.*, coalesce(m.market_avg_price, 0) AS market_avg_price,
               coalesce(m.market_avg_discount_rate, 0) AS market_avg_discount_rate,
               coalesce(m.market_demand, 0) AS market_demand,
               {SEASON_M.replace('order_month', 'p.order_month')} AS seasonality,
               CAST(CASE {SEASON_M.replace('order_month', 'p.order_month')} WHEN 'Holiday - Black Friday' THEN 0
                    WHEN 'Holiday - Christmas' THEN 1 WHEN 'Holiday - Cyber Monday' THEN 2 WHEN 'Regular' THEN 3
                    WHEN 'Seasonal - Back to School' THEN 4 ELSE 5 END AS BIGINT) AS season_code
        FROM {P08} p LEFT JOIN {P09} m ON p.order_month = m.order_month""",
        _P08_D + ["market_avg_price", "market_avg_discount_rate"]),
}
