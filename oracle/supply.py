"""DuckDB oracle SQL of supply-chain preparation (B-*)."""

DAILY = """(SELECT product_id, CAST(order_date AS DATE) AS date, sum(order_item_quantity) AS sold
            FROM v_order_data GROUP BY 1, 2)"""

LEDGER = f"""
    (WITH d AS {DAILY},
          m AS (SELECT product_id, CAST(date_trunc('month', date) AS DATE) AS month, sum(sold) AS month_units
                FROM d GROUP BY 1, 2),
          mm AS (SELECT m.product_id, m.month,
                        CAST(ceil(m.month_units * CAST(1.5 AS DOUBLE)) AS DOUBLE)
                        + CAST(ceil(coalesce(p.month_units, CAST(0.0 AS DOUBLE)) * CAST(1.1 AS DOUBLE)) AS DOUBLE) AS opening
                 FROM m LEFT JOIN m p ON p.product_id = m.product_id AND CAST(p.month + INTERVAL 1 MONTH AS DATE) = m.month),
          sp AS (SELECT product_id, month, opening,
                        CAST(unnest(generate_series(CAST(month AS TIMESTAMP), CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
                 FROM mm),
          l AS (SELECT sp.product_id, sp.date, sp.month, sp.opening, coalesce(d.sold, CAST(0.0 AS DOUBLE)) AS total_sold
                FROM sp LEFT JOIN d ON sp.product_id = d.product_id AND sp.date = d.date),
          r AS (SELECT product_id, date, total_sold,
                       opening - sum(CASE WHEN date = month THEN CAST(0.0 AS DOUBLE) ELSE total_sold END)
                         OVER (PARTITION BY product_id, month ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS raw_stock
                FROM l)
     SELECT product_id, date, raw_stock, greatest(raw_stock, CAST(0.0 AS DOUBLE)) AS current_stock, total_sold FROM r)"""

SQL = {
    "b01_clean_orders": ("""
        SELECT order_id, order_item_id, product_id, product_name, category_name, warehouse_id, order_country,
               order_region, order_state, order_city, order_date, shipping_mode, order_item_quantity, sales,
               order_item_total, profit,
               CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
               CAST(day(order_date) AS BIGINT) AS order_day,
               CAST(date_trunc('month', order_date) AS DATE) AS order_year_month,
               CAST(delivery_status = 'Late delivery' AS INTEGER) AS late_flag,
               days_for_shipping_real - days_for_shipment_scheduled AS delay_days
        FROM v_order_data WHERE order_date < TIMESTAMP '2001-01-01 00:00:00'""",
        ["order_item_quantity", "sales", "order_item_total", "profit"]),
    "b02_warehouse_location": ("""
        WITH rows AS (SELECT o.order_id, o.order_item_id, o.warehouse_id, o.order_country,
                             g.geolocation_lat AS lat, g.geolocation_lng AS lng
                      FROM v_order_data o JOIN v_geo g ON o.order_country = g.geolocation_city),
             c AS (SELECT warehouse_id, lat, lng, count(*) AS n FROM rows GROUP BY 1, 2, 3),
             m AS (SELECT warehouse_id, lat AS warehouse_lat, lng AS warehouse_lng FROM (
                     SELECT *, row_number() OVER (PARTITION BY warehouse_id ORDER BY n DESC, lat, lng) AS rn FROM c) x
                   WHERE rn = 1)
        SELECT rows.*, m.warehouse_lat, m.warehouse_lng FROM rows LEFT JOIN m ON rows.warehouse_id = m.warehouse_id""",
        ["lat", "lng", "warehouse_lat", "warehouse_lng"]),
    "b03_stock_ledger": (f"SELECT * FROM {LEDGER} x", ["raw_stock", "current_stock", "total_sold"]),
    "b04_negative_stock_check": (f"SELECT * FROM {LEDGER} x WHERE raw_stock < 0",
                                 ["raw_stock", "current_stock", "total_sold"]),
    "b05_product_price": ("""
        SELECT product_id, CASE WHEN sum(order_item_quantity) = 0 THEN NULL
                                ELSE CAST(sum(CAST(sales AS DECIMAL(20,2))) AS DOUBLE) / sum(order_item_quantity) END AS price
        FROM v_order_data WHERE order_date < TIMESTAMP '2000-01-01 00:00:00' GROUP BY 1""", ["price"]),
    "b06_product_costs": ("""
        SELECT * FROM (
          SELECT product_id, product_name, weight_kg, price, weight_kg * CAST(0.02 AS DOUBLE) AS daily_storage_cost,
                 (round_even((price * (CAST(1.0 AS DOUBLE) - CASE
                     WHEN contains(lower(product_name), 'widget') THEN CAST(0.6 AS DOUBLE)
                     WHEN contains(lower(product_name), 'plate') THEN CAST(0.4 AS DOUBLE)
                     WHEN contains(lower(product_name), 'ring') THEN CAST(0.5 AS DOUBLE)
                     WHEN contains(lower(product_name), 'bolt') THEN CAST(0.3 AS DOUBLE)
                     WHEN contains(lower(product_name), 'gear') THEN CAST(0.5 AS DOUBLE)
                     WHEN contains(lower(product_name), 'rod') THEN CAST(0.4 AS DOUBLE)
                     WHEN contains(lower(product_name), 'anvil') THEN CAST(0.3 AS DOUBLE) END)) * 100.0, 0) / 100.0) AS manufacturing_cost
          FROM v_product_info) x WHERE manufacturing_cost IS NOT NULL""",
        ["weight_kg", "price", "daily_storage_cost", "manufacturing_cost"]),
    "b07_monthly_stock": (f"""
        SELECT product_id, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
               arg_min(current_stock, date) AS stock_at_start_of_month, sum(total_sold) AS total_sold
        FROM {LEDGER} x GROUP BY 1, 2, 3""", ["stock_at_start_of_month", "total_sold"]),
}
