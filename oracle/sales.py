"""DuckDB oracle SQL of the sales reports (Q-*). Values: (sql, double columns)."""

UNTIL = "DATE '2001-06-01'"
_MON = ("CASE month(order_purchase_timestamp) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' "
        "WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' "
        "WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' ELSE 'Dec' END")

_ITEMS_CAT = """(SELECT i.*, t.product_category_name_english AS product_category
                 FROM v_items i JOIN v_products p ON i.product_id = p.product_id
                 JOIN v_cat t ON p.product_category_name = t.product_category_name)"""

_HOURS = ",\n".join(f"CAST(count(CASE WHEN hour = {h} THEN 1 END) AS BIGINT) AS hour_{h:02d}" for h in range(24))

SQL = {
    "q01_customers_by_zip": ("""
        SELECT c.customer_zip_code_prefix AS zip_code_prefix, count(c.customer_id) AS customer_count,
               min(g.geolocation_lat) AS latitude, min(g.geolocation_lng) AS longitude
        FROM v_customers c JOIN v_geo g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix
        GROUP BY 1""", ["latitude", "longitude"]),
    "q02_top_cities": ("""
        SELECT customer_city, count(customer_id) AS customer_count FROM v_customers
        GROUP BY customer_city ORDER BY customer_count DESC, customer_city LIMIT 10""", []),
    "q03_city_growth": (f"""
        WITH top AS (SELECT customer_city, count(customer_id) AS n FROM v_customers GROUP BY 1
                     ORDER BY n DESC, customer_city LIMIT 10)
        SELECT c.customer_city, strftime(o.order_purchase_timestamp, '%Y-%m') AS month_year,
               count(c.customer_id) AS customer_count
        FROM v_customers c JOIN v_orders o ON c.customer_id = o.customer_id
        JOIN top ON c.customer_city = top.customer_city
        WHERE o.order_purchase_timestamp < {UNTIL}
        GROUP BY 1, 2""", []),
    "q04_new_customers_by_month": ("""
        WITH f AS (SELECT customer_id, min(order_purchase_timestamp) AS first_order_date
                   FROM v_orders GROUP BY customer_id)
        SELECT strftime(first_order_date, '%Y-%m') AS month_year, count(customer_id) AS new_customers
        FROM f GROUP BY 1""", []),
    "q05_orders_per_day": (f"""
        SELECT CAST(order_purchase_timestamp AS DATE) AS day, count(DISTINCT order_id) AS order_count
        FROM v_orders WHERE order_purchase_timestamp < {UNTIL} GROUP BY 1""", []),
    "q06_orders_by_weekday_hour": (f"""
        WITH e AS (SELECT CAST(dayofweek(ts) AS BIGINT) AS day_of_week_int, hour(ts) AS hour FROM events)
        SELECT CASE day_of_week_int WHEN 0 THEN 'Sun' WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed'
                    WHEN 4 THEN 'Thu' WHEN 5 THEN 'Fri' ELSE 'Sat' END AS day_of_week_name,
               day_of_week_int, {_HOURS}
        FROM e GROUP BY day_of_week_int""", []),
    "q07_monthly_orders_revenue": (f"""
        SELECT {_MON} AS month_name, CAST(month(order_purchase_timestamp) AS BIGINT) AS month_int,
               CAST(year(order_purchase_timestamp) AS BIGINT) AS year,
               count(o.order_id) AS order_count, CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue,
               {_MON} || ' ' || CAST(year(order_purchase_timestamp) AS VARCHAR) AS month_year
        FROM v_orders o JOIN v_payments p ON o.order_id = p.order_id
        WHERE o.order_purchase_timestamp < {UNTIL}
        GROUP BY 1, 2, 3, 6""", ["total_revenue"]),
    "q08_monthly_avg_freight": ("""
        SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS month_year, avg(i.freight_value) AS avg_freight_value
        FROM v_orders o JOIN v_items i ON o.order_id = i.order_id GROUP BY 1""", ["avg_freight_value"]),
    "q09_price_revenue_by_state": ("""
        SELECT c.customer_state, avg(i.price_after_discount) AS avg_item_price, CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue
        FROM v_items i JOIN v_payments p ON i.order_id = p.order_id
        JOIN v_orders o ON o.order_id = i.order_id JOIN v_customers c ON o.customer_id = c.customer_id
        GROUP BY c.customer_state""", ["avg_item_price", "total_revenue"]),
    "q09b_price_revenue_by_state_dedup": ("""
        WITH m AS (SELECT c.customer_state, avg(i.price_after_discount) AS avg_item_price
                   FROM v_items i JOIN v_orders o ON o.order_id = i.order_id
                   JOIN v_customers c ON o.customer_id = c.customer_id GROUP BY 1),
             r AS (SELECT c.customer_state, CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue
                   FROM v_payments p JOIN v_orders o ON o.order_id = p.order_id
                   JOIN v_customers c ON o.customer_id = c.customer_id
                   WHERE p.order_id IN (SELECT order_id FROM v_items) GROUP BY 1)
        SELECT m.customer_state, m.avg_item_price, r.total_revenue FROM m JOIN r ON m.customer_state = r.customer_state""",
        ["avg_item_price", "total_revenue"]),
    "q10_freight_revenue_by_state": ("""
        SELECT c.customer_state, avg(i.freight_value) AS avg_freight_value, CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue
        FROM v_items i JOIN v_payments p ON i.order_id = p.order_id
        JOIN v_orders o ON o.order_id = i.order_id JOIN v_customers c ON o.customer_id = c.customer_id
        GROUP BY c.customer_state""", ["avg_freight_value", "total_revenue"]),
    "q11_payment_mix_by_month": (f"""
        SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS month_year, p.payment_type,
               count(p.payment_type) AS payment_type_count
        FROM v_payments p JOIN v_orders o ON p.order_id = o.order_id
        WHERE o.order_purchase_timestamp < {UNTIL} GROUP BY 1, 2""", []),
    "q12_payment_mix": ("""
        SELECT p.payment_type, count(p.payment_type) AS payment_type_count
        FROM v_payments p JOIN v_orders o ON p.order_id = o.order_id GROUP BY 1""", []),
    "q13_cancelled_by_month": (f"""
        SELECT {_MON} AS month_name, CAST(month(order_purchase_timestamp) AS BIGINT) AS month_int,
               CAST(year(order_purchase_timestamp) AS BIGINT) AS year, count(order_id) AS cancelled_order_count,
               {_MON} || ' ' || CAST(year(order_purchase_timestamp) AS VARCHAR) AS month_year
        FROM v_orders WHERE order_status = 'canceled' AND order_purchase_timestamp < {UNTIL}
        GROUP BY 1, 2, 3, 5""", []),
    "q14_customer_places": ("""
        SELECT customer_unique_id, customer_city, customer_state FROM v_customers""", []),
    "q15_orders_payments": ("""
        SELECT o.*, p.payment_sequential, p.payment_type, p.payment_installments, p.payment_value,
               c.customer_unique_id
        FROM v_orders o JOIN v_payments p ON o.order_id = p.order_id
        JOIN v_customers c ON o.customer_id = c.customer_id""", ["payment_value"]),
    "q16_top_categories_by_revenue": (f"""
        SELECT CAST(sum(CAST(price_after_discount AS DECIMAL(22,4))) AS DOUBLE) AS revenue, product_category FROM {_ITEMS_CAT} x
        GROUP BY product_category ORDER BY revenue DESC, product_category LIMIT 5""", ["revenue"]),
    "q17_top_categories_by_items": (f"""
        SELECT count(order_id) AS order_count, product_category FROM {_ITEMS_CAT} x
        GROUP BY product_category ORDER BY order_count DESC, product_category LIMIT 5""", []),
    "q18_category_revenue_trend": (f"""
        SELECT x.product_category, CAST(sum(CAST(x.price_after_discount AS DECIMAL(22,4))) AS DOUBLE) AS revenue, {_MON} AS month_name,
               CAST(month(order_purchase_timestamp) AS BIGINT) AS month_int,
               CAST(year(order_purchase_timestamp) AS BIGINT) AS year, count(x.order_id) AS item_count,
               {_MON} || ' ' || CAST(year(order_purchase_timestamp) AS VARCHAR) AS month_year
        FROM {_ITEMS_CAT} x JOIN v_orders o ON x.order_id = o.order_id
        WHERE x.product_category IN ('economy_goods', 'promo_items', 'small_items')
          AND o.order_purchase_timestamp < {UNTIL}
        GROUP BY x.product_category, 3, 4, 5, 7""", ["revenue"]),
    "q19_category_price_volume": (f"""
        SELECT count(order_id) AS order_count, product_category, avg(price_after_discount) AS avg_price
        FROM {_ITEMS_CAT} x GROUP BY product_category""", ["avg_price"]),
    "q20_undelivered_by_category": (f"""
        SELECT count(o.order_status) AS undelivered_orders_count, x.product_category
        FROM {_ITEMS_CAT} x JOIN v_orders o ON x.order_id = o.order_id
        WHERE o.order_status <> 'delivered' GROUP BY x.product_category""", []),
    "q21_daily_revenue_customers": ("""
        SELECT CAST(o.order_delivered_customer_date AS DATE) AS delivered_date,
               strftime(o.order_delivered_customer_date, '%Y-%m') AS month,
               count(DISTINCT o.customer_id) AS daily_unique_customers,
               CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS daily_total_revenue
        FROM v_orders o JOIN v_payments p ON o.order_id = p.order_id
        WHERE o.order_status = 'delivered' GROUP BY 1, 2""", ["daily_total_revenue"]),
    "q22_daily_sales": ("""
        SELECT CAST(o.order_purchase_timestamp AS DATE) AS ymd, CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS purchase_value
        FROM v_payments p JOIN v_orders o ON p.order_id = o.order_id GROUP BY 1""", ["purchase_value"]),
}
