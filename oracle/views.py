"""The stand-in views of FIXTURES.md section 3, written in DuckDB SQL.

These mirror ``marketlens/sources/standins.py`` independently: the Spark side
builds them with the DataFrame API, the oracle with SQL text. Every oracle
query is prefixed with the CTEs it needs.
"""

from __future__ import annotations

import re

_DBL = "CAST({} AS DOUBLE)"

VIEWS: dict[str, str] = {
    "v_customers": """
        SELECT c.c_custkey AS customer_id, c.c_custkey AS customer_unique_id,
               CAST(c.c_nationkey AS BIGINT) AS customer_zip_code_prefix,
               n.n_name AS customer_city, r.r_name AS customer_state
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_geo": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS geolocation_zip_code_prefix,
               CAST(-30.0 AS DOUBLE) + n.n_nationkey * CAST(0.75 AS DOUBLE) AS geolocation_lat,
               CAST(-60.0 AS DOUBLE) + n.n_nationkey * CAST(0.5 AS DOUBLE) AS geolocation_lng,
               n.n_name AS geolocation_city, r.r_name AS geolocation_state
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_orders": """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
               CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
               o.o_orderdate AS order_purchase_timestamp,
               o.o_orderdate + INTERVAL 6 HOUR AS order_approved_at,
               CASE WHEN o.o_orderstatus = 'F' THEN ls.last_ship END AS order_delivered_customer_date,
               o.o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
        FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ls
          ON o.o_orderkey = ls.l_orderkey""",
    "v_items": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
               l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               l_extendedprice * (CAST(1.0 AS DOUBLE) - l_discount) AS price_after_discount,
               l_extendedprice * l_tax AS freight_value, l_discount AS discount_rate,
               l_extendedprice AS price_before_discount
        FROM lineitem""",
    "v_payments": """
        SELECT o_orderkey AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
               o_orderpriority AS payment_type, CAST(1 + o_orderkey % 3 AS BIGINT) AS payment_installments,
               o_totalprice AS payment_value
        FROM orders""",
    "v_cat": """
        SELECT * FROM (VALUES
          ('ECONOMY', 'economy_goods', 'Home & Living'),
          ('LARGE', 'large_items', 'Furniture & Decor'),
          ('MEDIUM', 'medium_items', 'Electronics & Tech'),
          ('PROMO', 'promo_items', 'Fashion & Accessories'),
          ('SMALL', 'small_items', 'Health & Beauty'),
          ('STANDARD', 'standard_goods', 'Sports & Leisure'))
          AS t(product_category_name, product_category_name_english, broad_category)""",
    "v_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name, p_name AS product_name,
               p_brand AS product_brand, p_size * CAST(100.0 AS DOUBLE) AS product_weight_g,
               p_retailprice AS product_price
        FROM part""",
    "v_sellers": """
        SELECT s.s_suppkey AS seller_id, CAST(s.s_nationkey AS BIGINT) AS seller_zip_code_prefix,
               n.n_name AS seller_city, r.r_name AS seller_state
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_reviews": """
        SELECT d.doc_id AS review_id, d.doc_id AS order_id,
               CAST(1 + d.doc_id % 5 AS BIGINT) AS review_score,
               CASE WHEN d.doc_id % 3 <> 0 THEN d.source END AS review_comment_title,
               d.text AS review_comment_message,
               least(e1.ts, e2.ts) AS review_creation_date,
               greatest(e1.ts, e2.ts) AS review_answer_timestamp,
               d.lang, d.source, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        LEFT JOIN events e1 ON e1.event_id = d.doc_id * 2
        LEFT JOIN events e2 ON e2.event_id = d.doc_id * 2 + 1""",
    "v_order_data": """
        SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS order_item_id,
               l.l_partkey AS product_id, p.p_name AS product_name, p.p_type AS category_name,
               o.o_custkey AS customer_id, l.l_suppkey AS warehouse_id, wn.n_name AS warehouse_country,
               cn.n_name AS order_country, cr.r_name AS order_region, c.c_mktsegment AS order_state,
               cn.n_name || ' ' || c.c_mktsegment AS order_city,
               o.o_orderdate AS order_date, l.l_shipdate AS shipping_date,
               CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT) AS days_for_shipping_real,
               CAST(l.l_linenumber AS BIGINT) AS days_for_shipment_scheduled,
               CASE l.l_linenumber % 4 WHEN 0 THEN 'Standard Class' WHEN 1 THEN 'Second Class'
                    WHEN 2 THEN 'First Class' ELSE 'Same Day' END AS shipping_mode,
               CASE WHEN date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) > l.l_linenumber THEN 'Late delivery'
                    WHEN date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) = l.l_linenumber THEN 'Shipping on time'
                    ELSE 'Advance shipping' END AS delivery_status,
               CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
               l.l_quantity AS order_item_quantity, l.l_extendedprice AS sales, l.l_discount AS discount_rate,
               l.l_extendedprice * (CAST(1.0 AS DOUBLE) - l.l_discount) AS order_item_total,
               l.l_extendedprice * (CAST(1.0 AS DOUBLE) - l.l_discount) - p.p_retailprice * l.l_quantity * CAST(0.5 AS DOUBLE) AS profit,
               p.p_retailprice AS product_price
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation wn ON s.s_nationkey = wn.n_nationkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation cn ON c.c_nationkey = cn.n_nationkey
        JOIN region cr ON cn.n_regionkey = cr.r_regionkey""",
    "v_product_info": """
        SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size AS DOUBLE) AS weight_kg,
               p_size * CAST(0.02 AS DOUBLE) AS daily_storage_cost,
               CAST(3 + p_partkey % 8 AS BIGINT) AS manufacturing_time,
               p_retailprice / CAST(2.0 AS DOUBLE) AS manufacturing_cost, p_retailprice AS price
        FROM part""",
    "v_marketing": """
        SELECT CAST(id AS BIGINT) AS id, CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date,
               campaign_type, channel, CAST(campaign_budget AS DOUBLE) AS campaign_budget,
               CAST(campaign_revenue AS DOUBLE) AS campaign_revenue,
               CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks
        FROM (VALUES
          (1, '1995-03-01', '1995-03-31', 'Flash Sales', 'social media', 12000.0, 50000.0, 200000, 4000),
          (2, '1995-11-15', '1995-12-31', 'Seasonal Sales', 'influencer', 30000.0, 140000.0, 500000, 12000),
          (3, '1996-06-01', '1996-06-20', 'Referral Programs', 'email', 5000.0, 0.0, 60000, 900),
          (4, '1997-02-01', '1997-03-15', 'Flash Sales', 'media', 20000.0, 75000.0, 300000, 5200),
          (5, '1997-03-01', '1997-04-10', 'Bundle Offers (BOGO)', 'search', 18000.0, 90000.0, 250000, 7000),
          (6, '1998-09-10', '1998-10-10', 'Seasonal Sales', 'social media', 25000.0, 110000.0, 420000, 9100),
          (7, '1999-05-01', '1999-05-31', 'Referral Programs', 'email', 7000.0, 33000.0, 80000, 2500),
          (8, '2000-01-05', '2000-02-05', 'Bundle Offers (BOGO)', 'influencer', 15000.0, 64000.0, 190000, 4300),
          (9, '2000-11-20', '2000-12-31', 'Seasonal Sales', 'search', 40000.0, 210000.0, 650000, 15000),
          (10, '2001-04-01', '2001-05-15', 'Flash Sales', 'media', 22000.0, 81000.0, 330000, 6100))
          AS t(id, start_date, end_date, campaign_type, channel, campaign_budget, campaign_revenue, impressions, clicks)""",
    "v_world_cities": """
        SELECT 'City ' || CAST(n.n_nationkey AS VARCHAR) AS city_ascii,
               CASE WHEN n.n_nationkey % 3 = 0 THEN replace(n.n_name, 'NATION', 'Nàtion')
                    WHEN n.n_nationkey % 3 = 1 THEN lower(n.n_name)
                    ELSE replace(n.n_name, '_', '-') END AS country,
               upper(substr(r.r_name, 1, 1)) || lower(substr(r.r_name, 2)) AS admin_name,
               CAST(-30.0 AS DOUBLE) + n.n_nationkey * CAST(0.75 AS DOUBLE) AS lat,
               CAST(-60.0 AS DOUBLE) + n.n_nationkey * CAST(0.5 AS DOUBLE) AS lng
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
}

_ORDER = list(VIEWS)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every stand-in view it names (and their
    own dependencies), in definition order."""
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for name in _ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                frontier.append(VIEWS[name])
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in _ORDER if n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
