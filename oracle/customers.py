"""DuckDB oracle SQL of churn, RFM and lifetime value (C-*)."""

D100 = "CAST(100.0 AS DOUBLE)"


def addm(expr: str, n: int) -> str:
    """SQLite month arithmetic (day kept, overflow into the next month)."""
    return (f"CAST(CAST(date_trunc('month', CAST({expr} AS DATE)) AS DATE) + to_months({n}) "
            f"+ to_days(CAST(day({expr}) - 1 AS INTEGER)) AS DATE)")


def days(a: str, b: str) -> str:
    """floor of elapsed days from a to b."""
    return f"CAST(floor(((epoch_us({b}) - epoch_us({a})) / CAST(1000000.0 AS DOUBLE)) / 86400) AS BIGINT)"


CHURN = f"""
    (SELECT c.*, CAST(CASE WHEN l.last_p IS NULL THEN NULL WHEN l.last_p < CAST(cut.cut AS TIMESTAMP) THEN 1 ELSE 0 END AS INTEGER) AS churned
     FROM v_customers c
     LEFT JOIN (SELECT c2.customer_unique_id, max(o.order_purchase_timestamp) AS last_p
                FROM v_orders o JOIN v_customers c2 ON o.customer_id = c2.customer_id GROUP BY 1) l
       ON c.customer_unique_id = l.customer_unique_id
     CROSS JOIN (SELECT {addm('max(order_purchase_timestamp)', -6)} AS cut FROM v_orders) cut)"""

ORDERS_CHURN = f"""(SELECT o.*, ch.customer_unique_id, ch.churned, ch.customer_state
                    FROM v_orders o JOIN {CHURN} ch ON o.customer_id = ch.customer_id)"""

RFM = f"""
    (WITH j AS (SELECT o.*, p.payment_value, c.customer_unique_id
                FROM v_orders o JOIN v_payments p ON o.order_id = p.order_id
                JOIN v_customers c ON o.customer_id = c.customer_id
                WHERE o.order_delivered_customer_date IS NOT NULL AND o.order_approved_at IS NOT NULL
                  AND o.order_estimated_delivery_date IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL),
          lt AS (SELECT max(order_delivered_customer_date) + INTERVAL 1 DAY AS latest FROM j),
          g AS (SELECT customer_unique_id, max(order_delivered_customer_date) AS recent,
                       count(order_delivered_customer_date) AS frequency,
                       CAST(sum(CAST(payment_value AS DECIMAL(20,2))) AS DOUBLE) AS monetary_value
                FROM j GROUP BY 1)
     SELECT g.customer_unique_id, {days('g.recent', 'lt.latest')} AS recency, g.frequency, g.monetary_value
     FROM g CROSS JOIN lt)"""

TIERS = f"""
    (SELECT r.*,
            CAST(CASE WHEN recency <= 155 THEN 3 WHEN recency <= 279 THEN 2 WHEN recency <= 431 THEN 1 ELSE 0 END AS BIGINT) AS recency_cluster,
            CAST(CASE WHEN frequency <= 1 THEN 0 WHEN frequency <= 4 THEN 1 WHEN frequency <= 11 THEN 2 ELSE 3 END AS BIGINT) AS freq_cluster,
            CAST(CASE WHEN monetary_value <= 199.49 THEN 0 WHEN monetary_value <= 584.42 THEN 1 WHEN monetary_value <= 1570.79 THEN 2 ELSE 3 END AS BIGINT) AS money_cluster
     FROM {RFM} r)"""

SCORED = f"(SELECT x.*, recency_cluster + freq_cluster + money_cluster AS customer_score FROM {TIERS} x)"

CLV = """
    (WITH j AS (SELECT c.customer_unique_id, CAST(o.order_purchase_timestamp AS DATE) AS day, p.payment_value
                FROM v_orders o JOIN v_payments p ON o.order_id = p.order_id
                JOIN v_customers c ON o.customer_id = c.customer_id),
          d AS (SELECT customer_unique_id, day, CAST(sum(CAST(payment_value AS DECIMAL(20,2))) AS DOUBLE) AS value
                FROM j GROUP BY 1, 2),
          e AS (SELECT max(day) AS end_day FROM d),
          g AS (SELECT customer_unique_id, count(*) AS n, min(day) AS first_day, max(day) AS last_day,
                       CAST(sum(CAST(value AS DECIMAL(20,2))) AS DOUBLE) AS s, arg_min(value, day) AS first_value
                FROM d GROUP BY 1)
     SELECT customer_unique_id, CAST(n - 1 AS BIGINT) AS frequency,
            CAST(date_diff('day', first_day, last_day) AS DOUBLE) AS recency,
            CAST(date_diff('day', first_day, end_day) AS DOUBLE) AS "T",
            CASE WHEN n - 1 > 0 THEN (s - first_value) / (n - 1) ELSE CAST(0.0 AS DOUBLE) END AS monetary_value
     FROM g CROSS JOIN e)"""

SQL = {
    "c01_label_churn": (f"SELECT * FROM {CHURN} x", []),
    "c02_overall_churn": (f"""
        WITH g AS (SELECT churned, count(DISTINCT customer_unique_id) AS customers FROM {CHURN} x GROUP BY 1)
        SELECT churned, customers, customers * {D100} / (SELECT sum(customers) FROM g) AS share FROM g""", ["share"]),
    "c03_churn_by_order_count": (f"""
        WITH per AS (SELECT customer_unique_id, count(order_id) AS order_count, max(churned) AS churned
                     FROM {ORDERS_CHURN} x GROUP BY 1),
             g AS (SELECT order_count, count(*) AS customers, avg(churned) * {D100} AS churn_rate FROM per GROUP BY 1)
        SELECT g.*, (SELECT corr(CAST(order_count AS DOUBLE), churn_rate) FROM g) AS pearson_r FROM g""",
        ["churn_rate", "pearson_r"]),
    "c04_churn_by_review_score": (f"""
        WITH g AS (SELECT r.review_score,
                          count(DISTINCT CASE WHEN x.churned = 0 THEN x.customer_unique_id END) AS not_churned,
                          count(DISTINCT CASE WHEN x.churned = 1 THEN x.customer_unique_id END) AS churned
                   FROM {ORDERS_CHURN} x JOIN v_reviews r ON x.order_id = r.order_id GROUP BY 1)
        SELECT g.*, CASE WHEN churned + not_churned = 0 THEN NULL ELSE churned * {D100} / (churned + not_churned) END AS churn_rate
        FROM g""", ["churn_rate"]),
    "c05_churn_by_discount_bin": (f"""
        SELECT discount_rate_bin, avg(churned) * {D100} AS churned_percentage FROM (
          SELECT x.churned, CASE WHEN i.discount_rate >= 0 AND i.discount_rate < 0.1 THEN '0-10%'
                                 WHEN i.discount_rate >= 0.1 AND i.discount_rate < 0.2 THEN '10-20%'
                                 WHEN i.discount_rate >= 0.2 AND i.discount_rate < 0.3 THEN '20-30%' END AS discount_rate_bin
          FROM {ORDERS_CHURN} x JOIN v_items i ON x.order_id = i.order_id) b
        WHERE discount_rate_bin IS NOT NULL GROUP BY 1""", ["churned_percentage"]),
    "c06_churn_by_category": (f"""
        SELECT t.broad_category AS broader_category_english, avg(x.churned) * {D100} AS churn_rate
        FROM {ORDERS_CHURN} x JOIN v_items i ON x.order_id = i.order_id
        JOIN v_products p ON i.product_id = p.product_id
        JOIN v_cat t ON p.product_category_name = t.product_category_name GROUP BY 1""", ["churn_rate"]),
    "c07_churn_by_state": (f"""
        WITH g AS (SELECT customer_state,
                          count(DISTINCT CASE WHEN churned = 0 THEN customer_unique_id END) AS not_churned,
                          count(DISTINCT CASE WHEN churned = 1 THEN customer_unique_id END) AS churned
                   FROM {CHURN} x GROUP BY 1)
        SELECT g.*, CASE WHEN churned + not_churned = 0 THEN NULL ELSE churned * {D100} / (churned + not_churned) END AS churn_rate
        FROM g""", ["churn_rate"]),
    "c08_churn_by_delivery_days": (f"""
        WITH d AS (SELECT churned, {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS dd FROM {ORDERS_CHURN} x),
             t AS (SELECT max(dd) + 1 AS top FROM d)
        SELECT delivery_days_range, avg(churned) * {D100} AS churn_rate FROM (
          SELECT churned, CASE WHEN dd > 0 AND dd <= 5 THEN '0-5' WHEN dd > 5 AND dd <= 10 THEN '5-10'
                               WHEN dd > 10 AND dd <= 15 THEN '10-15' WHEN dd > 15 AND dd <= 20 THEN '15-20'
                               WHEN dd > 20 AND dd <= 25 THEN '20-25' WHEN dd > 25 AND dd <= t.top THEN '25+' END AS delivery_days_range
          FROM d CROSS JOIN t) b
        WHERE delivery_days_range IS NOT NULL GROUP BY 1""", ["churn_rate"]),
    "c09_churn_by_delivery_delay": (f"""
        WITH d AS (SELECT churned, {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS v FROM {ORDERS_CHURN} x),
             t AS (SELECT min(v) - 1 AS lo, max(v) + 1 AS hi FROM d)
        SELECT delivery_diff_range, avg(churned) * {D100} AS churn_rate FROM (
          SELECT churned, CASE WHEN v > t.lo AND v <= -1 THEN 'Earlier than 1 day'
                               WHEN v > -1 AND v <= 1 THEN 'On time (Within 1 day of expected date)'
                               WHEN v > 1 AND v <= 5 THEN '2-5 days late' WHEN v > 5 AND v <= 10 THEN '5-10 days late'
                               WHEN v > 10 AND v <= 15 THEN '10-15 days late'
                               WHEN v > 15 AND v <= t.hi THEN '15+ days late' END AS delivery_diff_range
          FROM d CROSS JOIN t) b
        WHERE delivery_diff_range IS NOT NULL GROUP BY 1""", ["churn_rate"]),
    "c10_churn_dates": (f"""
        WITH lp AS (SELECT customer_id, max(order_purchase_timestamp) AS last_purchase_date FROM v_orders GROUP BY 1),
             cc AS (SELECT lp.customer_id, {addm('lp.last_purchase_date', 6)} AS churn_date
                    FROM lp LEFT JOIN v_orders o ON lp.customer_id = o.customer_id
                     AND o.order_purchase_timestamp > lp.last_purchase_date
                     AND o.order_purchase_timestamp <= CAST({addm('lp.last_purchase_date', 6)} AS TIMESTAMP)
                    WHERE o.order_id IS NULL)
        SELECT churn_date, count(customer_id) AS churned_customers FROM cc GROUP BY 1""", []),
    "c11_rfm": (f"SELECT * FROM {RFM} x", ["monetary_value"]),
    "c12_rfm_tiers": (f"SELECT * FROM {SCORED} x", ["monetary_value"]),
    "c13_customer_segment": (f"""
        SELECT x.*, CASE WHEN customer_score <= 2 THEN 'Low Value' WHEN customer_score <= 5 THEN 'Mid Value'
                         ELSE 'High Value' END AS customer_segment FROM {SCORED} x""", ["monetary_value"]),
    "c14_scale_rfm": (f"""
        WITH r AS (SELECT * FROM {RFM} x),
             s AS (SELECT avg(recency) AS mr, avg(frequency) AS mf, avg(monetary_value) AS mm,
                          stddev_pop(recency) AS sr, stddev_pop(frequency) AS sf, stddev_pop(monetary_value) AS sm FROM r)
        SELECT customer_unique_id,
               CASE WHEN sr = 0 THEN NULL ELSE (recency - mr) / sr END AS recency_scaled,
               CASE WHEN sf = 0 THEN NULL ELSE (frequency - mf) / sf END AS frequency_scaled,
               CASE WHEN sm = 0 THEN NULL ELSE (monetary_value - mm) / sm END AS monetary_value_scaled
        FROM r CROSS JOIN s""", ["recency_scaled", "frequency_scaled", "monetary_value_scaled"]),
    "c16_segment_summary": (f"""
        SELECT customer_score, avg(recency) AS avg_recency, avg(frequency) AS avg_frequency,
               avg(monetary_value) AS avg_monetary_value FROM {SCORED} x GROUP BY 1""",
        ["avg_recency", "avg_frequency", "avg_monetary_value"]),
    "c17_clv_rfm": (f"SELECT * FROM {CLV} x", ["recency", "T", "monetary_value"]),
    "c20_clv_repeat_buyers": (f"SELECT * FROM {CLV} x WHERE frequency > 0 AND monetary_value > 0",
                              ["recency", "T", "monetary_value"]),
    "c21_clv_expected_spend": (f"""
        SELECT customer_unique_id, frequency, monetary_value,
               CAST(6.25 AS DOUBLE) * (CAST(15.44 AS DOUBLE) + frequency * monetary_value)
                 / (CAST(6.25 AS DOUBLE) * frequency + CAST(2.74 AS DOUBLE)) AS expected_spend
        FROM {CLV} x WHERE frequency > 0 AND monetary_value > 0""", ["monetary_value", "expected_spend"]),
}
