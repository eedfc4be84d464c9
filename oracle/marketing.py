"""DuckDB oracle SQL of marketing and discounts (M-*)."""

MKT = """(SELECT id, start_date, end_date, campaign_type,
                 CASE channel WHEN 'influencer' THEN 'affiliate' WHEN 'media' THEN 'email' ELSE channel END AS channel,
                 campaign_budget, campaign_revenue, impressions, clicks,
                 CAST(date_diff('day', start_date, end_date) AS BIGINT) AS duration
          FROM v_marketing)"""

DAILY = """(SELECT CAST(o.order_purchase_timestamp AS DATE) AS ymd,
                   CAST(sum(CAST(p.payment_value AS DECIMAL(20,2))) AS DOUBLE) AS purchase_value
            FROM v_payments p JOIN v_orders o ON p.order_id = o.order_id GROUP BY 1)"""

SALES = f"""(SELECT m.*, (SELECT coalesce(sum(d.purchase_value), CAST(0.0 AS DOUBLE)) FROM {DAILY} d
                          WHERE d.ymd >= m.start_date AND d.ymd <= m.end_date) AS total_purchase_value
             FROM {MKT} m)"""

ATTR = f"""(SELECT s.*, s.campaign_revenue / tot.t AS revenue_weight,
                   (round_even((s.campaign_revenue / tot.t * s.total_purchase_value) * 100.0, 0) / 100.0) AS new_campaign_revenue
            FROM {SALES} s CROSS JOIN (SELECT sum(campaign_revenue) AS t FROM {MKT} x) tot)"""

BUDGET = f"""(SELECT a.*, CASE WHEN campaign_revenue = 0 THEN NULL ELSE campaign_budget / campaign_revenue END AS budget_to_revenue_ratio,
                     (round_even((CASE WHEN campaign_revenue = 0 OR new_campaign_revenue = 0 THEN duration * CAST(20.0 AS DOUBLE)
                                     ELSE new_campaign_revenue * (campaign_budget / campaign_revenue) END) * 100.0, 0) / 100.0) AS new_campaign_budget
              FROM {ATTR} a)"""

CAPS = """(SELECT * FROM (VALUES ('affiliate', 'Flash Sales', CAST(100 AS DOUBLE)),
                                ('affiliate', 'Seasonal Sales', CAST(130 AS DOUBLE)),
                                ('affiliate', 'Bundle Offers (BOGO)', CAST(40 AS DOUBLE)),
                                ('affiliate', 'Referral Programs', CAST(30 AS DOUBLE))) AS c(channel, campaign_type, cap))"""

HIST = """
    WITH x AS (SELECT discount_rate AS v FROM v_items),
         mm AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
         b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 80)), 79) END AS BIGINT) AS bin,
                      lo, hi FROM x CROSS JOIN mm WHERE v IS NOT NULL)
    SELECT bin, lo + bin * (hi - lo) / 80 AS lower, lo + (bin + 1) * (hi - lo) / 80 AS upper, count(*) AS count
    FROM b GROUP BY bin, lo, hi"""

SQL = {
    "m01_campaign_sales": (f"SELECT * FROM {SALES} x", ["campaign_budget", "campaign_revenue", "total_purchase_value"]),
    "m02_attribute_revenue": (f"SELECT * FROM {ATTR} x",
                              ["campaign_budget", "campaign_revenue", "total_purchase_value", "revenue_weight",
                               "new_campaign_revenue"]),
    "m03_estimate_budget": (f"SELECT * FROM {BUDGET} x",
                            ["campaign_budget", "campaign_revenue", "total_purchase_value", "revenue_weight",
                             "new_campaign_revenue", "budget_to_revenue_ratio", "new_campaign_budget"]),
    "m04_cap_roi": (f"""
        SELECT b.*, c.cap, r.current_roi,
               CASE WHEN c.cap IS NULL THEN b.new_campaign_budget
                    WHEN r.current_roi > c.cap AND b.new_campaign_revenue <> 0
                      THEN b.new_campaign_revenue / (CAST(1.0 AS DOUBLE) + c.cap / CAST(100.0 AS DOUBLE))
                    ELSE b.new_campaign_revenue END AS adjusted_budget
        FROM {BUDGET} b LEFT JOIN {CAPS} c ON b.channel = c.channel AND b.campaign_type = c.campaign_type
        CROSS JOIN LATERAL (SELECT CASE WHEN b.new_campaign_budget = 0 THEN NULL
                                   ELSE (b.new_campaign_revenue - b.new_campaign_budget) * CAST(100.0 AS DOUBLE) / b.new_campaign_budget END AS current_roi) r""",
        ["campaign_budget", "campaign_revenue", "total_purchase_value", "revenue_weight", "new_campaign_revenue",
         "budget_to_revenue_ratio", "new_campaign_budget", "cap", "current_roi", "adjusted_budget"]),
    "m05_campaign_end_dates": ("""
        SELECT id, start_date, CAST(date_diff('day', start_date, end_date) AS BIGINT) AS duration,
               CAST(start_date + to_days(CAST(date_diff('day', start_date, end_date) AS INTEGER)) AS DATE) AS end_date
        FROM v_marketing""", []),
    "m06_rename_channels": ("""
        SELECT id, start_date, end_date, campaign_type,
               CASE channel WHEN 'influencer' THEN 'affiliate' WHEN 'media' THEN 'email' ELSE channel END AS channel,
               campaign_budget, campaign_revenue, impressions, clicks FROM v_marketing""",
        ["campaign_budget", "campaign_revenue"]),
    "m07_discount_columns": ("""
        SELECT order_id, order_item_id, product_id, price_after_discount, round(discount_rate, 2) AS discount_rate,
               round(CASE WHEN 1 - round(discount_rate, 2) = 0 THEN NULL
                          ELSE price_after_discount / (CAST(1.0 AS DOUBLE) - round(discount_rate, 2)) END, 2) AS price_before_discount
        FROM v_items""", ["price_after_discount", "discount_rate", "price_before_discount"]),
    "m08_valid_discount_ranges": (f"SELECT * FROM ({HIST}) h WHERE count > 0", ["lower", "upper"]),
}
