"""DuckDB oracle SQL of demand and inventory (I-*)."""

from oracle.supply import LEDGER

PI2 = "CAST(6.283185307179586 AS DOUBLE)"

MONTHLY = """(SELECT product_id, CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
                     sum(order_item_quantity) AS total_quantity
              FROM v_order_data WHERE CAST(order_date AS DATE) BETWEEN DATE '1998-12-01' AND DATE '1999-12-31'
              GROUP BY 1, 2, 3)"""

ANNUAL = f"""(SELECT product_id, sum(total_quantity) AS predicted_quantity FROM {MONTHLY} m
              WHERE order_year = 1999 GROUP BY 1)"""

EOQ = f"""(SELECT d.product_id, d.predicted_quantity, p.product_name, p.manufacturing_cost, p.daily_storage_cost,
                  p.manufacturing_time,
                  round_even(sqrt(CASE WHEN p.daily_storage_cost * 365 = 0 THEN NULL
                                       ELSE 2 * d.predicted_quantity * p.manufacturing_cost / (p.daily_storage_cost * CAST(365.0 AS DOUBLE)) END), 0)
                    AS economic_order_quantity,
                  round_even(d.predicted_quantity / CAST(52.0 AS DOUBLE), 0) AS forecasted_avg_weekly_demand,
                  round_even(round_even(d.predicted_quantity / CAST(52.0 AS DOUBLE), 0) * p.manufacturing_time, 0) AS reorder_point
           FROM {ANNUAL} d LEFT JOIN v_product_info p ON d.product_id = p.product_id)"""

START = f"""(SELECT product_id, current_stock FROM {LEDGER} x
             WHERE date = DATE '2000-01-01' AND product_id IN (SELECT product_id FROM v_product_info))"""

_EOQ_D = ["predicted_quantity", "manufacturing_cost", "daily_storage_cost", "economic_order_quantity",
          "forecasted_avg_weekly_demand", "reorder_point"]

SQL = {
    "i01_monthly_demand": (f"SELECT * FROM {MONTHLY} m", ["total_quantity"]),
    "i02_demand_features": (f"""
        SELECT * FROM (
          SELECT m.*, lag(total_quantity, 1) OVER (PARTITION BY product_id ORDER BY order_year, order_month) AS prev_quantity,
                 sin({PI2} * order_month / CAST(12.0 AS DOUBLE)) AS month_sin,
                 cos({PI2} * order_month / CAST(12.0 AS DOUBLE)) AS month_cos
          FROM {MONTHLY} m) x WHERE prev_quantity IS NOT NULL""",
        ["total_quantity", "prev_quantity", "month_sin", "month_cos"]),
    "i04_forecast_frame": (f"""
        WITH last AS (SELECT product_id, arg_max(total_quantity, order_year * 100 + order_month) AS last_quantity
                      FROM {MONTHLY} m GROUP BY 1),
             f AS (SELECT product_id, last_quantity, unnest(range(1, 13)) AS m FROM last)
        SELECT product_id, CAST(2000 AS BIGINT) AS order_year, CAST(m AS BIGINT) AS order_month,
               CASE WHEN m = 1 THEN last_quantity END AS prev_quantity,
               sin({PI2} * m / CAST(12.0 AS DOUBLE)) AS month_sin, cos({PI2} * m / CAST(12.0 AS DOUBLE)) AS month_cos
        FROM f""", ["prev_quantity", "month_sin", "month_cos"]),
    "i06_annual_demand": (f"SELECT * FROM {ANNUAL} a", ["predicted_quantity"]),
    "i07_eoq_rop": (f"SELECT * FROM {EOQ} e", _EOQ_D),
    "i08_starting_stock": (f"SELECT * FROM {START} s", ["current_stock"]),
    "i09_understocked": (f"""
        SELECT e.*, coalesce(s.current_stock, CAST(0.0 AS DOUBLE)) AS current_stock,
               CAST(coalesce(s.current_stock, 0) < e.reorder_point AS INTEGER) AS understocked
        FROM {EOQ} e LEFT JOIN {START} s ON e.product_id = s.product_id""", _EOQ_D + ["current_stock"]),
    "i10_holding_cost_actual": (f"""
        WITH j AS (SELECT l.product_id, l.date, l.current_stock, l.total_sold, p.daily_storage_cost, p.manufacturing_cost
                   FROM {LEDGER} l JOIN v_product_info p ON l.product_id = p.product_id
                   WHERE l.date < DATE '1997-01-01'),
             k AS (SELECT j.*, greatest(current_stock - (coalesce(lag(current_stock, 1) OVER (PARTITION BY product_id ORDER BY date), current_stock) - total_sold), CAST(0.0 AS DOUBLE)) AS order_quantity
                   FROM j),
             c AS (SELECT k.*, manufacturing_cost * order_quantity AS manufacturing_cost_day,
                          current_stock * daily_storage_cost AS holding_cost FROM k)
        SELECT product_id, date, current_stock, total_sold, order_quantity, manufacturing_cost_day, holding_cost,
               sum(manufacturing_cost_day) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_manufacturing_cost,
               sum(holding_cost) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_holding_cost
        FROM c""", ["current_stock", "total_sold", "order_quantity", "manufacturing_cost_day", "holding_cost",
                    "total_manufacturing_cost", "total_holding_cost"]),
    "i13_monthly_units_by_product": ("""
        SELECT product_id, CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
               sum(order_item_quantity) AS total_quantity
        FROM v_order_data WHERE order_date < TIMESTAMP '1997-01-01 00:00:00' GROUP BY 1, 2, 3""", ["total_quantity"]),
}
