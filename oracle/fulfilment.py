"""DuckDB oracle SQL of order fulfilment (O-*)."""

D = "DATE '2000-06-30'"
HIST = f"(SELECT * FROM v_order_data WHERE CAST(order_date AS DATE) BETWEEN {D} - 365 AND {D})"
LATE = f"""(SELECT product_id, shipping_mode, avg(CAST(delivery_status = 'Late delivery' AS DOUBLE)) AS late_delivery_probability
            FROM {HIST} h GROUP BY 1, 2)"""
SHIP = f"""(SELECT product_id, shipping_mode, avg(days_for_shipping_real) AS avg_shipping_time FROM {HIST} h GROUP BY 1, 2)"""
DEAD = f"""
    (SELECT o.order_id, o.order_item_id, o.product_id, o.shipping_mode, o.order_date, o.warehouse_id, o.order_country,
            o.order_region, o.order_state, o.order_city, o.profit AS order_profit, l.late_delivery_probability,
            coalesce(s.avg_shipping_time, CAST(o.days_for_shipment_scheduled AS DOUBLE)) AS avg_shipping_time,
            CAST(CAST(o.order_date AS DATE) + CAST(o.days_for_shipment_scheduled AS INTEGER) AS DATE) AS scheduled_delivery_date,
            CAST(date_diff('day', {D}, CAST(CAST(o.order_date AS DATE) + CAST(o.days_for_shipment_scheduled AS INTEGER) AS DATE)) AS BIGINT)
              AS days_till_scheduled_delivery
     FROM v_order_data o
     LEFT JOIN {LATE} l ON o.product_id = l.product_id AND o.shipping_mode = l.shipping_mode
     LEFT JOIN {SHIP} s ON o.product_id = s.product_id AND o.shipping_mode = s.shipping_mode
     WHERE CAST(o.order_date AS DATE) BETWEEN {D} - 2 AND {D})"""


def _inv(c):
    return f"CASE WHEN m.hi_{c} - m.lo_{c} = 0 THEN NULL ELSE (m.hi_{c} - d.{c}) / (m.hi_{c} - m.lo_{c}) END"


SCORE = f"""
    (SELECT d.*, d.late_delivery_probability * CAST(0.5 AS DOUBLE) + {_inv('days_till_scheduled_delivery')} * CAST(0.4 AS DOUBLE)
                 + {_inv('avg_shipping_time')} * CAST(0.3 AS DOUBLE)
                 + CASE WHEN m.hi_order_profit - m.lo_order_profit = 0 THEN NULL
                        ELSE (d.order_profit - m.lo_order_profit) / (m.hi_order_profit - m.lo_order_profit) END * CAST(0.1 AS DOUBLE)
                 AS priority_score
     FROM {DEAD} d JOIN (SELECT warehouse_id, min(days_till_scheduled_delivery) AS lo_days_till_scheduled_delivery,
                                      max(days_till_scheduled_delivery) AS hi_days_till_scheduled_delivery,
                                      min(avg_shipping_time) AS lo_avg_shipping_time, max(avg_shipping_time) AS hi_avg_shipping_time,
                                      min(order_profit) AS lo_order_profit, max(order_profit) AS hi_order_profit FROM {DEAD} z GROUP BY warehouse_id) m
       ON d.warehouse_id = m.warehouse_id)"""

SELECTED = f"""(SELECT * EXCLUDE (place) FROM (
    SELECT s.*, row_number() OVER (PARTITION BY warehouse_id ORDER BY priority_score DESC NULLS LAST, order_id, order_item_id, product_id,
                                   order_profit) AS place FROM {SCORE} s) z WHERE place <= 36)"""

COORD = f"""(SELECT s.*, g.geolocation_lat AS latitude, g.geolocation_lng AS longitude
             FROM {SELECTED} s LEFT JOIN v_geo g ON s.order_country = g.geolocation_city)"""


def assign(order: str) -> str:
    return f"""(WITH a AS (SELECT c.*, CAST(row_number() OVER (PARTITION BY warehouse_id ORDER BY {order}) - 1 AS BIGINT) AS row_index FROM {COORD} c),
                     b AS (SELECT a.*, CASE WHEN CAST(floor(row_index / 10) AS BIGINT) < 4 THEN CAST(floor(row_index / 10) AS BIGINT) END AS vehicle FROM a)
                SELECT b.*, CAST(row_number() OVER (PARTITION BY warehouse_id, vehicle ORDER BY row_index) AS BIGINT) AS stop FROM b)"""


FIFO = assign("order_date, order_id, order_item_id, product_id, order_profit")
DEPOT = """(SELECT s_suppkey AS warehouse_id, g.geolocation_lat AS latitude, g.geolocation_lng AS longitude
            FROM supplier JOIN v_geo g ON CAST(s_nationkey AS BIGINT) = CAST(g.geolocation_zip_code_prefix AS BIGINT))"""


def km(a: str, b: str, c: str, d: str) -> str:
    h = (f"(power(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) "
         f"* power(sin((radians({d}) - radians({b})) / 2), 2))")
    return f"(2 * 6371.0 * asin(least(1.0, sqrt({h}))))"


DISTANCES = f"""
    (WITH a AS (SELECT warehouse_id, row_index + 1 AS node, latitude, longitude FROM {FIFO} f),
          n AS (SELECT * FROM a UNION ALL SELECT warehouse_id, 0 AS node, latitude, longitude FROM {DEPOT} d
                WHERE warehouse_id IN (SELECT warehouse_id FROM a))
     SELECT i.warehouse_id, CAST(i.node AS BIGINT) AS i, CAST(j.node AS BIGINT) AS j, {km('i.latitude', 'i.longitude', 'j.latitude', 'j.longitude')} AS km
     FROM n i JOIN n j ON i.warehouse_id = j.warehouse_id)"""

ROUTES = f"""
    (WITH a AS (SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plng FROM {FIFO} f WHERE vehicle IS NOT NULL
                WINDOW w AS (PARTITION BY warehouse_id, vehicle ORDER BY stop)),
          p AS (SELECT warehouse_id, vehicle, count(*) AS n_stops, sum(CASE WHEN plat IS NULL THEN 0 ELSE {km('plat', 'plng', 'latitude', 'longitude')} END) AS legs,
                       min_by(latitude, stop) AS la1, min_by(longitude, stop) AS lo1, max_by(latitude, stop) AS la2, max_by(longitude, stop) AS lo2
                FROM a GROUP BY 1, 2),
          r AS (SELECT p.warehouse_id, p.vehicle, p.n_stops, legs + {km('d.latitude', 'd.longitude', 'la1', 'lo1')}
                       + {km('la2', 'lo2', 'd.latitude', 'd.longitude')} AS km FROM p JOIN {DEPOT} d ON p.warehouse_id = d.warehouse_id)
     SELECT * FROM r UNION ALL SELECT -1, -1, CAST(coalesce(sum(n_stops), 0) AS BIGINT), coalesce(sum(km), 0) FROM r)"""

# Names without accents (the stand-ins have one accented letter), lower case, trimmed, without leading backticks.
def _clean(c: str) -> str:
    return f"regexp_replace(trim(lower(replace({c}, 'à', 'a'))), '^`+', '')"


def _score(a: str, b: str) -> str:
    longest = f"greatest(length({a}), length({b}))"
    return (f"CAST(CASE WHEN {longest} = 0 THEN 100 ELSE round((CAST(1.0 AS DOUBLE) - levenshtein({a}, {b}) / CAST({longest} AS DOUBLE)) * 100) END AS BIGINT)")


WORLD = f"(SELECT DISTINCT {_clean('country')} AS country, {_clean('admin_name')} AS state FROM v_world_cities)"
PLACES = f"(SELECT DISTINCT {_clean('order_country')} AS country, {_clean('order_region')} AS state FROM v_order_data)"
MATCHED = f"""
    (WITH p AS {PLACES}, w AS {WORLD},
          cc AS (SELECT a.country, b.country AS matched_country, {_score('a.country', 'b.country')} AS score
                 FROM (SELECT DISTINCT country FROM p) a CROSS JOIN (SELECT DISTINCT country FROM w) b),
          c AS (SELECT country, matched_country FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY score DESC, matched_country) AS k FROM cc
                WHERE score >= 50) x WHERE k = 1),
          pl AS (SELECT p.country, p.state, c.matched_country FROM p LEFT JOIN c ON p.country = c.country),
          ss AS (SELECT q.matched_country, q.state, w.state AS matched_state, {_score('q.state', 'w.state')} AS matched_state_score
                 FROM (SELECT DISTINCT matched_country, state FROM pl) q JOIN w ON q.matched_country = w.country),
          s AS (SELECT matched_country, state, matched_state, matched_state_score FROM (SELECT *, row_number() OVER (
                  PARTITION BY matched_country, state ORDER BY matched_state_score DESC, matched_state) AS k FROM ss WHERE matched_state_score >= 50) x WHERE k = 1)
     SELECT pl.matched_country, pl.state, pl.country, s.matched_state, s.matched_state_score
     FROM pl LEFT JOIN s ON pl.matched_country = s.matched_country AND pl.state = s.state)"""

_DEAD_D = ["order_profit", "late_delivery_probability", "avg_shipping_time"]

SQL = {
    "o10_distance_matrix": (f"SELECT * FROM {DISTANCES} x", ["km"]),
    "o13_route_distance": (f"SELECT * FROM {ROUTES} x", ["km"]),
    "o01_late_probability": (f"SELECT * FROM {LATE} l", ["late_delivery_probability"]),
    "o02_avg_shipping_time": (f"SELECT * FROM {SHIP} s", ["avg_shipping_time"]),
    "o03_delivery_deadlines": (f"SELECT * FROM {DEAD} d", _DEAD_D),
    "o04_priority_score": (f"SELECT * FROM {SCORE} s", _DEAD_D + ["priority_score"]),
    "o05_select_deliveries": (f"SELECT * FROM {SELECTED} s", _DEAD_D + ["priority_score"]),
    "o09_attach_coordinates": (f"SELECT * FROM {COORD} c", _DEAD_D + ["priority_score", "latitude", "longitude"]),
    "o11_assign_fifo": (f"SELECT * FROM {assign('order_date, order_id, order_item_id, product_id, order_profit')} x",
                        _DEAD_D + ["priority_score", "latitude", "longitude"]),
    "o12_assign_by_region": (f"SELECT * FROM {assign('order_region, order_state, order_city, order_id, order_item_id, product_id, order_profit')} x",
                             _DEAD_D + ["priority_score", "latitude", "longitude"]),
    "o06_country_candidates": (f"""
        SELECT country, candidate, score, CAST("rank" AS INTEGER) AS "rank" FROM (
          SELECT *, row_number() OVER (PARTITION BY country ORDER BY score DESC, candidate) AS "rank" FROM (
            SELECT a.country, b.country AS candidate, {_score('a.country', 'b.country')} AS score
            FROM (SELECT DISTINCT country FROM {PLACES} p WHERE country NOT IN (SELECT country FROM {WORLD} w)) a
            CROSS JOIN (SELECT DISTINCT country FROM {WORLD} w) b) c WHERE score >= 50) d WHERE "rank" <= 5""", []),
    "o07_map_locations": (f"SELECT * FROM {MATCHED} m", []),
    "o08_locate_cities": (f"""
        SELECT m.country, m.state, m.matched_country, m.matched_state, c.lat AS latitude, c.lng AS longitude
        FROM {MATCHED} m LEFT JOIN (SELECT matched_country, arg_min(lat, lat) AS lat, arg_min(lng, lat) AS lng FROM (
          SELECT {_clean('country')} AS matched_country, lat, lng FROM v_world_cities) w GROUP BY 1) c ON m.matched_country = c.matched_country""",
                          ["latitude", "longitude"]),
}
