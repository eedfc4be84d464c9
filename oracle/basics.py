"""DuckDB oracle SQL of the general operators over the driver tables (plans/basics.py)."""

from marketlens.functions.text import ACCENTED, PLAIN

_MONTHLY = "(SELECT l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)"
_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_DAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
_NAME = "list_extract([" + ", ".join(f"'{m}'" for m in _MONTHS) + "], CAST(month(o_orderdate) AS INT))"
_SCORE = "CAST(round((CAST(1.0 AS DOUBLE) - CAST(levenshtein({a}, {b}) AS DOUBLE) / greatest(length({a}), length({b}))) * 100) AS BIGINT)"
_LABELS = [(0, 10), (10, 20), (20, 40)]


def _cut(left_closed: bool) -> str:
    return "CASE " + " ".join(
        f"WHEN l_quantity >= {a} AND l_quantity < {b} THEN '[{a}, {b})'" if left_closed else f"WHEN l_quantity > {a} AND l_quantity <= {b} THEN '({a}, {b}]'"
        for a, b in _LABELS) + " END"


def _profile(col: str, kind: str) -> str:
    mean = "CAST(NULL AS DOUBLE)" if kind == "string" else f"avg({col})"
    return (f"SELECT '{col}' AS \"column\", '{kind}' AS dtype, count(DISTINCT {col}) AS n_distinct, count(*) - count({col}) AS n_null, "
            f"CAST(min({col}) AS VARCHAR) AS min_value, CAST(max({col}) AS VARCHAR) AS max_value, {mean} AS mean FROM customer")


_HAV = ("2 * CAST(6371.0 AS DOUBLE) * atan2(sqrt(h), sqrt(1.0 - h))")

SQL = {
    "s02_priorities_above": ("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice >= 100000 GROUP BY 1", []),
    "s03_suppliers_from_csv": ("SELECT * FROM supplier", ["s_acctbal"]),
    "s04_daily_orders_built_once": ("SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1", []),
    "s05_customers_by_segment": ("SELECT * FROM customer", ["c_acctbal"]),
    "s06_customers_as_csv": ("SELECT * FROM customer", ["c_acctbal"]),
    "s07_bundle_of_names": ("SELECT c_name AS name, 'customer' AS sheet FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier", []),
    "s09_evolved_customers": ("SELECT c_custkey, c_name, greatest(c_acctbal, 0.0) AS c_acctbal, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS note "
                              "FROM customer", ["c_acctbal"]),
    "f01_part_columns": ("SELECT p_partkey, p_retailprice, p_name FROM part", ["p_retailprice"]),
    "f02_renamed_parts": ("SELECT p_partkey AS product_id, p_name AS product_name, p_brand, p_type, p_size, p_retailprice FROM part", ["p_retailprice"]),
    "f03_parts_without_size": ("SELECT * EXCLUDE (p_size, p_brand) FROM part", ["p_retailprice"]),
    "f04_large_lines": ("SELECT * FROM lineitem WHERE l_quantity >= 30 AND l_returnflag = 'R'", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "f05_orders_of_1997": ("SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'", ["o_totalprice"]),
    "f06_known_customers": ("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)", ["c_acctbal"]),
    "f08_filled_delivery": ("SELECT * REPLACE (coalesce(order_delivered_customer_date, order_estimated_delivery_date) AS order_delivered_customer_date) "
                            "FROM v_orders", []),
    "f09_parsed_dates": ("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day FROM orders", []),
    "f10_replaced_flags": ("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE l_returnflag END "
                           "AS l_returnflag FROM lineitem", []),
    "f11_mapped_status": ("SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END AS status FROM orders", []),
    "f12_rule_then_map": ("""
        SELECT p_partkey, CASE WHEN p_name ILIKE '%ring%' THEN 'jewel' ELSE CASE p_type WHEN 'ECONOMY' THEN 'low' WHEN 'PROMO' THEN 'offer' END END AS label
        FROM part""", []),
    "f13_trimmed_names": ("SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name FROM customer", []),
    "f15_ranked_customers": ("SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row_index FROM customer", ["c_acctbal"]),
    "f16_largest_orders": ("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10", ["o_totalprice"]),
    "j01_orders_with_segment": ("SELECT o_orderkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey", ["o_totalprice"]),
    "j02_customers_and_orders": ("SELECT c_custkey, coalesce(o_orderkey, -1) AS o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey", []),
    "j03_star": ("""
        SELECT p_type, o_orderpriority, s_nationkey, count(*) AS n, sum(l_quantity) AS qty
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY 1, 2, 3""", ["qty"]),
    "j04_no_order_within_half_a_year": ("""
        SELECT o_orderkey, o_custkey, o_orderdate FROM orders o WHERE NOT EXISTS (
          SELECT 1 FROM orders r WHERE r.o_custkey = o.o_custkey AND r.o_orderdate > o.o_orderdate
                                   AND r.o_orderdate <= o.o_orderdate + INTERVAL 180 DAY)""", []),
    "j05_only_returned_pairs": ("""
        SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
        EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""", []),
    "j06_returned_parts": ("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')", []),
    "j07_days_before_last_order": ("""
        SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS BIGINT) AS days
        FROM orders""", []),
    "j08_last_order_of_customer": ("SELECT c_custkey, (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS last_order FROM customer", []),
    "j09_units_of_each_period": ("""
        WITH p AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period, CAST(date_trunc('month', o_orderdate) AS DATE) AS start FROM orders),
             d AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS v FROM lineitem GROUP BY 1)
        SELECT period, start, CAST(start + INTERVAL 1 MONTH AS DATE) AS "end", coalesce(sum(v), 0.0) AS units
        FROM p LEFT JOIN d ON day BETWEEN start AND CAST(start + INTERVAL 1 MONTH AS DATE) GROUP BY 1, 2, 3""", ["units"]),
    "j10_similar_part_names": (f"""
        WITH n AS (SELECT DISTINCT p_name FROM part),
             s AS (SELECT a.p_name, b.p_name AS candidate, {_SCORE.format(a='a.p_name', b='b.p_name')} AS score FROM n a CROSS JOIN n b),
             r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY score DESC, candidate) AS rank FROM s WHERE score >= 50)
        SELECT * FROM r WHERE rank <= 5""", []),
    "j11_best_name_in_brand": (f"""
        WITH q AS (SELECT DISTINCT p_brand, regexp_replace(p_name, '[aeiou]', '', 'g') AS p_name FROM part),
             c AS (SELECT DISTINCT p_brand, p_name AS other FROM part),
             s AS (SELECT q.p_brand, q.p_name, other, {_SCORE.format(a='q.p_name', b='other')} AS score FROM q JOIN c ON q.p_brand = c.p_brand),
             r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY score DESC, other) AS k FROM s WHERE score >= 50)
        SELECT q.p_brand, q.p_name, r.other AS match, coalesce(r.score, 0) AS match_score
        FROM q LEFT JOIN r ON r.p_brand = q.p_brand AND r.p_name = q.p_name AND r.k = 1""", []),
    "j12_parts_bought_together": ("""
        SELECT a.l_linenumber AS i, b.l_linenumber AS j, count(*) AS n, count(*) FILTER (WHERE a.l_partkey = b.l_partkey) AS same_part
        FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey GROUP BY 1, 2""", []),
    "j13_price_grid": ("""
        SELECT p_partkey, d * CAST(0.1 AS DOUBLE) AS discount, 1.0 + f * CAST(0.5 AS DOUBLE) AS factor,
               p_retailprice * (1.0 + f * CAST(0.5 AS DOUBLE)) * (1.0 - d * CAST(0.1 AS DOUBLE)) AS price
        FROM part CROSS JOIN range(4) a(d) CROSS JOIN range(3) b(f)""", ["discount", "factor", "price"]),
    "j14_customer_nation": ("SELECT c_custkey, c_nationkey AS n_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey", []),
    "a01_lines_by_flag": ("""
        SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, avg(l_quantity) AS avg_qty, min(l_extendedprice) AS least,
               max(l_extendedprice) AS most FROM lineitem GROUP BY 1, 2""", ["qty", "avg_qty", "least", "most"]),
    "a02_customers_by_priority": ("SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_distinct FROM orders GROUP BY 1", []),
    "a03_flag_status_counts": ("SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS \"n_F\", count(*) FILTER (WHERE l_linestatus = 'O') "
                               "AS \"n_O\" FROM lineitem GROUP BY 1", []),
    "a05_return_rate": ("SELECT l_linenumber, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) * 100.0 AS rate FROM lineitem GROUP BY 1", ["rate"]),
    "a06_status_shares": ("""
        WITH n AS (SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "n_F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "n_O",
                          count(*) FILTER (WHERE o_orderstatus = 'P') AS "n_P" FROM orders GROUP BY 1)
        SELECT *, "n_F" * CAST(100.0 AS DOUBLE) / nullif("n_F" + "n_O" + "n_P", 0) AS "n_F_share",
               "n_O" * CAST(100.0 AS DOUBLE) / nullif("n_F" + "n_O" + "n_P", 0) AS "n_O_share",
               "n_P" * CAST(100.0 AS DOUBLE) / nullif("n_F" + "n_O" + "n_P", 0) AS "n_P_share" FROM n""", ["n_F_share", "n_O_share", "n_P_share"]),
    "a07_weighted_line_number": ("SELECT l_returnflag, sum(l_linenumber * l_quantity) / sum(l_quantity) AS weighted_mean FROM lineitem GROUP BY 1",
                                 ["weighted_mean"]),
    "a08_last_priority": ("""
        SELECT o_custkey, o_orderpriority AS last_value FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) x WHERE k = 1""", []),
    "a09_usual_priority": ("""
        WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
        SELECT o_custkey, o_orderpriority FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS k FROM c) x WHERE k = 1""", []),
    "a10_first_priority": ("""
        SELECT o_custkey, coalesce(arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus = 'P'), arg_min(o_orderpriority, o_orderkey))
               AS o_orderpriority FROM orders GROUP BY 1""", []),
    "a11_priority_counts": ("SELECT o_orderpriority, count(*) AS count, round(count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM orders), 2) AS percent "
                            "FROM orders GROUP BY 1", ["percent"]),
    "a12_orders_of_customer": ("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids FROM orders GROUP BY 1", []),
    "a13_quantity_price_r": ("SELECT corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem", ["r"]),
    "a14_monthly_trend": (f"""
        SELECT l_linenumber, regr_slope(qty, x) AS slope, regr_intercept(qty, x) AS intercept, corr(x, qty) AS r
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_linenumber ORDER BY month) - 1 AS DOUBLE) AS x FROM {_MONTHLY} m) y GROUP BY 1""",
                          ["slope", "intercept", "r"]),
    "a16_customer_profile": (" UNION ALL ".join(_profile(*x) for x in [("c_custkey", "bigint"), ("c_nationkey", "int"), ("c_mktsegment", "string")]), ["mean"]),
    "a20_quantity_scalars": ("SELECT min(l_quantity) AS \"min\", max(l_quantity) AS \"max\", avg(l_quantity) AS mean, sum(l_quantity) AS \"sum\" FROM lineitem",
                             ["\"min\"", "\"max\"", "mean", "\"sum\""]),
    "a21_flag_means_and_overall": ("""
        WITH g AS (SELECT l_returnflag, round_even(avg(l_quantity) * 100.0, 0) / 100.0 AS qty FROM lineitem GROUP BY 1)
        SELECT * FROM g UNION ALL SELECT 'Overall', round_even(avg(qty) * 100.0, 0) / 100.0 FROM g""", ["qty"]),
    "a22_priority_report": ("SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS buyers, max(o_orderdate) AS last_order FROM orders "
                            "GROUP BY 1", []),
    "a23_any_priority": ("SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus "
                         "FROM orders GROUP BY 1", []),
    "w01_first_total_of_month": ("""
        SELECT o_custkey, period, o_totalprice AS first_value FROM (
          SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_totalprice,
                 row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey) AS k FROM orders) x
        WHERE k = 1""", ["first_value"]),
    "w02_previous_total": ("""
        SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
                              lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) x
        WHERE prev IS NOT NULL""", ["o_totalprice", "prev"]),
    "w03_monthly_change": (f"""
        SELECT l_linenumber, month, qty, coalesce((qty - prev) / nullif(prev, 0), 0.0) AS qty_pct_change
        FROM (SELECT *, lag(qty) OVER (PARTITION BY l_linenumber ORDER BY month) AS prev FROM {_MONTHLY} m) x""", ["qty", "qty_pct_change"]),
    "w04_previous_or_own_quantity": (f"""
        SELECT *, coalesce(lag(qty) OVER (PARTITION BY l_linenumber ORDER BY month), qty) AS prev FROM {_MONTHLY} m""", ["qty", "prev"]),
    "w05_running_quantity": (f"""
        SELECT *, sum(qty) OVER (PARTITION BY l_linenumber ORDER BY month ROWS UNBOUNDED PRECEDING) AS running FROM {_MONTHLY} m""", ["qty", "running"]),
    "w06_quantity_of_month_before": (f"""
        SELECT a.l_linenumber, a.month, a.qty, coalesce(b.qty, 0.0) AS prev_month FROM {_MONTHLY} a
        LEFT JOIN {_MONTHLY} b ON a.l_linenumber = b.l_linenumber AND a.month = CAST(b.month + INTERVAL 1 MONTH AS DATE)""", ["qty", "prev_month"]),
    "w07_scaled_balance": ("""
        SELECT c_custkey, c_acctbal, 1.0 - (c_acctbal - lo) / nullif(hi - lo, 0) AS scaled
        FROM customer CROSS JOIN (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) m""", ["c_acctbal", "scaled"]),
    "w08_price_bins": ("""
        SELECT p_partkey, p_type, p_retailprice, CAST(CASE WHEN hi = lo THEN 9 ELSE greatest(ceil((p_retailprice - lo) / (hi - lo) * 20) - 1, 0) END AS BIGINT) AS bin
        FROM (SELECT *, min(p_retailprice) OVER (PARTITION BY p_type) AS lo, max(p_retailprice) OVER (PARTITION BY p_type) AS hi FROM part) x""",
                       ["p_retailprice"]),
    "w09_segments_by_balance": ("""
        WITH m AS (SELECT c_mktsegment, avg(c_acctbal) AS a FROM customer GROUP BY 1)
        SELECT c_custkey, c_mktsegment, c_acctbal, r.k AS c_mktsegment_ranked FROM customer
        JOIN (SELECT c_mktsegment AS s, row_number() OVER (ORDER BY a, c_mktsegment) - 1 AS k FROM m) r ON r.s = c_mktsegment""", ["c_acctbal"]),
    "w10_customers_on_vehicles": ("""
        SELECT c_custkey, c_nationkey, i AS stop_index, CASE WHEN i // 5 < 3 THEN i // 5 ELSE -1 END AS vehicle
        FROM (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer) x""", []),
    "t01_top_parts": ("SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1 ORDER BY qty DESC, l_partkey LIMIT 10", ["qty"]),
    "t02_sorted_suppliers": ("SELECT * FROM supplier", ["s_acctbal"]),
    "t03_head_with_buffer": ("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 33", ["o_totalprice"]),
    "t04_largest_order": ("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1", ["o_totalprice"]),
    "t05_series_of_top_parts": ("""
        SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n, sum(l_quantity) AS qty FROM lineitem
        WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 5) GROUP BY 1, 2""", ["qty"]),
    "t06_all_names": ("SELECT c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, NULL FROM supplier", []),
    "t08_brands_and_types": ("SELECT DISTINCT p_brand, p_type FROM part", []),
    "x01_date_parts": ("""
        SELECT event_id, strftime(ts, '%Y-%m') AS month_key, CAST(ts AS DATE) AS day, hour(ts) AS hour, year(ts) AS year, month(ts) AS month,
               CAST(date_trunc('month', ts) AS DATE) AS month_start FROM events""", []),
    "x02_date_names": (f"""
        SELECT o_orderkey, substr({_NAME}, 1, 3) AS abbr, {_NAME} AS name, substr({_NAME}, 1, 3) || ' ' || year(o_orderdate) AS label,
               dayofweek(o_orderdate) AS weekday, list_extract([{", ".join(f"'{d}'" for d in _DAYS)}], CAST(dayofweek(o_orderdate) AS INT) + 1) AS weekday_name
        FROM orders""", []),
    "x03_month_numbers": ("SELECT o_orderkey, month(o_orderdate) AS month, true AS no_month FROM orders", []),
    "x04_elapsed": ("""
        SELECT order_id, CAST(floor(s / 86400) AS DOUBLE) AS days, round(s / 3600, 2) AS hours
        FROM (SELECT order_id, epoch(order_delivered_customer_date) - epoch(order_approved_at) AS s FROM v_orders) x""", ["days", "hours"]),
    "x05_moved_dates": ("""
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 45 AS DATE) AS later,
               CAST(date_trunc('month', o_orderdate) - INTERVAL 6 MONTH AS DATE) + CAST(day(o_orderdate) - 1 AS INT) AS half_year_before,
               o_orderdate < TIMESTAMP '1998-01-01' AS early FROM orders""", []),
    "x06_month_year_keys": ("SELECT strftime(o_orderdate, '%m-%Y') AS key, count(*) AS n FROM orders GROUP BY 1", []),
    "x07_seasons": ("""
        SELECT o_orderkey, CASE WHEN m = 12 AND d >= 24 THEN 'Holiday - Christmas' WHEN m = 11 AND d = 29 THEN 'Holiday - Black Friday'
               WHEN m = 11 AND d = 30 THEN 'Holiday - Cyber Monday' WHEN m = 8 THEN 'Seasonal - Back to School'
               WHEN m IN (5, 6) THEN 'Seasonal - Summer Sales' ELSE 'Regular' END AS by_day,
               CASE m WHEN 12 THEN 'Holiday - Christmas' WHEN 11 THEN 'Holiday - Cyber Monday' WHEN 8 THEN 'Seasonal - Back to School'
               WHEN 5 THEN 'Seasonal - Summer Sales' WHEN 6 THEN 'Seasonal - Summer Sales' ELSE 'Regular' END AS by_month
        FROM (SELECT o_orderkey, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders) x""", []),
    "x08_cyclic_months": ("SELECT o_orderkey, sin(2 * pi() * month(o_orderdate) / 12) AS sin, cos(2 * pi() * month(o_orderdate) / 12) AS cos, "
                          "month(o_orderdate) AS month FROM orders", ["sin", "cos"]),
    "x09_quantity_classes": (f"SELECT {_cut(False)} AS \"right\", {_cut(True)} AS \"left\", count(*) AS n FROM lineitem GROUP BY 1, 2", []),
    "x10_balance_tiers": ("SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'low' WHEN c_acctbal <= 5000 THEN 'middle' ELSE 'high' END AS tier FROM customer", []),
    "x11_distance_to_warehouse": (f"""
        SELECT o_orderkey, {_HAV} AS km FROM (
          SELECT o_orderkey, pow(sin((p2 - p1) / 2), 2) + cos(p1) * cos(p2) * pow(sin(dl / 2), 2) AS h FROM (
            SELECT o_orderkey, radians(-30.0 + c_nationkey * CAST(0.75 AS DOUBLE)) AS p1, radians(-30.0 + o_orderkey % 25 * CAST(0.75 AS DOUBLE)) AS p2,
                   radians(o_orderkey % 25 * CAST(0.5 AS DOUBLE)) - radians(c_nationkey * CAST(0.5 AS DOUBLE)) AS dl
            FROM orders JOIN customer ON o_custkey = c_custkey) a) b""", ["km"]),
    "x12_rounded": ("SELECT o_orderkey, round_even(o_totalprice / 7.0 * 100.0, 0) / 100.0 AS even, round(o_totalprice / 7.0, 2) AS away FROM orders",
                    ["even", "away"]),
    "x13_safe_arithmetic": ("""
        SELECT p_partkey, p_retailprice / nullif(CAST(p_size % 5 AS DOUBLE), 0) AS ratio,
               coalesce(p_retailprice / nullif(CAST(p_size % 5 AS DOUBLE), 0), 0.0) AS ratio_or_zero, greatest(p_retailprice - 1000.0, 0.0) AS above FROM part""",
                            ["ratio", "ratio_or_zero", "above"]),
    "x14_clean_texts": (f"""
        SELECT doc_id, md5(translate(text, '{ACCENTED}', '{PLAIN}')) AS plain,
               regexp_replace(trim(lower(translate(source, '{ACCENTED}', '{PLAIN}'))), '^`+', '') AS source FROM documents""", []),
    "x15_regex_steps": ("SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(p_name, '[aeiou]+', '*', 'g'), ' +', '_', 'g'), '\\*$', '') AS name "
                        "FROM part", []),
    "x16_keyword_rules": ("SELECT p_partkey, CAST(CASE WHEN p_name ILIKE '%small%' THEN 1 WHEN p_name ILIKE '%ring%' THEN 2 WHEN p_name ILIKE '%red%' THEN 3 ELSE 0 END "
                          "AS BIGINT) AS rule FROM part", []),
    "x17_title_and_message": ("""
        SELECT doc_id, md5(CASE WHEN doc_id % 3 <> 0 AND source IS NOT NULL THEN source || ' ' || text ELSE text END) AS joined FROM documents""", []),
    "x18_name_numbers": ("SELECT c_custkey, CAST(regexp_extract(c_name, 'Customer#(\\d+)', 1) AS BIGINT) AS number, "
                         "CASE WHEN starts_with(c_name, 'Customer#') THEN substr(c_name, 10) ELSE c_name END AS rest FROM customer", []),
    "x19_token_counts": ("SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS n_tokens FROM documents", []),
    "x20_event_parameters": ("SELECT event_id, CAST(nullif(regexp_extract(props, '\"k\": *(\\d+)', 1), '') AS BIGINT) AS k FROM events", []),
    "x21_calendar_spine": ("""
        WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
             d AS (SELECT month, CAST(unnest(generate_series(month, CAST(month + INTERVAL 1 MONTH AS DATE) - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM m),
             n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
        SELECT d.month, d.day, coalesce(n.n, 0) AS n FROM d LEFT JOIN n ON d.day = n.day""", []),
}
