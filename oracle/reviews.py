"""DuckDB oracle SQL of reviews and text (R-*)."""

from marketlens.functions.text import LANGUAGE_NAMES, REVIEW_REGEX_STEPS, default_stopwords

FIRST = """(SELECT order_id, product_id FROM (
              SELECT order_id, product_id, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id) AS rn
              FROM v_items) z WHERE rn = 1)"""

REV = f"""(SELECT * FROM (
    SELECT r.review_id, r.order_id, f.product_id, t.product_category_name_english AS product_category, t.broad_category,
           r.review_score,
           CASE WHEN r.review_comment_title IS NOT NULL THEN r.review_comment_title || ' ' || r.review_comment_message
                ELSE r.review_comment_message END AS review_text,
           r.review_creation_date, r.review_answer_timestamp, r.lang
    FROM v_reviews r JOIN {FIRST} f ON r.order_id = f.order_id
    JOIN v_products p ON f.product_id = p.product_id
    JOIN v_cat t ON p.product_category_name = t.product_category_name) x WHERE review_text IS NOT NULL)"""


def _clean(expr: str) -> str:
    out = expr
    for pat, rep in REVIEW_REGEX_STEPS:
        out = f"regexp_replace({out}, '{pat}', '{rep}', 'g')"
    return out


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = "CASE lang " + " ".join(f"WHEN '{lg}' THEN {_list(default_stopwords(LANGUAGE_NAMES[lg]))}"
                               for lg in ["en", "fr", "de", "es"]) + " ELSE []::VARCHAR[] END"

CLEAN = f"""(SELECT review_id, lang, review_score, clean_text,
                    array_to_string(list_filter(list_filter(string_split_regex(lower(clean_text), '\\s+'), lambda x: x <> ''),
                                                lambda x: NOT list_contains({STOP}, x)), ' ') AS tokens_text
             FROM (SELECT review_id, lang, review_score, {_clean('review_text')} AS clean_text FROM {REV} r) c)"""

SENT = f"""(SELECT review_id, review_score, broad_category,
                   CASE WHEN review_score <= 2 THEN 'negative' ELSE 'positive' END AS sentiment FROM {REV} r)"""

HOURS = f"""(SELECT review_id, review_score, product_category, broad_category,
                    round_even((((epoch_us(review_answer_timestamp) - epoch_us(review_creation_date)) / CAST(1000000.0 AS DOUBLE)) / CAST(3600.0 AS DOUBLE)) * 100.0, 0) / 100.0 AS response_hours
             FROM {REV} r)"""


def _vc(src: str, col: str) -> str:
    return f"""WITH c AS (SELECT {col}, count(*) AS count FROM {src} s GROUP BY 1)
               SELECT {col}, count, round_even(((count * CAST(100.0 AS DOUBLE)) / (SELECT sum(count) FROM c)) * 100.0, 0) / 100.0 AS percent FROM c"""


TOKS = f"""(SELECT s.sentiment, list_filter(string_split(c.tokens_text, ' '), lambda x: length(x) >= 2) AS toks
            FROM {CLEAN} c JOIN {SENT} s ON c.review_id = s.review_id)"""

SQL = {
    "r01_review_table": (f"SELECT * FROM {REV} r", []),
    "r02_clean_reviews": (f"SELECT * FROM {CLEAN} c", []),
    "r04_response_hours": (f"SELECT * FROM {HOURS} h", ["response_hours"]),
    "r05_label_sentiment": (f"SELECT * FROM {SENT} s", []),
    "r06_score_distribution": (_vc(REV, "review_score"), ["percent"]),
    "r07_sentiment_distribution": (_vc(SENT, "sentiment"), ["percent"]),
    "r08_top_ngrams": (f"""
        WITH g AS (SELECT sentiment, CAST(n AS BIGINT) AS n,
                          unnest(list_transform(range(0, len(toks) - n + 1), lambda i: array_to_string(list_slice(toks, i + 1, i + n), ' '))) AS ngram
                   FROM {TOKS} t CROSS JOIN (VALUES (1), (2), (3)) v(n) WHERE len(toks) >= n),
             c AS (SELECT sentiment, n, ngram, count(*) AS count FROM g GROUP BY 1, 2, 3),
             r AS (SELECT c.*, CAST(row_number() OVER (PARTITION BY sentiment, n ORDER BY count DESC, ngram) AS BIGINT) AS rank FROM c)
        SELECT * FROM r WHERE rank <= 10""", []),
    "r09_word_frequency": (f"""
        WITH w AS (SELECT s.sentiment, unnest(string_split(c.tokens_text, ' ')) AS word
                   FROM {CLEAN} c JOIN {SENT} s ON c.review_id = s.review_id),
             c AS (SELECT sentiment, word, count(*) AS count FROM w WHERE word <> '' GROUP BY 1, 2),
             r AS (SELECT c.*, CAST(row_number() OVER (PARTITION BY sentiment ORDER BY count DESC, word) AS BIGINT) AS rank FROM c)
        SELECT * FROM r WHERE rank <= 50""", []),
    "r11_sentiment_by_category": (f"""
        WITH s AS (SELECT broad_category, sentiment, count(*) AS count FROM {SENT} x GROUP BY 1, 2)
        SELECT s.*, CAST(sum(count) OVER (PARTITION BY broad_category) AS BIGINT) AS category_total FROM s""", []),
    "r12_sentiment_share_by_category": (f"""
        WITH s AS (SELECT broad_category, count(*) FILTER (WHERE sentiment = 'negative') AS neg,
                          count(*) FILTER (WHERE sentiment = 'positive') AS pos FROM {SENT} x GROUP BY 1)
        SELECT broad_category, round_even(((neg * CAST(100.0 AS DOUBLE)) / (neg + pos)) * 10.0, 0) / 10.0 AS negative_pct,
               round_even(((pos * CAST(100.0 AS DOUBLE)) / (neg + pos)) * 10.0, 0) / 10.0 AS positive_pct FROM s""",
        ["negative_pct", "positive_pct"]),
    "r13_response_time_by_score": (f"""
        SELECT CASE WHEN review_score <= 2 THEN 'negative' ELSE 'positive' END AS sentiment, review_score,
               avg(response_hours) AS avg_response_hours FROM {HOURS} h GROUP BY 1, 2""", ["avg_response_hours"]),
    "r14_response_time_by_category": (f"""
        SELECT broad_category, avg(response_hours) AS avg_response_hours FROM {HOURS} h GROUP BY 1""",
        ["avg_response_hours"]),
    "r15_rating_trend": (f"""
        WITH top AS (SELECT product_id FROM {REV} r GROUP BY 1 ORDER BY count(*) DESC, product_id LIMIT 3),
             m AS (SELECT r.product_id, CAST(date_trunc('month', r.review_creation_date) AS DATE) AS month,
                          avg(r.review_score) AS avg_score
                   FROM {REV} r JOIN top ON r.product_id = top.product_id GROUP BY 1, 2),
             i AS (SELECT m.*, CAST(row_number() OVER (PARTITION BY product_id ORDER BY month) - 1 AS DOUBLE) AS idx FROM m),
             f AS (SELECT product_id, regr_slope(avg_score, idx) AS slope, regr_intercept(avg_score, idx) AS intercept FROM i GROUP BY 1)
        SELECT i.*, f.slope, f.intercept, f.intercept + f.slope * i.idx AS fitted FROM i JOIN f ON i.product_id = f.product_id""",
        ["avg_score", "idx", "slope", "intercept", "fitted"]),
    "r10_avg_score_by_category": (f"""
        WITH g AS (SELECT broad_category, round_even(avg(review_score) * CAST(100.0 AS DOUBLE), 0) / CAST(100.0 AS DOUBLE) AS avg_score FROM {REV} r GROUP BY 1)
        SELECT * FROM g UNION ALL
        SELECT 'Overall', round_even(CAST(sum(CAST(avg_score AS DECIMAL(34,12))) AS DOUBLE) / count(*) * CAST(100.0 AS DOUBLE), 0) / CAST(100.0 AS DOUBLE) FROM g
        HAVING count(*) > 0""", ["avg_score"]),
}
