"""DuckDB oracle SQL of stems, sentiment features and naive Bayes (R-03, R-16, R-17, R-20, R-21)."""

from marketlens.plans.sentiment import HELD_OUT_BELOW, LEAST_STEM, MAX_DF, MIN_DF, SMOOTHING, SUFFIXES, VOCABULARY
from oracle.reviews import CLEAN, REV, STOP

WITH = f"""WITH toks AS (SELECT review_id, list_filter(string_split(tokens_text, ' '), lambda x: length(x) >= 2) AS toks FROM {CLEAN} c),
     per AS (SELECT review_id, term, count(*) AS n FROM (SELECT review_id, unnest(toks) AS term FROM toks) u GROUP BY 1, 2),
     every AS (SELECT count(*) AS n_reviews FROM toks),
     vocab AS (SELECT term, df, n_reviews FROM (SELECT term, count(*) AS df, sum(n) AS total FROM per GROUP BY 1) g CROSS JOIN every
               WHERE df >= 7 AND df <= CAST(0.8 AS DOUBLE) * n_reviews ORDER BY total DESC, term LIMIT 300)"""

STEM = "CASE lang " + " ".join(f"WHEN '{lang}' THEN regexp_replace(w, '^(.{{{LEAST_STEM},}}?)({'|'.join(ends)})$', '\\1')"
                               for lang, ends in SUFFIXES.items()) + " ELSE w END"

# Naive Bayes over the tf-idf of the terms of the training reviews; a term that a review lacks counts as 0.
BAYES = f"""WITH toks AS MATERIALIZED (SELECT review_id, list_filter(regexp_extract_all(lower(review_text), '\\p{{L}}+|[^\\p{{L}}\\p{{N}} \\t-\\r]+'),
                                                              lambda x: NOT list_contains({STOP}, x)) AS toks FROM {REV} c),
     per AS MATERIALIZED (SELECT review_id, term, count(*) AS n FROM (SELECT review_id, unnest(toks) AS term FROM toks) u GROUP BY 1, 2),
     lab AS (SELECT doc_id AS review_id, CAST(1 - max(quality) AS DOUBLE) AS label FROM labels WHERE quality IS NOT NULL GROUP BY 1),
     rev AS MATERIALIZED (SELECT r.review_id, lab.label, substr(sha256(CAST(r.review_id AS VARCHAR)), 1, 2) < '{HELD_OUT_BELOW}' AS held_out
                          FROM {REV} r LEFT JOIN lab ON r.review_id = lab.review_id),
     train AS (SELECT review_id, label FROM rev WHERE label IS NOT NULL AND NOT held_out),
     every AS (SELECT count(*) AS n_all FROM train),
     vocab AS MATERIALIZED (SELECT term, df, n_all FROM (SELECT term, count(*) AS df, sum(n) AS total FROM per SEMI JOIN train ON per.review_id = train.review_id
                            GROUP BY 1) g CROSS JOIN every WHERE df >= {MIN_DF} AND df <= CAST({MAX_DF} AS DOUBLE) * n_all ORDER BY total DESC, term LIMIT {VOCABULARY}),
     x AS (SELECT review_id, per.term, n * (ln((CAST(1.0 AS DOUBLE) + n_all) / (CAST(1.0 AS DOUBLE) + df)) + CAST(1.0 AS DOUBLE)) AS x
           FROM per JOIN vocab ON per.term = vocab.term),
     feat AS MATERIALIZED (SELECT review_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY review_id)) AS x FROM x),
     size AS (SELECT label, count(*) AS n FROM train GROUP BY 1),
     seen AS (SELECT term, label, sum(x) AS s, sum(x * x) AS q FROM feat JOIN train USING (review_id) GROUP BY 1, 2),
     grid AS (SELECT vocab.term, size.label, size.n, coalesce(s, CAST(0.0 AS DOUBLE)) AS s, coalesce(q, CAST(0.0 AS DOUBLE)) AS q FROM vocab CROSS JOIN size
              LEFT JOIN seen ON seen.term = vocab.term AND seen.label = size.label),
     widest AS (SELECT max(q / n_all - power(s / n_all, 2)) AS widest FROM (SELECT term, sum(s) AS s, sum(q) AS q FROM grid GROUP BY 1) w CROSS JOIN every),
     fit AS MATERIALIZED (SELECT term, label, n, s / n AS mean, greatest(q / n - power(s / n, 2), CAST(0.0 AS DOUBLE)) + CAST({SMOOTHING} AS DOUBLE) * widest AS var
             FROM grid CROSS JOIN widest),
     none AS (SELECT sum(CASE WHEN label = 1 THEN 1.0 ELSE -1.0 END * (d + ln(n / CAST(n_all AS DOUBLE)))) AS none_odds
              FROM (SELECT label, n, sum(-(ln(var) + mean * mean / var) / 2) AS d FROM fit GROUP BY 1, 2) f CROSS JOIN every),
     chg AS (SELECT review_id, sum(CASE WHEN label = 1 THEN 1.0 ELSE -1.0 END * (mean * mean - power(x - mean, 2)) / var / 2) AS c
             FROM feat JOIN fit USING (term) GROUP BY 1),
     odds AS (SELECT rev.*, none_odds + coalesce(c, CAST(0.0 AS DOUBLE)) AS log_odds FROM rev LEFT JOIN chg USING (review_id) CROSS JOIN none),
     scored AS MATERIALIZED (SELECT *, round(log_odds, 9) AS score, 1 / (1 + exp(-log_odds)) AS probability, CAST(log_odds > 0 AS INTEGER) AS prediction FROM odds)"""

SQL = {
    "r16_count_features": (f"{WITH} SELECT review_id, per.term, n FROM per JOIN vocab ON per.term = vocab.term", []),
    "r17_tfidf_features": (f"""{WITH},
     x AS (SELECT review_id, per.term, n * (ln((CAST(1.0 AS DOUBLE) + n_reviews) / (CAST(1.0 AS DOUBLE) + df)) + CAST(1.0 AS DOUBLE)) AS x
           FROM per JOIN vocab ON per.term = vocab.term)
     SELECT review_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY review_id)) AS tfidf FROM x""", ["tfidf"]),
    "r03_stem_tokens": (f"""SELECT review_id, array_to_string(list_transform(string_split(tokens_text, ' '), lambda w: {STEM}), ' ') AS stemmed_text
     FROM {CLEAN} c""", []),
    "r21_score_bayes": (f"""{BAYES} SELECT review_id, CASE WHEN prediction = 1 THEN 'negative' ELSE 'positive' END AS sentiment, score AS log_odds,
     probability AS negative_probability FROM scored""", ["log_odds", "negative_probability"]),
    "r20_evaluate_bayes": (f"""{BAYES},
     test AS (SELECT * FROM scored WHERE label IS NOT NULL AND held_out),
     c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                  count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM test),
     a AS (SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) / count(*) AS auc
           FROM test p CROSS JOIN test n WHERE p.label = 1 AND n.label = 0)
     SELECT c.*, (tp + tn) / CAST(nullif(tp + fp + tn + fn, 0) AS DOUBLE) AS accuracy, tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS "precision",
            tp / CAST(nullif(tp + fn, 0) AS DOUBLE) AS recall, 2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE) AS f1, auc FROM c CROSS JOIN a""",
                           ["accuracy", '"precision"', "recall", "f1", "auc"]),
}
