"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# A-Z and a-z, the word expressions of the contracts.
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP6 = f"""
WITH u AS (SELECT page_id, url, strpos(url, '://') AS found FROM pages),
r AS (SELECT page_id, CASE WHEN found > 0 THEN substr(url, CAST(found AS INTEGER) + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, {AZ}) AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(rule_host, rule_path, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
words(word) AS (SELECT unnest(['adult', 'ads', 'adserver', 'bet', 'bets', 'betting', 'casino', 'escort', 'gambling', 'malware',
    'phishing', 'pills', 'poker', 'porn', 'sex', 'spam', 'torrent', 'track', 'tracker', 'viagra', 'warez', 'xxx'])),
best AS (SELECT p.*, (SELECT max({{'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'action': action}}) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS won,
    (SELECT min(word) FROM words WHERE list_contains(regexp_extract_all(host, '[0-9a-z]+'), word)) AS unwanted FROM p)
SELECT page_id, host, path, won.rule AS rule, coalesce(won.action, CASE WHEN unwanted IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN won IS NULL THEN unwanted END AS method_rule FROM best
"""

OP3 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, k, k + least(len(w), 10) - 1), ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM w),
hit AS (SELECT DISTINCT d.doc_id, d.k, p.size, p.item_id FROM (SELECT doc_id, k, size, array_to_string(list_slice(w, k, k + size - 1), ' ') AS win
            FROM pos, (SELECT DISTINCT size FROM pat) WHERE k + size - 1 <= len(w)) d JOIN pat p ON d.size = p.size AND d.win = p.win),
words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS word FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(list_slice(w, k, k + 12), ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM w WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS smallest FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS k FROM win JOIN least USING (s) WHERE smallest < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 3), ' ') AS s
         FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * n_common >= 85 * (x.n + y.n - n_common)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, min(reach.b)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN reach ON w.doc_id = reach.a GROUP BY w.doc_id
"""



def _op12(rounds: int = 10, k: int = 8) -> str:
    """Lloyd's rounds one after the other: c0, a0, c1, a1, ..."""
    parts = [f"""kept AS MATERIALIZED (SELECT vec_id, x, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) AS r
      FROM (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * 1024) AS BIGINT)) AS x FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64)),
e AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(x) AS v FROM kept),
c0 AS MATERIALIZED (SELECT CAST(r - 1 AS INTEGER) AS c, i, v FROM e WHERE r <= {k})"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS m FROM (SELECT r, c, CAST(sum((e.v - t.v) * (e.v - t.v)) AS BIGINT) AS d
      FROM e JOIN c{n} t ON e.i = t.i GROUP BY r, c) GROUP BY r)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (SELECT t.c, t.i, coalesce(u.v, t.v) AS v FROM c{n} t LEFT JOIN (
      SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v FROM (SELECT m.c AS c, i, sum(v) AS s, count(*) AS n FROM e JOIN a{n} USING (r) GROUP BY ALL)) u
      ON t.c = u.c AND t.i = u.i)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, m.c AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) h ON h.c = m.c
"""


SQL = {"op9_similarity_join": OP9, "op5_substring_dedup": OP5, "op3_decontaminate": OP3, "op6_url_filter": OP6, "op12_centroids": _op12()}
