"""DuckDB SQL for the queries that SQL can express, written from their definitions and not from the operators."""

from __future__ import annotations

from . import op6_quality_rules

TOKENS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH t AS (SELECT doc_id, {TOKENS.format("coalesce(text, '')")} AS w FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM t)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM wins) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM twice, (SELECT unnest(range(0, 35)) AS k)),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM t),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)"""

OP4 = f"""
WITH RECURSIVE t AS (SELECT doc_id, {TOKENS.format(ASCII_LOWER)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM t UNION SELECT reach.doc_id, b FROM reach JOIN link ON r = a)
SELECT t.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, t.doc_id = min(r) AS kept FROM t JOIN reach ON reach.doc_id = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id GROUP BY t.doc_id"""

#: Five hexadecimal digits are four digits of base 32.
_B32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, {5 * g + 1}, 5))::INT // {32**p}) % 32 + 1, 1)" for g in range(8) for p in (3, 2, 1, 0))
OP7 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages), f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, strlen(x)::BIGINT AS payload_bytes, {_B32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""

_GRAMS = "SELECT {k}, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT {k}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM {t} WHERE len(w) > 0)"
OP8 = f"""
WITH t AS (SELECT doc_id, {TOKENS.format("lower(coalesce(text, ''))")} AS w FROM documents), b AS (SELECT item_id, {TOKENS.format("lower(coalesce(text, ''))")} AS w FROM benchmark),
d AS ({_GRAMS.format(k="doc_id", t="t")}), q AS ({_GRAMS.format(k="item_id", t="b")}),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1), m AS (SELECT item_id, count(*) AS m FROM q GROUP BY 1), v AS (SELECT item_id, s, count(*) AS v FROM q GROUP BY ALL),
hit AS (SELECT DISTINCT doc_id, item_id, d.i AS i FROM d JOIN q USING (s)),
cand AS (SELECT doc_id, item_id, m, n FROM hit JOIN m USING (item_id) JOIN n USING (doc_id) GROUP BY ALL HAVING count(*) >= 0.75 * m),
win AS (SELECT doc_id, item_id, m, least(n, m) AS size, unnest(range(1, greatest(n - m, 0) + 2)) AS st FROM cand),
have AS (SELECT win.doc_id, win.item_id, st, m, size, s, count(*) AS w FROM win JOIN d ON d.doc_id = win.doc_id AND d.i BETWEEN st AND st + m - 1 GROUP BY ALL),
sim AS (SELECT doc_id, item_id, st, sum(least(w, coalesce(v, 0))) AS shared, any_value(m) + any_value(size) - sum(least(w, coalesce(v, 0))) AS either FROM have LEFT JOIN v USING (item_id, s) GROUP BY ALL),
found AS (SELECT doc_id, item_id, max(shared / either) AS similarity FROM sim WHERE 100 * shared >= 75 * either GROUP BY ALL),
agg AS (SELECT doc_id, count(*) AS k, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS item_ids, max(similarity) AS similarity FROM found GROUP BY 1)
SELECT doc_id, coalesce(k, 0)::BIGINT AS n_items, item_ids, round(similarity, 6) AS similarity, k IS NOT NULL AS contaminated, k IS NULL AS kept FROM documents LEFT JOIN agg USING (doc_id)"""

ORACLE_SQL = {
    "op2_substring_dedup": OP2,
    "op4_near_dedup": OP4,
    "op6_quality_rules": op6_quality_rules.oracle_sql(),
    "op7_warc": OP7,
    "op8_decontaminate": OP8,
}
