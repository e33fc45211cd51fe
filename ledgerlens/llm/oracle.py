"""DuckDB SQL of the llm queries that SQL can express on whole tables.

The others rest on tokenizers, trained models or 64-bit hashes; tests hold them
against brute force, the tokenizers library or labels kept out of the training.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op1_minhash"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                             ELSE w END) AS sh FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
g AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, g.component_id,
       documents.doc_id = g.component_id AS kept
FROM documents JOIN g ON g.doc_id = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id
"""

SQL["op4_topk_search"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

SQL["op8_chat_formatting"] = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn></turn>') + 1 + CASE WHEN role = 'assistant' THEN 7 ELSE 6 END
           + length(replace(replace(role, '\', '\b'), '<', '\l'))
           + length(replace(replace(text, '\', '\b'), '<', '\l'))) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

SQL["op12_filter_audit"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
m AS (SELECT doc_id, part,
        (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
      FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, mask),
o AS (SELECT '' AS ord, 0 AS used UNION ALL
      SELECT ord || f, used + bit FROM o, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit) WHERE used & bit = 0),
s AS (SELECT ord AS filter_order, step, 1 << (ascii(ord[step]) - 65) AS bit,
             coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(ord[i]) - 65))), 0) AS before
      FROM o, range(1, 6) r(step) WHERE length(ord) = 5),
a AS (SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit = 0), 0) AS kept,
        coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
        coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
        coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS good_lost,
        coalesce(sum(bad) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM a
"""

SQL["op13_lexical_search"] = r"""
WITH q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
g AS (SELECT count(*) AS nd, sum(len(terms)) AS l FROM t WHERE len(terms) > 0),
p AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM t),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term, nd),
s AS (SELECT q.item_id, f.r, f.doc_id,
             sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (100 - 50 + CAST((50 * f.n * nd) // l AS BIGINT))))) AS score
      FROM f JOIN w USING (term) JOIN q USING (term), g GROUP BY q.item_id, f.r, f.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""
