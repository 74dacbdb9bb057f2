"""DuckDB SQL for the queries that SQL can express, beside what the operators' own modules hold."""

from __future__ import annotations

import string

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM w, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
    SELECT doc_id, i, w[i] AS word, CASE WHEN i + 12 <= len(w) THEN array_to_string(w[i:i + 12], ' ') END AS win
    FROM w, unnest(range(1, len(w) + 1)) t(i)),
f AS (SELECT win, min(doc_id) AS first FROM p WHERE win IS NOT NULL GROUP BY win),
m AS (SELECT p.doc_id, p.i, p.word, coalesce(f.first < p.doc_id, false) AS hit FROM p LEFT JOIN f ON p.win = f.win),
c AS (SELECT *, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM m)
SELECT d.doc_id, count(c.i)::BIGINT AS n_words, count(c.i) FILTER (WHERE c.gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.i) FILTER (WHERE NOT c.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

REPLY_TREES = r"""
WITH m AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
k AS (
    SELECT *, CASE role WHEN 'assistant' THEN text ELSE '' END AS learned,
           length('### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE '=' || role END || ': ')
           + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) + length('</turn>' || chr(10)) AS chars
    FROM m)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(string_agg(learned, '' ORDER BY turn, role, text))::BIGINT AS loss_chars, sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM k GROUP BY conv_id
"""

REPLY_BRANCHES = r"""
WITH RECURSIVE m AS (
    SELECT conv_id AS tree, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS node,
           coalesce(role, '') AS role, coalesce(text, '') AS text, coalesce(length(text) % 7, 0)::DOUBLE AS score
    FROM conversations WHERE conv_id IS NOT NULL),
k AS (
    SELECT *, '### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE '=' || role END || ': ' AS head,
           replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') AS body
    FROM m),
up AS (
    SELECT tree, node AS leaf, node, 0 AS up FROM m WHERE NOT EXISTS (SELECT 1 FROM m c WHERE c.tree = m.tree AND c.node > 1 AND c.node // 2 = m.node)
    UNION ALL SELECT tree, leaf, node // 2, up + 1 FROM up WHERE node > 1),
turns AS (SELECT up.leaf, up.up, k.*, length(head) AS n, length(body) AS b FROM up JOIN k ON k.tree = up.tree AND k.node = up.node),
ends AS (SELECT *, sum(n + b + 8) OVER (PARTITION BY tree, leaf ORDER BY up DESC) - 8 AS e FROM turns),
shown AS (
    SELECT tree, leaf, sum(score) AS branch_score, string_agg(head || body || '</turn>' || chr(10), '' ORDER BY up DESC) AS formatted,
           coalesce(string_agg((e - b)::BIGINT || ':' || e::BIGINT, ',' ORDER BY up DESC) FILTER (WHERE role = 'assistant'), '') AS loss
    FROM ends GROUP BY tree, leaf),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY branch_score DESC, leaf) AS rank FROM shown)
SELECT tree AS conv_id, leaf, rank::INTEGER AS rank, branch_score, sha256(formatted) AS formatted_sha256, loss FROM ranked WHERE rank <= 3
"""

_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# crc32 byte by byte, by a table made from its polynomial
RESAMPLING = rf"""
WITH RECURSIVE bits AS (
    SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS MATERIALIZED (SELECT i, c AS t FROM bits WHERE k = 8),
texts AS (
    SELECT row_number() OVER () AS id, doc_id, true AS ours, text FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, false, text FROM benchmark),
w AS MATERIALIZED (SELECT id, doc_id, ours, [x FOR x IN regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')] AS w FROM texts),
g AS MATERIALIZED (
    SELECT id, ours, array_to_string(w[i:i + n - 1], ' ') AS f, count(*) AS k
    FROM w, unnest(range(1, len(w) + 1)) a(i), unnest([1, 2, 3]) b(n) WHERE i + n - 1 <= len(w) GROUP BY ALL),
crc AS (
    SELECT f, hex(encode(f)) AS h, 4294967295::BIGINT AS c, 0 AS pos FROM (SELECT DISTINCT f FROM g)
    UNION ALL
    SELECT f, h, xor(c >> 8, t), pos + 1
    FROM crc JOIN tab ON tab.i = xor(c & 255, (instr('0123456789ABCDEF', h[2 * pos + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * pos + 2]) - 1)
    WHERE 2 * pos < len(h)),
bucket AS MATERIALIZED (SELECT f, xor(c, 4294967295) % 10000 AS b FROM crc WHERE 2 * pos = len(h)),
found AS MATERIALIZED (SELECT id, ours, b, sum(k)::BIGINT AS k FROM g JOIN bucket USING (f) GROUP BY ALL),
sums AS (
    SELECT i AS b, coalesce(sum(k) FILTER (WHERE ours), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (WHERE NOT ours), 0)::DOUBLE AS t
    FROM range(10000) r(i) LEFT JOIN found ON b = i GROUP BY i),
gain AS (SELECT b, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM sums),
total AS (SELECT id, sum(k)::BIGINT AS n_features, sum(k * gain)::BIGINT AS weight FROM found JOIN gain USING (b) WHERE ours GROUP BY id),
scored AS (
    SELECT w.doc_id, len(w.w) >= 20 AS able, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || w.doc_id)[:8])::BIGINT::DOUBLE + 0.5) / 4294967296))))::BIGINT AS score
    FROM w LEFT JOIN total USING (id) WHERE w.ours),
placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM placed
"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
    FROM documents, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) t(p)),
f AS MATERIALIZED (
    SELECT lang, n AS width, array_to_string(w[i:i + n - 1], ' ') AS phrase, count(*) AS f
    FROM pieces, unnest(range(1, len(w) + 1)) a(i), unnest([1, 2, 3, 4]) b(n) WHERE i + n - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cuts AS (
    SELECT lang, width, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS y
    FROM f, unnest(range(1, width)) t(k) WHERE width > 1),
scores AS (
    SELECT cuts.*, x.f AS l, y.f AS r, 2000000 * a::HUGEINT // (x.f + y.f) AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM best o WHERE o.lang = b.lang AND o.width > b.width AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * o.a::HUGEINT >= 80 * b.a::HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
