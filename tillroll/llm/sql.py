"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

# Op 1: the four rules from longest to shortest; else listed urls, those on hosts with a spam term as a word of a label.
OP1 = r"""
WITH s AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
c AS (SELECT *, host || regexp_replace(path, '/+$', '') AS canonical FROM p),
listed AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|[.-])(casino|pills|bets|ads|spam|adult)([.-]|$)')),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM c)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

# Op 4: every 35-word window by its words; a word goes if a repeated window covers it.
OP4 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS x
        FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, i FROM win WHERE x IN (SELECT x FROM win GROUP BY x HAVING count(*) > 1)),
hit AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM rep),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n
         FROM words ANTI JOIN hit USING (r, j) GROUP BY r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

# Op 6: every row is a message; the template of chat.py.
OP6 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (SELECT *, length(role) + length(text) + length('[ROLE][TEXT][/TEXT]')
    + length(regexp_replace(role || text, '[^~<\[]', '', 'g')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(chars) + length('<s></s>'))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

# Op 8: base figures over words and windows, then the line rules of linerules.py.
OP8 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT r, i, list_slice(w, i, i + 4) AS x FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) > 5)),
twice AS (SELECT r, x FROM win GROUP BY r, x HAVING count(*) > 1),
cover AS (SELECT r, count(*) AS n_repeat FROM (
    SELECT DISTINCT r, unnest(range(i, i + 5)) AS j FROM win SEMI JOIN twice USING (r, x)) GROUP BY r),
split AS (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
total AS (SELECT r, count(*) AS n FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
lines AS (SELECT r, line, min(i) AS i FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
judged AS (SELECT r, i, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    len(regexp_extract_all(line, '!!+([\x20\x09-\x0D]|$)')) AS shouted,
    len(regexp_extract_all(line, '!([\x20\x09-\x0D]|$)')) AS called,
    len(regexp_extract_all(line, '[\x20\x09-\x0D][|•·»›]([\x20\x09-\x0D]|$)')) AS cells,
    regexp_matches(line, '[.!?;:,]') AS stops, regexp_matches(line, '[.!?:;,…"''”’)\]][\x20\x09-\x0D]*$') AS stopped,
    regexp_matches(lower(line), 'cookie|javascript|all rights reserved|terms of use|privacy policy|subscribe to') AS phrase,
    regexp_matches(lower(line), 'click here|read more|sign in|sign up|log in|share this|add to cart|skip to content') AS button
  FROM lines),
ruled AS (SELECT *, symbols * 10 > chars OR shouted * 2 > words OR (words >= 3 AND called * 4 >= words * 3) OR (words > 60 AND NOT stops)
      OR (cells >= 1 AND cells * 4 >= words) OR (phrase AND words <= 30) OR (button AND words <= 8) AS bad,
    words <= 4 AND NOT stopped AS short FROM judged),
near AS (SELECT *, coalesce(lag(short, 1) OVER l, false) AS b1, coalesce(lag(short, 2) OVER l, false) AS b2,
    coalesce(lead(short, 1) OVER l, false) AS a1, coalesce(lead(short, 2) OVER l, false) AS a2 FROM ruled WINDOW l AS (PARTITION BY r ORDER BY i)),
good AS (SELECT r, count(*) AS n, sum(chars) FILTER (NOT bad AND NOT (short AND ((b1 AND (b2 OR a1)) OR (a1 AND a2)))) AS kept_chars
  FROM near GROUP BY r),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (coalesce(total.n, 0) - coalesce(good.n, 0))::BIGINT AS n_dup_lines,
    coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(kept_chars, 0)::BIGINT AS n_kept_chars
  FROM w LEFT JOIN cover USING (r) LEFT JOIN total USING (r) LEFT JOIN good USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 50 * word_chars <= 100 * n_kept_chars AS kept FROM b
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
           ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

OP12 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, o.r AS r, o.vec_id AS vec_id, a.label = o.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.x, o.x), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v o ON a.r <> o.r AND len(a.x) = len(o.x) WHERE a.vec_id % 50 = 0),
pos AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) AS k FROM s WHERE same QUALIFY k <= 5)
SELECT pos.anchor_id, pos.vec_id AS positive_id,
    row_number() OVER (PARTITION BY pos.ar, pos.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r)::INTEGER AS rank,
    n.vec_id AS negative_id, pos.score AS positive_score, n.score AS negative_score
FROM pos JOIN s n ON n.ar = pos.ar AND NOT n.same AND 50 * pos.score <= 100 * n.score AND 100 * n.score <= 95 * pos.score
QUALIFY rank <= 3
"""

SQL: dict[str, str] = {"op1_urls": OP1, "op4_substring": OP4, "op6_chat": OP6, "op8_line_rules": OP8, "op11_fim": OP11,
                       "op12_negatives": OP12}
