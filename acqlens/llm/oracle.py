"""DuckDB SQL of the queries that SQL can state, written from their contracts.

op3, op5, op8 and op10 need a tokenizer, a fitted model or an order-dependent
packing; tests/llm holds them against brute force instead.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP2 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), w AS (SELECT hex, max(page_id) AS last FROM p GROUP BY hex),
groups AS (
  SELECT hex, string_agg(
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n >> 15) & 31), 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n >> 10) & 31), 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n >> 5) & 31), 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (n & 31), 1), '' ORDER BY g) AS base32
  FROM (SELECT hex, g, CAST('0x' || substr(hex, 1 + 5 * g, 5) AS INTEGER) AS n FROM w, range(8) t(g))
  GROUP BY hex
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, base32 AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM p JOIN w USING (hex) JOIN groups USING (hex)
"""

OP4 = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         -- each control character in a text costs one more
         len(text) + len(regexp_replace(text, '[^<\\[\\\\]', '', 'g')) AS t,
         len(role) + len(regexp_replace(role, '[^<\\[\\\\]', '', 'g')) AS r
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE role WHEN 'user' THEN 13 + t WHEN 'assistant' THEN 7 + t ELSE 19 + r + t END) AS BIGINT)
         AS formatted_chars
FROM n GROUP BY conv_id
"""

OP6 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT row_no, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, {_BLANK}), '{_UPPER}', '{_LOWER}') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE len(key) >= 20
  GROUP BY key HAVING count(DISTINCT row_no) >= 3
)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (keeper IS NOT NULL AND keeper IS DISTINCT FROM k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (keeper IS NULL OR keeper IS NOT DISTINCT FROM k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY row_no, k.doc_id
"""

OP9 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5
           THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))
           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
  FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(low, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(low, s.doc_id) AS kept
FROM s LEFT JOIN c ON s.doc_id = c.a
"""

# Turns after damage, numbered per conversation; then the least (cost, audit) of
# every state (0 nothing, 1 system, 2 user, 3 assistant last) turn by turn.
OP11 = r"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
  FROM conversations
), k AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                         lambda x, y: xor(x >> 1, 3988292384 * (x & 1)) + y))) % 20 AS kind
  FROM o
), d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM k)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen,
         trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
  FROM d
), f AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS letter,
         CASE WHEN core = '' THEN 'blank' WHEN seen THEN 'duplicate'
              WHEN right(core, 1) IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM n
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS turns
  FROM f GROUP BY conv_id
), moves AS (  -- what up to two inserts in a row do
  SELECT * FROM (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
    (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
    (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])) m(s, t, c, a, b)
), p(conv_id, i, state, cost, audit, body) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', []::VARCHAR[] FROM stats
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.audit, best.body
  FROM (
    SELECT f.conv_id, f.i, e.state, min({'cost': p.cost + m.c + e.cost + CASE WHEN e.edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
               'audit': p.audit || m.a || e.edit,
               'body': list_concat(p.body, list_concat(m.b,
                  CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
                              ELSE [CASE e.state WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END))}) AS best
    FROM p JOIN moves m ON m.s = p.state
      JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
      JOIN (SELECT unnest([0, 1, 2, 3]) AS s, unnest([0, 1, 2, 3]) AS state, 'D' AS edit, 2 AS cost, '' AS letter
            UNION ALL SELECT unnest([0, 1, 3, 2, 0]), unnest([2, 2, 2, 3, 1]), 'K', 0, unnest(['u', 'u', 'u', 'a', 's'])
            UNION ALL SELECT unnest([0, 1, 3, 2]), unnest([2, 2, 2, 3]), 'R', 1, '') e
        ON e.s = m.t AND (e.edit = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (e.edit <> 'K' OR e.letter = f.letter)
    GROUP BY f.conv_id, f.i, e.state)
), ends AS (
  SELECT p.conv_id, min({'cost': p.cost + m.c, 'audit': p.audit || m.a, 'body': list_concat(p.body, m.b)}) AS best
  FROM p JOIN stats ON stats.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = stats.turns
    JOIN moves m ON m.s = p.state AND m.t IN (0, 3)
  GROUP BY p.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), p AS (SELECT row_no, lang, unnest(pieces) AS piece FROM d
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3]) AS size) WHERE len(ws) >= size)
), f AS (SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, size, f, cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM c)
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.f AS a, h.f AS l, t.f AS r,
         1000000 * cuts.f * cuts.f // (h.f * t.f) AS score,
         row_number() OVER (PARTITION BY cuts.lang, cuts.phrase
                            ORDER BY 1000000 * cuts.f * cuts.f // (h.f * t.f), cut) AS place
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = cuts.head
            JOIN f t ON t.lang = cuts.lang AND t.phrase = cuts.tail
), inside AS (
  SELECT lang, phrase, max(longer) AS longer
  FROM (SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, f AS longer FROM c WHERE size = 3
        UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), f FROM c WHERE size = 3) GROUP BY ALL
), ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase,
         CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
  FROM scored s JOIN totals USING (lang) LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE place = 1 AND NOT coalesce(100 * longer >= 50 * a, false)
)
SELECT * FROM ranked WHERE rank <= 2000
"""

OP13 = """
WITH RECURSIVE r AS (SELECT row_number() OVER () AS row_no, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), v AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM r
  WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.row_no, a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.row_no <> b.row_no AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a, min(b) AS low FROM reach GROUP BY a
), n AS (SELECT row_no, count(*) AS n_links FROM links GROUP BY row_no)
SELECT r.vec_id, coalesce(n_links, 0) AS n_links, least(r.vec_id, coalesce(low, r.vec_id)) AS component_id,
       r.vec_id IS NOT DISTINCT FROM least(r.vec_id, coalesce(low, r.vec_id)) AS kept
FROM r LEFT JOIN n USING (row_no) LEFT JOIN c ON c.a = r.vec_id
"""

SQL: dict[str, str] = {
    "op1_threshold_top_k": OP1,
    "op2_dictionary_warc": OP2,
    "op4_chat_template": OP4,
    "op6_line_dedup": OP6,
    "op9_super_minhash": OP9,
    "op11_conversation_repair": OP11,
    "op12_setm_collocations": OP12,
    "op13_grid_order_join": OP13,
}
