"""DuckDB SQL for the queries that SQL can state; the others have brute-force tests."""

from __future__ import annotations

from pricewright.llm.quality_rules import STOP_WORDS

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^ \t\n\x0B\f\r]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_STOPS = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS.values() for w in line.split()}))

OP3 = f"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_FOLD}, {_ALNUM}) AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({_FOLD}, {_ALNUM}) AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS key
  FROM (SELECT item_id, w, least(len(w), 10) AS size,
               unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc_window AS (
  SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS key
  FROM (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) AS i
        FROM doc, (SELECT DISTINCT size FROM item_window))),
hit AS (SELECT doc_id, i, d.size, item_id FROM doc_window d JOIN item_window USING (key, size)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_FOLD}, {_SPACED}) AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM doc),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
         FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM pair JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v
         WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT reach.doc_id, edge.v FROM reach JOIN edge ON edge.u = reach.other)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN size USING (doc_id)
"""

OP5 = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_SPACED})) AS lines
  FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS key
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM doc)),
twice AS (SELECT doc_id, key FROM win GROUP BY doc_id, key HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, key)) GROUP BY doc_id),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(t, '[^!?]+', '', 'g')) AS BIGINT) AS n_marks,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes
  FROM doc LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                  greatest(n_words, 1) AS words FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / words BETWEEN 2.0 AND 15.0 AND n_symbols / words <= 0.25
       AND n_marks / words <= 0.3 AND n_stop_words / words >= 0.02
       AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AND n_echoes / words <= 0.3 AS kept
FROM failed
"""

OP9 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
read AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS line,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         sum(length('### : ') + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), ':', '\:'), '</', '<\/'))
             + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/'))
             + length(' </turn>') + 1) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(line) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM read
"""

OP12 = """
WITH usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
found AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
        range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b)) AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM found)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

ORACLES = {"op3_decontaminate": OP3, "op4_near_dup": OP4, "op5_quality_rules": OP5, "op9_chat": OP9,
           "op12_one_bit_search": OP12}
