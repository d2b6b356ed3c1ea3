"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

from . import shard

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
met AS (SELECT r, places.n, i, item_id FROM places JOIN windows USING (n, win)),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM met) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP2 = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
reach AS (
  SELECT r AS a, r AS b FROM words
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, c.component_id
FROM words w LEFT JOIN sizes USING (r)
JOIN (SELECT reach.a AS r, min(words.doc_id) AS component_id
      FROM reach JOIN words ON words.r = reach.b GROUP BY reach.a) c USING (r)
"""

OP5 = r"""
WITH messages AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(23 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
           + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM messages GROUP BY conv_id
"""

OP6 = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT * FROM rows
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT r AS a, r AS b FROM rows
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least USING (r) LEFT JOIN n USING (r)
"""

_NUMBER = "('0x' || substr(md5({}), 1, 15))::BIGINT"

OP8 = f"""
WITH RECURSIVE names AS (
  SELECT list({_NUMBER.format("'offset shard-' || i")} % {shard.SIZE} ORDER BY i) AS origin,
         list({_NUMBER.format("'step shard-' || i")} % ({shard.SIZE} - 1) + 1 ORDER BY i) AS step
  FROM range({shard.SHARDS}) t(i)),
filled AS (
  SELECT 0 AS turn, NULL::BIGINT AS slot, repeat('0', {shard.SIZE})::BIT AS taken
  UNION ALL
  SELECT turn + 1, next, set_bit(taken, next::INTEGER, 1)
  FROM (SELECT turn, taken,
               list_extract(list_filter(
                 list_transform(range({shard.SIZE}),
                   lambda j: (origin[turn % {shard.SHARDS} + 1] + j * step[turn % {shard.SHARDS} + 1]) % {shard.SIZE}),
                 lambda s: get_bit(taken, s::INTEGER) = 0), 1) AS next
        FROM filled, names WHERE turn < {shard.SIZE}))
SELECT doc_id, slot::INTEGER AS slot, ((turn - 1) % {shard.SHARDS})::INTEGER AS shard
FROM (SELECT doc_id, {_NUMBER.format("coalesce(doc_id::VARCHAR, '')")} % {shard.SIZE} AS slot FROM documents)
JOIN (SELECT slot, turn FROM filled WHERE turn > 0) USING (slot)
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": OP1,
        "op2_ngram_join": OP2,
        "op5_chat_format": OP5,
        "op6_near_vectors": OP6,
        "op8_shard": OP8,
    }
