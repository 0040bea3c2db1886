"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

# Positions in the hashed order of each source and whole rounds of a source replace the schedule: what a source's slots
# take together is its target, round after round.
MIX = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1 AS ord FROM sizes),
weights AS (SELECT *, ord % 3 + 1 AS w FROM weighed),
filled AS (
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words,
         sum(w) OVER (ORDER BY source_size / w, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         sum(source_size) OVER () AS total
  FROM weights
), level AS (
  SELECT min(CAST(total - full_words AS DOUBLE) / rest) FILTER (3 * source_size * rest > (total - full_words) * w) AS nothing,
         arg_min(total - full_words, (source_size / w, ord)) FILTER (3 * source_size * rest > (total - full_words) * w) AS words_left,
         arg_min(rest, (source_size / w, ord)) FILTER (3 * source_size * rest > (total - full_words) * w) AS w_left
  FROM filled
), targets AS (
  SELECT source, source_size,
         CASE WHEN words_left IS NULL THEN CAST(3 * source_size AS DOUBLE)
              ELSE least(CAST(3 * source_size AS DOUBLE), CAST(words_left AS DOUBLE) * w / w_left) END AS target
  FROM weights, level
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h ROWS UNBOUNDED PRECEDING) - s.size AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE goal // source_size * size + greatest(0, least(size, goal % source_size - start)) END::BIGINT AS taken
FROM placed
"""


# Windows of 13 words by text; a document's hit words are those of its windows that an item has.
DECONTAMINATE = r"""
WITH lower_docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), lower_items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM lower_items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lower_docs, lengths WHERE len(w) >= n)
), hits AS (SELECT d.r, d.i, d.n, t.item FROM doc_windows d JOIN item_windows t USING (n, words)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lower_docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


WARC = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), owned AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS owner FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND owner IS NOT NULL AND page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM owned
"""


FILTER_AUDIT = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), told AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), worded AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), failing AS (
  SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS f
  FROM worded w LEFT JOIN told USING (doc_id)
), counted AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, f),
steps AS (
  SELECT part, f, n, good, toxic, filter_order, step, substr(filter_order, step, 1) AS x,
         translate(substr(filter_order, 1, step - 1), f, '') <> substr(filter_order, 1, step - 1) AS gone
  FROM counted, orders, unnest(range(1, 6)) AS s(step)
), summed AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, x,
         coalesce(sum(n) FILTER (NOT gone AND NOT contains(f, x)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT gone AND contains(f, x)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND contains(f, x)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (f = x), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND contains(f, x)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND contains(f, x)), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM summed
"""


# CRC-32 is a fold over bytes with a table of 256 remainders, each eight steps of division. Near words meet in a word
# with one place masked, or in one with a place left out.
SPELLING = r"""
WITH RECURSIVE division AS (
  SELECT b, 0 AS step, b::BIGINT AS r FROM range(256) AS bytes(b)
  UNION ALL
  SELECT b, step + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM division WHERE step < 8
), remainders AS (SELECT list(r ORDER BY b) AS t FROM division WHERE step = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[a-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents
), counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(id || ':' || run))),
             lambda i: ('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2))::BIGINT)),
             lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1])), 4294967295) AS h
  FROM counted, remainders
), slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
  SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), near AS (
  SELECT p.word, q.word AS near, q.n AS near_n FROM places p JOIN places q ON p.a = q.a AND p.b = q.b AND p.word <> q.word
  UNION
  SELECT p.word, v.word, v.n FROM places p JOIN vocabulary v ON v.word = p.a || p.b
  UNION
  SELECT v.word, p.word, p.n FROM places p JOIN vocabulary v ON v.word = p.a || p.b
), ranked AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near COLLATE "C") AS place
  FROM near
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND place = 1
), followed AS (
  SELECT word, word AS at, form AS ahead FROM formed
  UNION ALL
  SELECT f.word, f.ahead, g.form FROM followed f JOIN formed g ON g.word = f.ahead
)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN followed r ON r.word = f.word AND r.ahead IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_index": WARC, "op3_mix_sources": MIX, "op6_decontaminate": DECONTAMINATE, "op11_spelling_variants": SPELLING,
        "op12_filter_audit": FILTER_AUDIT,
    }
