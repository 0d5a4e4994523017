"""The corpus queries that SQL can say, for the engine that checks the results.

The others are fingerprints of words, learned scores, edit distances, token ids and approximate searches, which are
tested against brute force in ``tests/llm``. The SQL takes what time it takes: that of repeated passages cuts every
window out of every text.
"""

from __future__ import annotations

from .sharding import LAW
from .tool_calls import LONG_REQUEST

SHARDS = 24
OVERHEAD = 8
REPEAT_BYTES = 400

# the reflected polynomial of CRC-32; its table of 256 steps is built here, and a text's bytes are folded over it
_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
           [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                        lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM documents),
placed AS (
  SELECT doc_id, CAST(n + {overhead} AS BIGINT) AS size,
         xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
                                     lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]))) AS text_crc32
  FROM sized, crc_table)"""

SHARDING = f"""
WITH {_CRC.format(overhead=OVERHEAD)},
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total
  FROM placed),
cut AS (
  SELECT *, CAST(least({SHARDS - 1}, ((start * 2 + size) * {SHARDS}) // (total * 2)) AS INTEGER) AS shard FROM summed)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, '{LAW}' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""

# base32 takes the digest's 160 bits by fives
WARC = """
WITH sums AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
  FROM pages),
held AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS holder FROM sums)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(list_sum(list_transform(range(5), lambda k:
           CAST(substr(bits, CAST(i * 5 + k + 1 AS BIGINT), 1) AS INTEGER) << CAST(4 - k AS INTEGER))) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM held"""

# a call follows the one of two turns before, so its level is its place in a run of calls two turns apart
TOOL_CALLS = f"""
WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations WHERE turn IS NOT NULL),
calls AS (
  SELECT *, CASE WHEN length(text) < {LONG_REQUEST} THEN 'lookup' ELSE 'report' END AS name,
         turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
  FROM turns WHERE role = 'user'),
levelled AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level,
         CASE WHEN name = 'lookup' AND text = '' THEN '$.query: length 0'
              WHEN name = 'report' AND length(text) > 1000 THEN '$.query: length ' || length(text) END AS error
  FROM calls),
answers AS (SELECT conv_id, turn, text AS content FROM turns WHERE role = 'assistant')
SELECT c.conv_id, 'call_' || c.turn AS call_id, level, c.turn, name, CAST(1 AS BIGINT) AS copies,
       CASE WHEN content IS NULL THEN 'unanswered' ELSE 'linked' END AS status, error IS NULL AS valid, error,
       '{{"call":{{"arguments":{{"query":' || to_json(c.text) || ',"turn":' || c.turn || '}},"id":"call_' || c.turn
       || '","name":"' || name || '"}},"level":' || level || ',"result":'
       || CASE WHEN content IS NULL THEN 'null'
               ELSE '{{"content":' || to_json(content) || ',"turn":' || a.turn || '}}' END || '}}' AS json
FROM levelled c LEFT JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.turn + 1"""

# every window by its digest; windows that start at most a window apart make one removed run
REPEATS = f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS nth, encode(coalesce(text, '')) AS data, strlen(coalesce(text, '')) AS n
  FROM documents),
windows AS (
  SELECT nth, place, md5(data[place + 1 : place + {REPEAT_BYTES}]) AS key
  FROM (SELECT nth, data, unnest(range(n - {REPEAT_BYTES} + 1)) AS place FROM texts WHERE n >= {REPEAT_BYTES})),
twice AS (SELECT key FROM windows GROUP BY key HAVING count(*) > 1),
starts AS (
  SELECT nth, place,
         coalesce(place > lag(place) OVER (PARTITION BY nth ORDER BY place) + {REPEAT_BYTES}, TRUE) AS opens
  FROM windows JOIN twice USING (key)),
runs AS (
  SELECT nth, min(place) AS lo, max(place) + {REPEAT_BYTES} AS hi
  FROM (SELECT nth, place, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY nth ORDER BY place) AS run FROM starts)
  GROUP BY nth, run),
gaps AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY nth ORDER BY lo), 0) AS after FROM runs),
cut AS (
  SELECT nth, sum(hi - lo) AS removed, count(*) AS spans, max(hi) AS last,
         string_agg(hex(data[after + 1 : lo]), '' ORDER BY lo) AS kept
  FROM gaps JOIN texts USING (nth) GROUP BY nth)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans,
       sha256(CASE WHEN spans IS NULL THEN data ELSE unhex(kept || hex(data[last + 1 : n])) END) AS kept_sha256,
       CASE WHEN removed > 0 THEN 1 ELSE 0 END AS loses_bytes
FROM texts LEFT JOIN cut USING (nth)"""

PHRASES = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM places, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM candidates),
scored AS (
    SELECT x.lang, x.phrase, x.a, x.c, l.f AS l, r.f AS r, ((2000000::HUGEINT * x.a) // (l.f + r.f))::BIGINT AS score
    FROM cuts x
    JOIN grams l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.c], ' ')
    JOIN grams r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.c + 1:], ' ')
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
starts AS (SELECT lang, k, a, w, unnest(range(1, k + 1)) AS i FROM candidates WHERE k >= 3),
inner_ones AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS above
    FROM starts, (VALUES (2), (3)) AS lengths(m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inner_ones o ON o.lang = b.lang AND o.phrase = b.phrase
    WHERE o.above IS NULL OR 100::HUGEINT * o.above < 80::HUGEINT * b.a
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT x.lang, x.rank, x.phrase, x.a, x.l, x.r, t.n, x.score FROM ranked x JOIN totals t ON t.lang = x.lang WHERE x.rank <= 2000
"""

ORACLES = {
    "op4_suffix_array_dedup": REPEATS,
    "op5_chat_formatting": TOOL_CALLS,
    "op6_warc": WARC,
    "op10_sharding": SHARDING,
    "op11_phrase_collocations": PHRASES,
}
