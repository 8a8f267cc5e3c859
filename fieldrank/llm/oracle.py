"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from fieldrank.llm.mixing import BLOCK_DOCS, BLOCKS, SHARD_BLOCKS

# The classes of characters of the contracts.
_ITEM_WORDS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents
), b AS (
  SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths)
), found AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, words)),
hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

OP4 = """
WITH p AS (
  SELECT row_number() OVER (ORDER BY page_id NULLS FIRST) AS r, page_id,
         octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, max(r) OVER (PARTITION BY payload_digest) AS first_r,
         last_value(page_id) OVER (PARTITION BY payload_digest ORDER BY r
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_page
  FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND r <> first_r THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND r <> first_r THEN first_page END AS refers_to
FROM f
"""

_SCORE = (
    "1.0 / -ln((('0x' || substr(md5('0:' || s || ':' || coalesce(doc_id::VARCHAR, '')), 1, 13))"
    "::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"
)

# CRC-32 (polynomial 0xEDB88320, reflected) of the UTF-8 bytes, by a table of 256 entries.
_CRC = """crc AS (
  SELECT list(c ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce(
      [0, 1, 2, 3, 4, 5, 6, 7],
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END,
      i::BIGINT
    ) AS c FROM range(256) t(i))
)"""

OP7 = f"""
WITH {_CRC}, d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS bytes, hex(encode(coalesce(text, ''))) AS digits
  FROM documents
), sums AS (
  SELECT r, doc_id, octet_length(bytes) + 8 AS size, xor(4294967295::BIGINT, list_reduce(
    list_transform(range(octet_length(bytes)), lambda i: ('0x' || substr(digits, (2 * i + 1)::BIGINT, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295::BIGINT
  )) AS text_crc32 FROM d, crc
), scored AS (
  SELECT r, max_by(s, (score, -s)) FILTER (s < 24) AS shard, max_by(s, (score, -s)) AS grown_shard
  FROM (SELECT r, s, {_SCORE} AS score FROM d, range(25) t(s)) GROUP BY r
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard
         ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, text_crc32) - 1 AS slot,
       grown_shard::INTEGER AS grown_shard
FROM sums JOIN scored USING (r)
"""

# The splitting tree over eight output shards has three levels.
def _walk(up: bool, limit: str) -> str:
    """Weights on a side of the mode, each from its neighbour's: their sum, and how many
    sums are within a limit."""
    if up:
        steps = "range(m, high_k)"
        ratio = "(n::DOUBLE - k) * (take::DOUBLE - k) / ((k + 1) * (others + k + 1))"
    else:
        steps = "range(m, low_k, -1)"
        ratio = "k * (others + k) / ((n::DOUBLE - k + 1) * (take::DOUBLE - k + 1))"
    return f"""list_reduce(
      list_transform(list_transform({steps}, lambda j: j::DOUBLE), lambda k: {{'w': {ratio}, 's': 0.0::DOUBLE, 'p': 0::BIGINT}}),
      lambda a, e: {{'w': a.w * e.w, 's': a.s + a.w * e.w, 'p': a.p + (a.s + a.w * e.w <= {limit})::BIGINT}},
      {{'w': 1.0::DOUBLE, 's': 0.0::DOUBLE, 'p': 0::BIGINT}})"""


# One level of the splitting tree: draws source by source, then the two halves.
_MIX_LEVELS = "".join(f"""
, listed{i} AS (
  SELECT *, (low + high) // 2 AS middle, sum(n) OVER (PARTITION BY low, high)::BIGINT AS size,
         row_number() OVER (PARTITION BY low, high ORDER BY key) AS i
  FROM node{i}
), drawn{i} AS (
  SELECT DISTINCT low, high, 0::BIGINT AS i, size AS total, (size * (middle - low) // (high - low))::BIGINT AS take,
         0::BIGINT AS x FROM listed{i}
  UNION ALL
  SELECT low, high, i, total - n, take - x, x FROM (
    SELECT *, CASE WHEN rest < 0 THEN m WHEN rest < up THEN m + 1 + {_walk(True, "rest")}.p
                   ELSE greatest(low_k, m - 1 - {_walk(False, "(rest - up)")}.p) END AS x
    FROM (
      SELECT *, chance * (1 + up + down) - 1 AS rest FROM (
        SELECT *, {_walk(True, "0.0")}.s AS up, {_walk(False, "0.0")}.s AS down FROM (
          SELECT *, greatest(low_k, least(high_k, (take + 1) * (n + 1) // (total + 2)))::BIGINT AS m FROM (
            SELECT d.low, d.high, l.i, d.total, d.take, l.n, (d.total - l.n - d.take)::DOUBLE AS others,
                   greatest(0, d.take - (d.total - l.n))::BIGINT AS low_k, least(l.n, d.take)::BIGINT AS high_k,
                   ('0x' || substr(md5('0:draw:' || d.low || ':' || d.high || ':' || l.key), 1, 13))::BIGINT
                   / 4503599627370496.0::DOUBLE AS chance
            FROM drawn{i} d JOIN listed{i} l ON l.low = d.low AND l.high = d.high AND l.i = d.i + 1
  )))))
), node{i + 1} AS (
  SELECT key, low, middle AS high, x AS n FROM listed{i} JOIN drawn{i} USING (low, high, i) WHERE x > 0
  UNION ALL
  SELECT key, middle, high, n - x FROM listed{i} JOIN drawn{i} USING (low, high, i) WHERE n > x
)""" for i in range(3))

OP9 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents
), s AS (
  SELECT key, source, sum(size)::BIGINT AS source_size,
         ceil(count(*) / least(
           greatest({BLOCK_DOCS}, ceil((SELECT count(*) FROM d) / {BLOCKS}.0)),
           greatest(1, ceil((SELECT count(*) FROM d) / {SHARD_BLOCKS * 8}.0))))::BIGINT AS n_blocks,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
  FROM d GROUP BY key, source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS level FROM s
), fills AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER below, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS fill
  FROM levels WINDOW below AS (ORDER BY level, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (
  SELECT min(level) AS level, arg_min(fill, level) AS fill FROM fills WHERE fill < level
), targets AS (
  SELECT key, source_size, n_blocks,
         CASE WHEN o.level IS NULL OR f.level < o.level THEN f.cap ELSE o.fill * weight END AS target
  FROM fills f, opened o
), quotas AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest
  FROM targets
), cut AS (
  SELECT d.*, source_size, target, passes, rest,
         floor(('0x' || substr(place, 1, 8))::BIGINT * n_blocks / 4294967296.0)::BIGINT AS block,
         sum(size) OVER (PARTITION BY key ORDER BY place, doc_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM d JOIN quotas USING (key)
), chosen AS (
  SELECT *, (rest > 0 AND coalesce(before, 0) + size / 2.0 <= rest)::INTEGER AS more FROM cut
), block_sums AS (
  SELECT key, block, passes, rest, sum(size) AS size FROM cut GROUP BY ALL
), blocks AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY key ORDER BY block
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM block_sums
), units AS (
  SELECT key, block, unnest(range(1, (passes + (rest > 0 AND before <= rest)::INTEGER)::BIGINT + 1)) AS pass
  FROM blocks
), tickets AS (
  SELECT *, row_number() OVER (PARTITION BY key
              ORDER BY md5('0:block:' || key || ':' || block || ':' || pass), block, pass) AS ticket
  FROM units
), node0 AS (SELECT key, 0 AS low, 8 AS high, count(*) AS n FROM tickets GROUP BY key)
{_MIX_LEVELS}
, leaves AS (
  SELECT key, shard, row_number() OVER (PARTITION BY key ORDER BY shard) AS ticket
  FROM (SELECT key, low AS shard, unnest(range(n)) FROM node3)
), dealt AS (
  SELECT key, block, list(shard ORDER BY pass) AS shards
  FROM tickets JOIN leaves USING (key, ticket) GROUP BY key, block
)
SELECT doc_id, size, source_size, target, ((passes + more) * size)::BIGINT AS taken,
       array_to_string(list_slice(coalesce(shards, []), 1, (passes + more)::BIGINT), ',') AS shards
FROM chosen LEFT JOIN dealt USING (key, block)
"""

ORACLE = {"op1_decontaminate": OP1, "op4_warc": OP4, "op7_shard": OP7, "op9_mix": OP9}

# The splits and words of the contract, and a phrase per start and length.
OP11 = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS r, lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g, k
  FROM starts, range(1, 5) t(k) WHERE i + k - 1 <= len(w)
), f AS (
  SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), n AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
cuts AS (
  SELECT c.lang, c.k, c.g, c.a, l.k AS cut, l.a AS l, r.a AS r,
         ((2000000::HUGEINT * c.a) // (l.a + r.a))::BIGINT AS score
  FROM f c JOIN f l ON l.lang = c.lang AND l.k < c.k AND l.g = list_slice(c.g, 1, l.k)
           JOIN f r ON r.lang = c.lang AND r.k = c.k - l.k AND r.g = list_slice(c.g, l.k + 1, c.k)
  WHERE c.k > 1
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, part, max(a) AS longest
  FROM (SELECT lang, a, list_slice(g, s, s + p - 1) AS part
        FROM f, range(2, 4) x(p), range(1, 4) y(s) WHERE p < k AND s + p - 1 <= k)
  GROUP BY ALL
), left_over AS (
  SELECT best.*, array_to_string(g, ' ') AS phrase
  FROM best LEFT JOIN inside ON inside.lang = best.lang AND part = g
  WHERE longest IS NULL OR 100 * longest < 80 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM left_over JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLE["op11_collocations"] = OP11

# Nodes are the hashed lists of the turns that lead to them.
OP13 = f"""
WITH {_CRC}, t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) - 1 AS place FROM t
), sizes AS (
  SELECT conv_id, count(*) AS n_own, conv_id - conv_id % 100 AS base, hex(encode(conv_id::VARCHAR)) AS digits
  FROM t GROUP BY conv_id
), asked AS (
  SELECT conv_id, n_own, base, xor(4294967295::BIGINT, list_reduce(
    list_transform(range(len(digits) // 2), lambda i: ('0x' || substr(digits, (2 * i + 1)::BIGINT, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295::BIGINT
  )) % 6 AS h FROM sizes, crc
), turns AS (
  SELECT a.conv_id, place + 1 AS depth, said, chars
  FROM asked a JOIN placed p ON p.conv_id = a.base AND place < h
  UNION ALL
  SELECT a.conv_id, place - h + 1 + least(h, coalesce(b.n_own, 0)), said, chars
  FROM asked a JOIN placed p ON p.conv_id = a.conv_id AND place >= h LEFT JOIN sizes b ON b.conv_id = a.base
), begun AS (
  SELECT conv_id, depth, chars, md5(array_to_string(list(said) OVER w, ',')) AS node,
         coalesce(md5(array_to_string(list(said) OVER p, ',')), 'root') AS parent
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY depth),
    p AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), members AS (
  SELECT conv_id, 0 AS depth, 0 AS chars, 'root' AS node, NULL AS parent FROM sizes
  UNION ALL SELECT conv_id, depth, chars, node, CASE WHEN depth = 1 THEN 'root' ELSE parent END FROM begun
), nodes AS (
  SELECT node, any_value(parent) AS parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars
  FROM members GROUP BY node, depth
), children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
  SELECT m.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n.chars) AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.node = n.node
    JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth
  GROUP BY m.node
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT * FROM members QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN nodes p ON p.node = n.parent
  LEFT JOIN children c ON c.node = n.node LEFT JOIN ends e ON e.node = n.node
"""

ORACLE["op13_prefix_trie"] = OP13
