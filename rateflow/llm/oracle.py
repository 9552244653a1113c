"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id))::INTEGER AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

_SUFFIX_DEDUP = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS rid, doc_id, encode(coalesce(text, '')) AS t FROM documents
),
bytes AS (
  SELECT rid, unnest(b) AS byte, unnest(range(len(b))) AS pos
  FROM (SELECT rid, regexp_extract_all(hex(t), '..') AS b FROM docs)
),
-- strings of 4, 32, 64 and then 100 bytes, by doubling
w2 AS (SELECT rid, pos, byte, byte || lead(byte) OVER d AS s FROM bytes WINDOW d AS (PARTITION BY rid ORDER BY pos)),
w4 AS (SELECT rid, pos, byte, s || lead(s, 2) OVER d AS s4 FROM w2 WINDOW d AS (PARTITION BY rid ORDER BY pos)),
w8 AS (SELECT rid, pos, byte, s4, s4 || lead(s4, 4) OVER d AS s FROM w4 WINDOW d AS (PARTITION BY rid ORDER BY pos)),
w16 AS (SELECT rid, pos, byte, s4, s || lead(s, 8) OVER d AS s FROM w8 WINDOW d AS (PARTITION BY rid ORDER BY pos)),
w32 AS (SELECT rid, pos, byte, s4, s || lead(s, 16) OVER d AS s FROM w16 WINDOW d AS (PARTITION BY rid ORDER BY pos)),
w100 AS (
  SELECT rid, pos, byte, s || lead(s, 32) OVER d || lead(s, 64) OVER d || lead(s4, 96) OVER d AS s
  FROM w32 WINDOW d AS (PARTITION BY rid ORDER BY pos)
),
starts AS (
  SELECT rid, pos, byte, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY rid, pos) > 1 AS again FROM w100
),
cut AS (
  SELECT rid, pos, byte, max(CASE WHEN again THEN pos END) OVER (PARTITION BY rid ORDER BY pos) >= pos - 99 IS TRUE AS gone FROM starts
),
runs AS (
  SELECT rid, pos, byte, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY pos), false) AS opens FROM cut
),
kept AS (
  SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS rest
  FROM runs GROUP BY rid
)
SELECT d.doc_id, octet_length(d.t) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.rest, ''))) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (rid)
"""

# Slots of a table of up to 4 million rows: one block a shard, in the order of the ids.
_JUMP_SHARDING = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
),
-- the checksum's table: eight shifts of each byte, by the reversed polynomial
shifted AS (
  SELECT b, 0 AS bit, b::BIGINT AS v FROM range(256) t(b)
  UNION ALL
  SELECT b, bit + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM shifted WHERE bit < 8
),
bytes AS (SELECT list(v ORDER BY b) AS of FROM shifted WHERE bit = 8),
sums AS (
  SELECT t, xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda crc, x: xor(crc >> 8, of[(xor(crc, x) & 255) + 1]), 4294967295), 4294967295) AS crc
  FROM (SELECT DISTINCT t FROM docs) CROSS JOIN bytes
),
-- every shard that a key jumps to while there are 41; the last one below 40 is its shard of 40
jumps AS (
  SELECT rid, 0::BIGINT AS shard, (((doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616)
                                   * 2862933555777941757 + 1) % 18446744073709551616 AS key
  FROM (SELECT rid, coalesce(doc_id, 0) AS doc_id FROM docs)
  UNION ALL
  SELECT rid, next, (key * 2862933555777941757 + 1) % 18446744073709551616
  FROM (SELECT rid, key, floor((shard + 1) * (2147483648::DOUBLE / (key // 8589934592 + 1)::DOUBLE))::BIGINT AS next FROM jumps)
  WHERE next < 41
),
placed AS (
  SELECT rid, max(shard) FILTER (shard < 40) AS shard, max(shard) AS grown_shard FROM jumps GROUP BY rid
)
SELECT d.doc_id, strlen(d.t) + 16 AS size, s.crc AS text_crc32, 'key' AS law, p.shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY p.shard ORDER BY d.doc_id NULLS FIRST, d.rid) - 1 AS slot,
       p.grown_shard::INTEGER AS grown_shard
FROM docs d JOIN placed p USING (rid) JOIN sums s ON s.t = d.t
"""

# The order of the rules is worked out on all rows, as the operator does up to 4,000 rows; beyond, it takes a sample by a
# hash that DuckDB lacks, and ``rejected_by`` (never ``kept``) may differ.
_QUALITY_CASCADE = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
),
parts AS MATERIALIZED (
  SELECT rid, doc_id, t,
         list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
),
windows AS (
  SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM parts)
),
again AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1
),
covered AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM again) GROUP BY rid
),
counted AS (
  SELECT p.rid, p.doc_id, p.t, p.words, p.lines, len(p.words) AS n_words,
         length(regexp_replace(p.t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(p.t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(p.lines) - len(list_distinct(p.lines)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM parts p LEFT JOIN covered c USING (rid)
),
judged AS MATERIALIZED (
  SELECT rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
         len(lines) AS n_lines, length(t) AS n_chars,
         [n_symbols * 100 > n_words * 10,
          word_chars < n_words * 2 OR word_chars > n_words * 15,
          n_dup_lines * 100 > len(lines) * 60,
          NOT len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) * 100 > n_words * 70,
          len(list_filter(words, lambda w: regexp_matches(w, '^\P{L}*\p{Lu}[\p{Lu}\P{L}]+$'))) * 100 > n_words * 60,
          len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•][\x20\x09-\x0D]'))) * 100 > len(lines) * 90,
          regexp_matches(t, '(?i)lorem ipsum')] AS rejects
  FROM counted
),
rules AS (
  SELECT unnest(range(1, 8)) AS i,
         unnest(['symbols', 'word_length', 'duplicate_lines', 'few_letters', 'loud', 'bullets', 'filler']) AS name
),
worth AS (
  SELECT i, name, avg(rejects[i]::INTEGER) / greatest(avg(CASE
    WHEN i <= 3 THEN 1 WHEN i <= 5 THEN n_words WHEN i = 6 THEN n_lines ELSE n_chars END), 1e-9) AS gain
  FROM judged CROSS JOIN rules GROUP BY i, name
),
ordered AS (SELECT i, name, row_number() OVER (ORDER BY gain DESC, i) AS place FROM worth),
first AS (
  SELECT j.rid, arg_min(o.name, o.place) AS rejected_by
  FROM judged j JOIN ordered o ON j.rejects[o.i] WHERE NOT j.base_failed GROUP BY j.rid
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, f.rejected_by,
       NOT base_failed AND f.rejected_by IS NULL AS kept
FROM judged LEFT JOIN first f USING (rid)
"""

ORACLE: dict[str, str] = {
    "op5_suffix_dedup": _SUFFIX_DEDUP,
    "op6_jump_sharding": _JUMP_SHARDING,
    "op7_quality_cascade": _QUALITY_CASCADE,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
