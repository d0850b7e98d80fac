"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tallyhouse.llm.queries import CAPTURES, CRAWLED

ORACLES: dict[str, str] = {}

ORACLES["op1_rule_ledger"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         [line FOR line IN string_split(coalesce(text, ''), chr(10))
          IF regexp_matches(line, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), flat AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS pos, words FROM cut WHERE len(words) >= 5
), grams AS (
  SELECT doc_id, pos, list_slice(words, pos, pos + 4) AS gram FROM flat
), times AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(pos, pos + 5)) AS place FROM times WHERE n > 1)
  GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) AS n_stutters,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM cut LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *,
         (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
          + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
          + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
          + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
          + CASE WHEN word_chars < 3 * n_words OR word_chars > 10 * n_words THEN 16 ELSE 0 END
          + CASE WHEN 3 * n_stutters > n_words THEN 32 ELSE 0 END
          + CASE WHEN 10 * n_capitals > 8 * n_letters THEN 64 ELSE 0 END) AS fail_bits
  FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       (fail_bits & 63) = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM judged
"""

ORACLES["op4_sampled_splitters"] = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i::BIGINT AS value, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1
  FROM steps WHERE step < 8
), crc AS (
  SELECT list(value ORDER BY byte) AS entries FROM steps WHERE step = 8
), sized AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS key,
         hex(encode(coalesce(text, ''))) AS digits
  FROM documents
), places AS (
  SELECT *, sum(size) OVER (ORDER BY key, doc_id) - size AS own,
         row_number() OVER (ORDER BY key, doc_id) - 1 AS nth, sum(size) OVER () AS total,
         sum(size) OVER (PARTITION BY key) AS weight
  FROM sized
), starts AS (
  SELECT *, CASE WHEN weight <= 0.01 * total / 8 THEN min(own) OVER (PARTITION BY key) ELSE own END AS start
  FROM places
), shards AS (
  SELECT *, (start * 8 // total)::INTEGER AS shard FROM starts
), sums AS (
  SELECT doc_id, list_reduce(
           list_prepend(4294967295::BIGINT,
             [CAST('0x' || digits[2 * i - 1:2 * i] AS BIGINT) FOR i IN range(1, size)]),
           lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1])) AS state
  FROM sized, crc
)
SELECT doc_id, size::BIGINT AS size, xor(state, 4294967295)::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM shards JOIN sums USING (doc_id)
"""

ORACLES["op7_revisits"] = (
    f"WITH crawled AS ({CRAWLED}), captures AS ({CAPTURES}),"
    + r"""
plain AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '') AS address,
         '^[A-Za-z][A-Za-z0-9+.-]*://' AS begin FROM captures
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(address, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)),
                                          ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(address, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort([p FOR p IN string_split(regexp_extract(address, '\?(.*)$', 1), '&')
                                    IF p <> '' AND NOT starts_with(p, 'utm_')]), '&') AS query
  FROM plain
), keyed AS (
  SELECT *, CASE WHEN regexp_matches(address, begin)
                 THEN host || CASE WHEN path = '' THEN '/' ELSE path END
                      || CASE WHEN query <> '' THEN '?' || query ELSE '' END
                 ELSE address END AS url_key FROM parts
), joined AS (
  SELECT v.*, r.record_id AS found_id, r.etag AS found_tag, r.last_modified AS found_day,
         r.payload AS body, r.cache_control AS found_cache, r.content_type AS found_type
  FROM keyed v LEFT JOIN keyed r
    ON r.type = 'response' AND r.url_key = v.url_key AND r.ts < v.ts
  WHERE v.type = 'revisit'
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) = 1
), judged AS (
  SELECT *, CASE WHEN found_id IS NULL THEN 'no_response'
                 WHEN etag IS NULL AND last_modified IS NULL THEN 'no_validator'
                 WHEN etag IS NOT NULL AND regexp_replace(etag, '^W/', '') = regexp_replace(found_tag, '^W/', '') THEN 'resolved'
                 WHEN etag IS NULL AND last_modified = found_day THEN 'resolved'
                 ELSE 'mismatch' END AS outcome FROM joined
)
SELECT record_id::BIGINT AS record_id, url_key, ts::BIGINT AS ts, outcome,
       CASE WHEN outcome = 'resolved' THEN found_id::BIGINT END AS response_id,
       CASE WHEN outcome = 'resolved' THEN md5(body) END AS payload_md5,
       CASE WHEN outcome = 'resolved' THEN concat_ws('; ',
         'cache-control: ' || coalesce(cache_control, found_cache), 'content-type: ' || found_type,
         'etag: ' || coalesce(etag, found_tag), 'last-modified: ' || coalesce(last_modified, found_day)) END AS headers
FROM judged
"""
)

ORACLES["op13_line_runs"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), flat AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM flat
), frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT keyed.*, coalesce(doc_id < last, false) AS gone FROM keyed LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
