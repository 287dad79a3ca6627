"""SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOWERED = "translate(ifnull(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORD = r"'[^\x20\x09-\x0D]+'"
_LETTER_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

QUALITY_RULES = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, source, ifnull(text, '') AS text,
           regexp_extract_all(ifnull(text, ''), {_BLANK_WORD}) AS words
    FROM documents
),
line AS (
    SELECT r, line, count(*) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM doc)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line
),
gram AS (
    SELECT r, i, array_to_string(words[i:i + 4], ' ') AS gram
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM doc WHERE len(words) > 4)
),
again AS (
    SELECT r, count(DISTINCT p) AS n
    FROM (SELECT r, unnest(range(i, i + 5)) AS p
          FROM (SELECT * FROM gram QUALIFY count(*) OVER (PARTITION BY r, gram) > 1))
    GROUP BY r
),
measured AS (
    SELECT doc_id, source, len(words) AS n_words,
           CAST(ifnull(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           CAST(ifnull(l.n, 0) AS BIGINT) AS n_dup_lines, ifnull(again.n, 0) AS n_repeat_words
    FROM doc LEFT JOIN (SELECT r, sum(n - 1) AS n FROM line GROUP BY r) l USING (r)
    LEFT JOIN again USING (r)
),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
),
broken AS (
    SELECT source, unnest([1, 2, 3, 4]) AS rule,
           unnest([base_failed, 100 * n_symbols > 10 * n_words, 100 * n_dup_lines > 5 * n_words,
                   word_chars < 3 * n_words OR word_chars > 10 * n_words]) AS failed
    FROM judged
),
host AS (
    SELECT source, rule, count(*) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS k
    FROM broken GROUP BY source, rule
),
moments AS (
    SELECT rule, sum(n) AS n, sum(k) / sum(n) AS mean, count(*) AS hosts,
           sum(k * k / n) - sum(k) * sum(k) / sum(n)
               - (count(*) - 1) * (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) AS spread,
           sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS scale
    FROM host GROUP BY rule
),
prior AS (
    SELECT rule, mean, CASE WHEN hosts > 1 AND scale > 0 AND spread > 0
                            THEN greatest(mean * (1 - mean) / (spread / scale) - 1, 4.0)
                            ELSE CAST(n AS DOUBLE) END AS strength
    FROM moments
),
verdict AS (
    SELECT source, any_value(n) AS n, string_agg(CAST(k AS BIGINT), ',' ORDER BY rule) AS failed,
           bool_or(rate - 2 * sqrt(rate * (1 - rate) / (n + strength + 1)) > 0.5) AS rejected
    FROM (SELECT source, rule, n, k, strength, (k + mean * strength) / (n + strength) AS rate
          FROM host JOIN prior USING (rule))
    GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept, v.n AS host_documents,
       v.failed AS host_failed, rejected AS host_rejected
FROM judged j JOIN verdict v ON j.source IS NOT DISTINCT FROM v.source
"""

SHARDING = """
WITH checksum AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, step:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i))
),
sized AS (
    SELECT doc_id, CAST(octet_length(encode(ifnull(text, ''))) + 16 AS BIGINT) AS size,
           xor(4294967295, list_reduce(list_concat([4294967295],
               list_transform(regexp_extract_all(hex(encode(ifnull(text, ''))), '..'),
                              lambda h: CAST('0x' || h AS BIGINT))),
               lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32
    FROM documents, checksum
),
placed AS (
    SELECT *, sum(size) OVER w - size AS before, row_number() OVER w AS place, sum(size) OVER () AS total
    FROM sized
    WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
),
cut AS (
    SELECT *, CAST(least(39, (2 * before + size) * 40 // (2 * total)) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

DECONTAMINATION = f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, {_LETTER_WORD}) AS words
    FROM documents
),
item AS (
    SELECT item_id, regexp_extract_all({_LOWERED}, {_LETTER_WORD}) AS words
    FROM benchmark WHERE item_id IS NOT NULL
),
sought AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(10, len(words)) AS size,
           array_to_string(words[i:i + 9], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM item WHERE len(words) > 0)
),
place AS (
    SELECT r, size, i, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM doc, (SELECT DISTINCT size FROM sought) WHERE len(words) >= size)
),
found AS (SELECT r, i, place.size, item_id FROM place JOIN sought USING (size, phrase)),
hit AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r
),
named AS (
    SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, ifnull(hit.n, 0) AS n_hit, ifnull(named.n, 0) AS n_items,
       sha256(ifnull(items, '')) AS items_sha256, ifnull(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, {_BLANK_WORD}) AS words
    FROM documents
),
gram AS (
    SELECT DISTINCT r, array_to_string(words[i:i + 4], ' ') AS gram
    FROM (SELECT r, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM doc WHERE len(words) > 0)
),
size AS (SELECT r, count(*) AS n FROM gram GROUP BY r),
common AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n
    FROM gram a JOIN gram b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL
),
link AS (
    SELECT a, b FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b
    WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)
),
reach(a, b) AS (SELECT r, r FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_key AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN doc ON doc.r = b GROUP BY a)
SELECT doc_id, ifnull(n, 0) AS n_shingles, component_id
FROM doc LEFT JOIN size USING (r) JOIN least_key USING (r)
"""

# Block and shard sizes, rounds and seed are those of mixing.py.
MIXING = f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, source IS NULL AS last, ifnull(source, '') AS name,
           len(regexp_extract_all(ifnull(text, ''), {_BLANK_WORD})) AS size
    FROM documents
),
sized AS (
    SELECT last, name, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY last, name) - 1 AS source_no
    FROM doc GROUP BY last, name
),
weighed AS (SELECT *, [5, 2, 1][source_no % 3 + 1] AS weight, 2 * source_size AS most FROM sized),
poured AS (
    SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS weight_sum,
           sum(most) OVER w - most AS most_before, sum(weight) OVER w - weight AS weight_before
    FROM weighed WINDOW w AS (ORDER BY CAST(most AS DOUBLE) / weight, source_no ROWS UNBOUNDED PRECEDING)
),
cut AS (
    SELECT *, (words * 150 - most_before * 100) * weight >= most * 100 * (weight_sum - weight_before) AS cut_off
    FROM poured
),
rest_of AS (
    SELECT CAST(any_value(words) * 150 AS DOUBLE) / 100 - ifnull(sum(most) FILTER (cut_off), 0) AS left_over,
           CAST(sum(weight) FILTER (NOT cut_off) AS DOUBLE) AS free_weight
    FROM cut
),
aimed AS (
    SELECT last, name, source_no, source_size,
           CASE WHEN cut_off THEN CAST(most AS DOUBLE) ELSE weight * left_over / free_weight END AS target
    FROM cut, rest_of
),
quota AS (
    SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal,
           CASE WHEN source_size > 0 THEN goal % source_size ELSE 0 END AS rest,
           (source_size + 511) // 512 AS in_pass,
           CASE WHEN source_size > 0 THEN goal // source_size * in_pass + (rest + 511) // 512 ELSE 0 END AS quota
    FROM aimed
),
ranged AS (
    SELECT *, CAST(sum(quota) OVER (ORDER BY source_no) - quota AS BIGINT) AS start, sum(quota) OVER () AS slots
    FROM quota
),
drawn AS (
    SELECT slot, CAST('0x' || substr(md5('11:' || slot), 1, 15) AS BIGINT) % slots AS drawn
    FROM (SELECT any_value(CAST(slots AS BIGINT)) AS slots, unnest(range(any_value(CAST(slots AS BIGINT)))) AS slot FROM ranged)
),
numbered AS (
    SELECT slot, source_no, quota, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS k
    FROM drawn JOIN ranged ON drawn >= start AND drawn < start + quota
),
each AS (
    SELECT source_no, quota, ifnull(draws, 0) AS draws, greatest(ifnull(draws, 0) - quota, 0) AS over,
           greatest(quota - ifnull(draws, 0), 0) AS short
    FROM ranged LEFT JOIN (SELECT source_no, count(*) AS draws FROM numbered GROUP BY ALL) USING (source_no)
),
summed AS (
    SELECT *, sum(over) OVER w - over AS over_start, sum(short) OVER w - short AS short_start
    FROM each WINDOW w AS (ORDER BY source_no)
),
given AS (
    SELECT source_no, k FROM numbered WHERE k < quota
    UNION ALL
    SELECT t.source_no, t.draws + s.over_start + n.k - n.quota - t.short_start
    FROM numbered n JOIN summed s USING (source_no)
    JOIN summed t ON s.over_start + n.k - n.quota >= t.short_start
                 AND s.over_start + n.k - n.quota < t.short_start + t.short
    WHERE n.k >= n.quota
),
indexed AS (
    SELECT source_no, source_size, quota, rest, CAST(k AS BIGINT) AS k, CAST(k // in_pass AS BIGINT) AS pass,
           CAST(k % in_pass AS BIGINT) AS i, source_size // 512 AS whole
    FROM given JOIN ranged USING (source_no)
),
keyed AS (
    SELECT source_no, pass,
           list_transform(range(24), lambda r: CAST('0x' || substr(md5(
               '11:key:' || source_no || ':' || pass || ':' || r), 1, 15) AS BIGINT) % greatest(whole, 1)) AS keys
    FROM (SELECT DISTINCT source_no, pass, whole FROM indexed)
),
taken AS (
    SELECT source_no, source_size, quota, rest, k, CASE WHEN i < whole THEN list_reduce(list_concat([i], range(24)),
        lambda x, r: CASE WHEN substr(md5('11:' || source_no || ':' || pass || ':' || r || ':' ||
                greatest(x, (keys[r + 1] - x + whole) % whole)), 1, 1) >= '8'
            THEN (keys[r + 1] - x + whole) % whole ELSE x END) ELSE i END AS block
    FROM indexed JOIN keyed USING (source_no, pass)
),
piece AS (
    SELECT source_no, block * 512 AS begin, block * 512 + CASE WHEN k = quota - 1 AND rest > 0
               THEN (rest - 1) % 512 + 1 ELSE least(512, source_size - block * 512) END AS stop
    FROM taken
),
placed AS (
    SELECT r, doc_id, size, source_no, source_size, target,
           CAST(sum(size) OVER (PARTITION BY source_no ORDER BY doc_id NULLS FIRST, size, r ROWS UNBOUNDED PRECEDING)
                - size AS BIGINT) AS pos
    FROM doc JOIN aimed USING (last, name)
),
reached AS (
    SELECT *, unnest(CASE WHEN size > 0 THEN range(pos // 512, (pos + size - 1) // 512 + 1) ELSE [-1] END) AS block
    FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN stop IS NULL THEN 0 ELSE greatest(least(pos + size, stop) - greatest(pos, begin), 0) END) AS BIGINT) AS taken
FROM reached LEFT JOIN piece ON piece.source_no = reached.source_no AND begin = block * 512
GROUP BY r, doc_id, size, source_size, target
"""

COLLOCATIONS = rf"""
WITH piece AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
    FROM (SELECT ifnull(lang, 'und') AS lang,
                 unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
gram AS (
    SELECT lang, words[i:i + size - 1] AS gram, count(*) AS f
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM piece, (SELECT unnest(range(1, 5)) AS size) WHERE len(words) >= size)
    GROUP BY ALL
),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE len(gram) = 1 GROUP BY lang),
often AS (SELECT * FROM gram WHERE f >= 30),
longer AS (
    SELECT lang, gram[i:i + size - 1] AS gram, max(f) AS most
    FROM (SELECT lang, gram, f, size, unnest(range(1, len(gram) - size + 2)) AS i
          FROM often, (SELECT unnest(range(2, 4)) AS size) WHERE len(gram) > size)
    GROUP BY ALL
),
phrase AS (
    SELECT often.* FROM often LEFT JOIN longer USING (lang, gram)
    WHERE len(gram) > 1 AND (most IS NULL OR 100 * most < 80 * f)
),
cut AS (
    SELECT p.lang, p.gram, p.f AS a, k, l.f AS l, r.f AS r, CAST(2000000 * p.f AS HUGEINT) // (l.f + r.f) AS score
    FROM (SELECT *, unnest(range(1, len(gram))) AS k FROM phrase) p
    JOIN gram l ON l.lang = p.lang AND l.gram = p.gram[1:k]
    JOIN gram r ON r.lang = p.lang AND r.gram = p.gram[k + 1:]
),
least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
ranked AS (
    SELECT *, array_to_string(gram, ' ') AS phrase,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank
    FROM least
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL = {
    "op2_quality_rules": QUALITY_RULES,
    "op5_sharding": SHARDING,
    "op8_decontamination": DECONTAMINATION,
    "op10_jaccard_join": JACCARD_JOIN,
    "op11_mixing": MIXING,
    "op12_collocations": COLLOCATIONS,
}
