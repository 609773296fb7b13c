"""DuckDB SQL for the queries of this folder, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = r"""
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
"""

ORACLES["op8_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
  SELECT row, doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
),
shared AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT any_value(k.doc_id) AS doc_id,
       count(*) AS n_lines,
       count(*) FILTER (WHERE k.doc_id <> s.last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.last IS NULL OR k.doc_id = s.last), '')) AS kept_sha256
FROM k LEFT JOIN shared s USING (key) GROUP BY row
"""

ORACLES["op10_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
w AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i : i + k - 1], ' ') AS win
  FROM (SELECT item_id, words, least(10, len(words)) AS k, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM b WHERE len(words) > 0)
),
dw AS (
  SELECT row, k, i, array_to_string(words[i : i + k - 1], ' ') AS win
  FROM (SELECT row, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM w) WHERE len(words) >= k)
),
m AS (SELECT dw.row, dw.i, dw.k, w.item_id FROM dw JOIN w USING (k, win)),
h AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + k)) AS p FROM m) GROUP BY row),
n AS (
  SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM m GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN n USING (row)
"""

ORACLES["op12_resampling"] = r"""
WITH steps AS MATERIALIZED (
  SELECT list_transform(range(256), lambda c: list_reduce(list_concat([c], range(8)),
         lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS step
),
d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
dw AS (SELECT row, word, count(*) AS n FROM (SELECT row, unnest(words) AS word FROM d) GROUP BY ALL),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY ALL),
v AS (SELECT word, encode(word) AS bytes FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
h AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(bytes)),
                               lambda i: ('0x' || substr(hex(bytes), 2 * i + 1, 2))::BIGINT)),
                               lambda a, x: xor(step[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket
  FROM v, steps
),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN h USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN h USING (word) GROUP BY bucket),
g AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (total_s + 10000)::DOUBLE
                                   / ((s.n + 1)::DOUBLE * (total_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket),
       (SELECT sum(n) AS total_s FROM s), (SELECT coalesce(sum(n), 0) AS total_t FROM t)
),
w AS (SELECT row, sum(n * gain)::BIGINT AS weight FROM dw JOIN h USING (word) JOIN g USING (bucket) GROUP BY row),
x AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5)::DOUBLE
                                                   / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (row)
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN place END AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (WHERE n_features >= 20) OVER () AS able
  FROM x
)
"""

ORACLES["op13_hard_negatives"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, v.row, v.vec_id, a.label = v.label AS same,
         list_sum(list_transform(list_zip(a.vec, v.vec), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a JOIN v ON a.row <> v.row AND len(a.vec) = len(v.vec)
),
p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, row AS positive, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, row)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, row) <= 5
"""

ORACLES["op11_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT row, hash(array_to_string(words[i : i + 3], ' ')) AS shingle
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM d WHERE len(words) > 0)
),
n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
shared AS (
  SELECT a.row AS a, b.row AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.row <> b.row GROUP BY ALL
),
link AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n x ON x.row = a JOIN n y ON y.row = b WHERE 100 * common >= 85 * (x.n + y.n - common)
),
reach AS (SELECT row AS a, row AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a AS row, min(doc_id) AS component_id FROM reach JOIN d ON d.row = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (row) JOIN c USING (row)
"""
