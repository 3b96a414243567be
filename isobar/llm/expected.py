"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_INK = r"'[^\x20\x09-\x0D]+'"

EXACT = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

LINES = f"""
WITH l AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM l),
k AS (
  SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM p),
held AS (
  SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT r) >= 3),
kept AS (
  SELECT k.*, held.key IS NOT NULL AND doc_id IS DISTINCT FROM owner AS dropped FROM k LEFT JOIN held USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM kept GROUP BY r
"""

PHRASES = f"""
WITH i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM benchmark),
f AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
n AS (
  SELECT DISTINCT len(phrase) AS n FROM f),
o AS (
  SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, n WHERE len(w) >= n)),
h AS (
  SELECT doc_id, s, n, item_id FROM o JOIN f USING (phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_INK}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, p, p + 2) AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach (doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
c AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

# CRC-32 of the bytes of ``{0}`` as an expression over a row that has ``crc_table``, the 256 steps.
_CRC_TABLE = """
crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) ORDER BY v) AS crc_table
  FROM range(256) AS r (v))"""


def _crc(text: str) -> str:
    hexed = f"hex(encode({text}))"
    digits = f"list_transform(range(1, length({hexed}), 2), lambda i: CAST('0x' || substr({hexed}, i, 2) AS BIGINT))"
    return f"xor(list_reduce({digits}, lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


RULES = f"""
WITH {_CRC_TABLE},
d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_INK}) AS w FROM documents),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, list_slice(w, p, p + 4)) AS times
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) > 5)),
repeats AS (
  SELECT r, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT r, unnest(range(p, p + 5)) AS q FROM windows WHERE times > 1) GROUP BY r),
spelled AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS place
  FROM (SELECT r, regexp_extract_all({_LOWER}, {_INK}) AS w FROM d)),
hashed AS (
  SELECT word, {_crc('word')} AS c FROM (SELECT DISTINCT word FROM spelled), crc),
coded AS (
  SELECT r, c, lead(c) OVER (PARTITION BY r ORDER BY place) AS following FROM spelled JOIN hashed USING (word)),
runs AS (
  SELECT r, c % 65536 AS bucket FROM coded UNION ALL
  SELECT r, (c * 1000003 + following) % 65536 FROM coded WHERE following IS NOT NULL),
good AS (
  SELECT doc_id FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = 1),
trusted AS (
  SELECT r FROM d JOIN good USING (doc_id)),
counted AS (
  SELECT bucket, count(*) AS s, count(*) FILTER (r IN (SELECT r FROM trusted)) AS t FROM runs GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 10::DOUBLE) / (s::DOUBLE * (sum(t) OVER ())::DOUBLE / (sum(s) OVER ())::DOUBLE + 10))) AS BIGINT) AS g
  FROM counted),
ratios AS (
  SELECT r, sum(g) AS total, count(*) AS n FROM runs JOIN gain USING (bucket) GROUP BY r),
judged AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(floor(coalesce(total, 0) / CAST(coalesce(n, 0) + 20 AS DOUBLE)) AS BIGINT) AS ratio
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r) LEFT JOIN ratios USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND ratio >= -125 AS kept
FROM judged
"""

_NOISE = "CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT)"

RESAMPLING = f"""
WITH {_CRC_TABLE},
words AS (
  SELECT 0 AS part, doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents UNION ALL
  SELECT 1, item_id, row_number() OVER (), regexp_extract_all({_LOWER}, {_WORD}) FROM benchmark),
runs AS (
  SELECT part, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS run FROM words),
hashed AS (
  SELECT run, {_crc('run')} % 10000 AS bucket FROM (SELECT DISTINCT run FROM runs), crc),
coded AS (
  SELECT part, r, bucket FROM runs JOIN hashed USING (run)),
counted AS (
  SELECT bucket, count(*) FILTER (part = 0) AS s, count(*) FILTER (part = 1) AS t FROM coded GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS g
  FROM counted),
weighed AS (
  SELECT r, CAST(floor(sum(g) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight, count(*) AS n_features
  FROM coded JOIN gain USING (bucket) WHERE part = 0 GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + {_NOISE} AS score
  FROM words LEFT JOIN weighed USING (r) WHERE part = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (n_words >= 20) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""


def _leaf(text: str) -> str:
    values = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return f"sha256({' || '.join(values)})"


# The trees of all sources and the one above them are climbed alike; ``folded`` follows the path of each leaf.
MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
l AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS claimed
  FROM documents, crc),
p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS rank
  FROM l),
t AS (
  SELECT rank, 0 AS level, place, n, leaf AS digest FROM p UNION ALL
  SELECT rank, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM t WHERE n > 1 GROUP BY rank, level, place // 3, n),
s AS (
  SELECT rank, digest, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, rank AS place, n, digest FROM s UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM u WHERE n > 1 GROUP BY level, place // 3, n),
run AS (
  SELECT rank, level, place // 3 AS parent, list(digest ORDER BY place) AS digests FROM t WHERE n > 1 GROUP BY ALL UNION ALL
  SELECT -1, level, place // 3, list(digest ORDER BY place) FROM u WHERE n > 1 GROUP BY ALL),
folded AS (
  SELECT p.rank AS source_rank, place AS leaf_place, p.rank AS tree, 0 AS level, place, n, claimed AS digest, '' AS siblings FROM p UNION ALL
  SELECT source_rank, leaf_place,
         CASE WHEN f.n = 1 THEN -1 ELSE tree END, CASE WHEN f.n = 1 THEN 0 ELSE f.level + 1 END,
         CASE WHEN f.n = 1 THEN source_rank ELSE place // 3 END, CASE WHEN f.n = 1 THEN (SELECT count(*) FROM s) ELSE (f.n + 2) // 3 END,
         CASE WHEN f.n = 1 THEN digest
              ELSE sha256(array_to_string(digests[:place % 3], '') || digest || array_to_string(digests[place % 3 + 2:], '')) END,
         CASE WHEN f.n = 1 THEN siblings
              ELSE siblings || array_to_string(digests[:place % 3], '') || array_to_string(digests[place % 3 + 2:], '') END
  FROM folded f LEFT JOIN run ON run.rank = tree AND run.level = f.level AND parent = place // 3 AND f.n > 1
  WHERE f.n > 1 OR tree >= 0)
SELECT doc_id, leaf, s.digest AS subroot, u.digest AS root, sha256(siblings) AS proof_sha256, f.digest AS folded_root, f.digest = u.digest AS verified
FROM p JOIN s USING (rank) JOIN u ON u.n = 1
JOIN folded f ON f.source_rank = p.rank AND f.leaf_place = p.place AND f.tree = -1 AND f.n = 1
"""
