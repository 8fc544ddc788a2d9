"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from strata.llm.queries import SHARDS
from strata.llm.sharding import ROWS_PER_BUCKET

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

# shingle sets; pairs that share a shingle, linked when 100 * common >= 80 * union; smallest id reachable
_NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
size AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
edge AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM edge UNION ALL SELECT b, a FROM edge),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN size USING (doc_id) JOIN component USING (doc_id)"""

_UNIT = "(CAST('0x' || substr(md5(k || '/{salt}'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0"


def _score(shard: int) -> str:
    return f"1.0 / -ln({_UNIT.format(salt=shard)})"


_best = ", ".join(f"{_score(s)}" for s in range(SHARDS))
_CRC_TABLE = """
crc_step(i, bit, v) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, bit + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM crc_step WHERE bit < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_step WHERE bit = 8)"""

# the text's bytes are folded through the CRC table
_SHARDS_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 8 AS BIGINT) AS size, coalesce(text, '') AS x,
    coalesce(CAST(doc_id AS VARCHAR), 'null') AS k FROM documents),
summed AS (
  SELECT doc_id, size, k, CASE WHEN len(h) = 0 THEN 0 ELSE xor(list_reduce(list_prepend(4294967295, list_transform(
      range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) END AS text_crc32
  FROM (SELECT doc_id, size, k, hex(encode(x)) AS h FROM keyed), crc_table),
scored AS (SELECT *, [{_best}] AS s, {_score(SHARDS)} AS extra, {_UNIT.format(salt='bucket')} AS place FROM summed),
placed AS (
  SELECT *, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS shard,
    (SELECT greatest(1, ceil(count(*) / {ROWS_PER_BUCKET * SHARDS}.0)) FROM documents) AS buckets FROM scored)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY floor(place * buckets), doc_id, text_crc32, size) - 1 AS slot,
  CASE WHEN extra > list_max(s) THEN {SHARDS} ELSE shard END AS grown_shard
FROM placed"""

_KNN = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""

# a phrase starts first at the smallest (doc_id, start); a word goes if a phrase that is not first covers it
_REPEATS = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
phrase AS (
  SELECT doc_id, start, array_to_string(w[start:start + 19], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS start FROM w)),
firsts AS (SELECT p, min((doc_id, start)) AS f FROM phrase GROUP BY p),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS i FROM phrase JOIN firsts USING (p)
  WHERE (doc_id, start) <> f),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_NEAREST = """
SELECT r, p, min((CAST(xx - 2 * list_inner_product(x, c) + cc AS BIGINT), e)) AS best
FROM piece JOIN {book} USING (p) GROUP BY r, p"""


def _moved(book: str, nearest: str) -> str:
    # floor(sum / count) in whole numbers
    return f"""
SELECT p, e, coalesce(n.c, b.c) AS c, list_inner_product(coalesce(n.c, b.c), coalesce(n.c, b.c)) AS cc
FROM {book} b LEFT JOIN (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS c FROM (
    SELECT p, best[2] AS e, i, sum(CAST(x[i] AS BIGINT)) AS s, count(*) AS n
    FROM {nearest} JOIN piece USING (r, p), unnest(range(1, len(x) + 1)) t(i) GROUP BY 1, 2, 3)
  GROUP BY p, e) n USING (p, e)"""


_CODES = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS MATERIALIZED (
  SELECT r, vec_id, p, x, list_inner_product(x, x) AS xx FROM (
    SELECT r, vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM v, range(16) t(p))),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c, xx AS cc FROM piece QUALIFY e < 64),
near0 AS MATERIALIZED ({_NEAREST.format(book="book0")}),
book1 AS MATERIALIZED ({_moved("book0", "near0")}),
near1 AS MATERIALIZED ({_NEAREST.format(book="book1")}),
book2 AS MATERIALIZED ({_moved("book1", "near1")}),
near2 AS MATERIALIZED ({_NEAREST.format(book="book2")}),
coded AS (
  SELECT r, string_agg(format('{{:02x}}', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM near2 GROUP BY r),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(c[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM book2, unnest(range(1, len(c) + 1)) t(i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), digest"""

_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LEAKS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, w, least(10, len(w)) AS size
  FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
frame AS (
  SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS g
  FROM item, unnest(range(1, len(w) - size + 2)) t(s)),
place AS (
  SELECT r, s, size, array_to_string(w[s:s + size - 1], ' ') AS g
  FROM d, (SELECT DISTINCT size FROM frame), unnest(range(1, len(w) - size + 2)) t(s)),
found AS (SELECT r, s, size, item FROM place JOIN frame USING (size, g)),
hit AS (SELECT r, count(DISTINCT i) AS n_hit FROM found, unnest(range(s, s + size)) t(i) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

# contexts of 1, 2, 4, ... words; stretches whose latest earlier occurrence stays q back are runs of period q
_RUNS = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w,
    xor(list_reduce(list_prepend(4294967295, list_transform(
      range(1, 2 * strlen(CAST(doc_id AS VARCHAR)), 2), lambda i: CAST('0x' || hex(encode(CAST(doc_id AS VARCHAR)))[i:i + 1] AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM documents, crc_table),
part AS (
  SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS chosen,
    (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g FROM d),
text AS (
  SELECT r, doc_id, n, CASE WHEN chosen THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g)) + 1] END) ELSE w END AS w FROM part),
word AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM text),
context(s, r, n, i, g) AS (
  SELECT 1::BIGINT, r, n, i, hash(word) FROM word
  UNION ALL SELECT 2 * a.s, a.r, a.n, a.i, hash(a.g, b.g)
  FROM context a JOIN context b ON b.r = a.r AND b.i = a.i + a.s WHERE a.n >= 4 * (a.s + 1)),
lagged AS (SELECT s, r, i, i - lag(i) OVER (PARTITION BY s, r, g ORDER BY i) AS q FROM context),
grouped AS (
  SELECT s, r, i, q, i - row_number() OVER (PARTITION BY s, r, q ORDER BY i) AS k FROM lagged WHERE q > s // 2 AND q <= s),
run AS (
  SELECT r, min(i) - q AS start, max(i) - min(i) + s + q AS length, q AS period
  FROM grouped GROUP BY s, r, q, k HAVING length >= greatest(6, 4 * q)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r
    ORDER BY (CAST(length AS HUGEINT) * 4611686018427387904) // period DESC, start, period) AS place FROM run),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS x
  FROM run GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS x FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.x, '')) AS runs_sha256, sha256(coalesce(kept.x, '')) AS collapsed_sha256
FROM text LEFT JOIN listed USING (r) LEFT JOIN kept USING (r) LEFT JOIN (FROM ranked WHERE place = 1) USING (r)"""

SQL = {
    "op3_minhash": _NEAR,
    "op5_rendezvous": _SHARDS_SQL,
    "op8_voronoi_knn": _KNN,
    "op10_relative_lz": _REPEATS,
    "op11_hilbert_codes": _CODES,
    "op12_suffix_arrays": _LEAKS,
    "op13_periodic_runs": _RUNS,
}
