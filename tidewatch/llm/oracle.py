"""The contract queries that SQL can express, in DuckDB SQL."""

from __future__ import annotations

from tidewatch.llm import licenses


def license_scan() -> str:
    """Written from what is to hold: phrases word by word at each position; a template where enough different word pairs of it begin within a few words of their place."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    short = [(label, p.split(), base) for label, p, base in [(label, p, True) for p, label in licenses.BASE] + [(label, w, False) for label, w in licenses.TEMPLATES] if len(p.split()) <= licenses.SHORT_WORDS]
    long = [(n, label, w.split()) for n, (label, w) in enumerate(licenses.TEMPLATES) if len(w.split()) > licenses.SHORT_WORDS]
    at = " UNION ALL ".join(f"SELECT r, p - 1 AS p, '{label}' AS label, {base} AS base FROM g WHERE " + " AND ".join(f"w[p + {k}] = '{x}'" for k, x in enumerate(words)) for label, words, base in short)
    pairs = ", ".join(f"({n}, '{label}', {len(w) - 1}, {t}, '{w[t]}', '{w[t + 1]}')" for n, label, w in long for t in range(len(w) - 1))
    return f"""WITH t(template, label, pairs, t, a, b) AS (VALUES {pairs}),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
g AS MATERIALIZED (SELECT r, unnest(range(1, len(w))) AS p, w FROM d),
h AS ({at}),
v AS MATERIALIZED (SELECT r, template, label, pairs, t, p - 1 - t AS place FROM g JOIN t ON w[p] = a AND w[p + 1] = b),
f AS (SELECT x.r, x.label, count(DISTINCT y.t)::DOUBLE / x.pairs AS share FROM (SELECT DISTINCT r, template, label, pairs, place FROM v) x JOIN v y ON x.r = y.r AND x.template = y.template AND y.place BETWEEN x.place AND x.place + {licenses.DRIFT} GROUP BY x.r, x.template, x.label, x.pairs, x.place),
m AS (SELECT r, label, 1.0::DOUBLE AS share FROM h UNION ALL SELECT r, label, share FROM f WHERE share >= {licenses.LEAST_SHARE}::DOUBLE),
b AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h WHERE base GROUP BY r),
a AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r)"""


TOP_K = """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5"""


def near_duplicates() -> str:
    """All pairs that share a shingle, exact similarities, and what is reachable from each document."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g FROM d),
t AS MATERIALIZED (SELECT r, unnest(g) AS x FROM s),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM t a JOIN t b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
l AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM p JOIN s x ON x.r = p.a JOIN s y ON y.r = p.b WHERE 100 * n >= 80 * (len(x.g) + len(y.g) - n) AND x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
m AS (SELECT a, min(b) AS b FROM c GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(doc_id, b) AS component_id, coalesce(doc_id <= b, TRUE) AS kept FROM s LEFT JOIN m ON s.doc_id = m.a"""


#: Every 200-byte string of every text, as hexadecimal digits.
SUFFIX_DEDUP = """WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS MATERIALIZED (SELECT r, doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM d),
w AS MATERIALIZED (SELECT r, k, md5_number(substr(h, 2 * k + 1, 400)) AS x FROM (SELECT r, h, unnest(range(0, n_bytes - 199)) AS k FROM n)),
c AS (SELECT x FROM w GROUP BY x HAVING count(*) > 1),
m AS (SELECT r, k, CASE WHEN k <= lag(k) OVER (PARTITION BY r ORDER BY k) + 200 THEN 0 ELSE 1 END AS fresh FROM w SEMI JOIN c USING (x)),
s AS (SELECT r, min(k) AS a, max(k) + 200 AS b FROM (SELECT r, k, sum(fresh) OVER (PARTITION BY r ORDER BY k ROWS UNBOUNDED PRECEDING) AS span FROM m) GROUP BY r, span),
l AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS after FROM s),
g AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS till, string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS kept FROM l JOIN n USING (r) GROUP BY r)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(till, 0) + 1))) AS kept_sha256 FROM n LEFT JOIN g USING (r)"""


#: crc32 by its table, a byte at a time, over each different word.
TARGET_RESAMPLING = """WITH crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
q AS (SELECT list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
f AS MATERIALIZED (SELECT r, unnest(w) AS x FROM d),
g AS MATERIALIZED (SELECT unnest(w) AS x FROM q),
b AS MATERIALIZED (SELECT x, xor(list_reduce([4294967295] || list_transform(range(strlen(x)), lambda i: CAST('0x' || substr(hex(encode(x)), 2 * i + 1, 2) AS BIGINT)), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM (SELECT x FROM f UNION SELECT x FROM g), crc),
s AS (SELECT bucket, count(*) AS n FROM f JOIN b USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM g JOIN b USING (x) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM f)::DOUBLE AS s, (SELECT count(*) FROM g)::DOUBLE AS t),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (n.s + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * (n.t + 10000)))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket), n),
w AS (SELECT r, sum(gain) AS weight FROM f JOIN b USING (x) JOIN gain USING (bucket) GROUP BY r),
k AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w USING (r)),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM k),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, 10 * count(*) OVER () // 100 AS many FROM z WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= many THEN place END AS rank FROM z LEFT JOIN o USING (r)"""


def document_fingerprints() -> str:
    """Neighbours by a window over all rows, sets of hashes by list functions."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    hashes = lambda c: f"(SELECT list_transform(CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 4, 1) + 1) END, lambda i: substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 16)) FROM (SELECT list_filter(regexp_split_to_array(translate({c}, '{letters.upper()}', '{letters}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w))"
    kept = lambda c: f"CASE WHEN len({c}) > 0 AND len(list_filter({c}, lambda h: h < '2')) = 0 THEN [list_min({c})] ELSE list_sort(list_distinct(list_filter({c}, lambda h: h < '2'))) END"
    near = lambda a, b: f"CASE WHEN least(len({a}), len({b})) > 0 THEN len(list_intersect({a}, {b}))::DOUBLE / least(len({a}), len({b})) WHEN len({a}) = len({b}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, ''))) AS n, doc_id, coalesce(text, '') AS text FROM documents),
h AS MATERIALIZED (SELECT n, doc_id, text, {hashes('text')} AS h FROM d),
s AS MATERIALIZED (SELECT n, doc_id, text, {kept('h')} AS s FROM h),
p AS MATERIALIZED (SELECT a.doc_id, a.text, a.s, b.s AS t, left(a.text, length(a.text) - length(a.text) // 2) || left(b.text, length(a.text) // 2) AS edited FROM s a JOIN s b ON b.n = a.n % (SELECT count(*) FROM d) + 1),
e AS MATERIALIZED (SELECT *, {hashes('edited')} AS h FROM p),
k AS MATERIALIZED (SELECT *, {kept('h')} AS u FROM e)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(s, '') AS fingerprint, array_to_string(u, '') AS edited_fingerprint, {near('s', 'u')} AS near_edited, {near('s', 't')} AS near_next FROM k"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_scan(), "op5_minhash_near_dedup": near_duplicates(), "op8_suffix_dedup": SUFFIX_DEDUP, "op9_exact_topk": TOP_K, "op11_target_resampling": TARGET_RESAMPLING, "op13_document_fingerprints": document_fingerprints()}
