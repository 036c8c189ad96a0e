"""DuckDB SQL of the corpus operators that SQL can express, over whole tables and texts."""

from __future__ import annotations

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), u AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.98
), walk AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT w.a, l.b FROM walk w JOIN links l ON w.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM walk GROUP BY a), d AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(d.n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN d ON d.a = vec_id
"""

OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rk, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
k AS (SELECT rk, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h),
g AS (SELECT rk, i FROM k JOIN f USING (h) WHERE first < doc_id),
t AS (SELECT rk, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
m AS (SELECT t.rk, p, word, max(g.i) OVER (PARTITION BY t.rk ORDER BY p) AS last FROM t LEFT JOIN g ON g.rk = t.rk AND g.i = t.p),
r AS (
  SELECT rk, count(*) AS n, count(*) FILTER (WHERE last >= p - 49) AS gone,
    string_agg(word, ' ' ORDER BY p) FILTER (WHERE last IS NULL OR last < p - 49) AS kept FROM m GROUP BY rk
)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (rk)
"""

_ALNUM = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH b AS (SELECT item_id, {_ALNUM.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
bi AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bk AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(w[i:i + n - 1], ' ') AS h FROM bi),
d AS (SELECT row_number() OVER () AS rk, doc_id, {_ALNUM.format("text")} AS w FROM documents),
di AS (SELECT rk, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bk) x WHERE len(w) >= n),
dk AS (SELECT rk, n, i, array_to_string(w[i:i + n - 1], ' ') AS h FROM di),
hits AS (SELECT rk, i, n, item FROM dk JOIN bk USING (n, h)),
words AS (SELECT DISTINCT rk, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rk, i, n FROM hits) y),
c AS (SELECT rk, count(*) AS n FROM words GROUP BY rk),
s AS (SELECT rk, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rk, item FROM hits) z GROUP BY rk)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(s.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rk) LEFT JOIN s USING (rk)
"""

OP10 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rk, doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rk, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS no FROM d),
t AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w, regexp_matches(line, '[^\x00-\x40\x5B-\x60\x7B-\x7F]') AS named FROM l
), u AS (
  SELECT rk, doc_id, no, CASE WHEN named THEN list_transform(w, lambda x: regexp_replace(x, '[0-9]+', '<*>', 'g')) ELSE w END AS w,
    len(w) AS n, list_transform(w[1:2], lambda x: CASE WHEN named AND regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS lead
  FROM t WHERE len(w) > 0 AND doc_id IS NOT NULL
), f AS (SELECT n, lead, w, min(struct_pack(a := doc_id, b := no)) AS pos FROM u GROUP BY n, lead, w),
c AS (
  SELECT n, lead, w, pos, 0 AS r FROM f
  UNION ALL
  SELECT n, lead, w, pos, r + 1 FROM (SELECT *, first_value(w) OVER (PARTITION BY n, lead ORDER BY pos) AS h FROM c)
  WHERE 5 * len(list_filter(list_zip(w, h), lambda p: p[1] <> p[2])) > n
), m AS (SELECT n, lead, w, max(r) AS r FROM c GROUP BY n, lead, w),
o AS (SELECT n, lead, r, min(pos.a) AS first FROM c GROUP BY n, lead, r),
g AS (SELECT DISTINCT rk, no, 1 AS gone FROM u JOIN m USING (n, lead, w) JOIN o USING (n, lead, r) WHERE first < doc_id),
k AS (
  SELECT rk, count(*) AS n, count(gone) AS gone, string_agg(line, chr(10) ORDER BY no) FILTER (WHERE gone IS NULL) AS kept
  FROM l LEFT JOIN g USING (rk, no) GROUP BY rk
)
SELECT doc_id, coalesce(n, 0) AS n_lines, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rk)
"""

OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS rk, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.rk AS ark, a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, a.rk = b.rk AS itself,
    CAST(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND len(a.e) = len(b.e)
), p AS (
  SELECT *, row_number() OVER (PARTITION BY ark ORDER BY score DESC, vec_id) AS k FROM s WHERE same AND NOT itself
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ark, p.k ORDER BY n.score DESC, n.vec_id) AS r
  FROM p JOIN s n ON n.ark = p.ark AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score WHERE p.k <= 5
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 5
"""

_CRC_STEP = "list_reduce(list_concat([xor(c, b)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))"

OP13 = f"""
WITH o AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT c, turns, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: {_CRC_STEP}), 4294967295) % 9 AS h FROM o
), r AS (SELECT h.c, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS turns FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5),
k AS (SELECT c, unnest(range(0, len(turns) + 1)) AS d, turns FROM r),
p AS (SELECT c, d, turns[1:d] AS key, turns[1:d - 1] AS parent, d = len(turns) AS ended FROM k),
g AS (
  SELECT d, key, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n, coalesce((count(*) - 1) * strlen(key[d].t), 0) AS saved,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ended) AS ends
  FROM p GROUP BY d, key
), ch AS (SELECT d - 1 AS d, parent AS key, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1, 2),
gc AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN ch USING (d, key)),
s AS (
  SELECT p.d, p.key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM gc JOIN p ON p.c = gc.conv_id AND p.d <= gc.d GROUP BY p.d, p.key
)
SELECT gc.conv_id, gc.d AS depth, u.conv_id AS parent_conv_id, gc.n AS n_convs, gc.n_children, n_leaves, saved_tokens, sha256(coalesce(gc.ends, '')) AS ends_sha256
FROM gc JOIN s USING (d, key) LEFT JOIN g u ON u.d = gc.d - 1 AND u.key = gc.parent
"""
