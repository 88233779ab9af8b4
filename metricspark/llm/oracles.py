"""SQL of the queries that DuckDB can express, over the same tables."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
  FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(p) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
  FROM d, ks, unnest(range(1, len(w) - k + 2)) AS t(p) WHERE len(w) >= k),
hit AS (SELECT dw.*, item_id FROM dw JOIN iw USING (k, win)),
cov AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT DISTINCT doc_id, p, k FROM hit) h, unnest(range(p, p + k)) AS t(q) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


OP5 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS g FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.g::DOUBLE[], c.g::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.row <> c.row AND len(q.g) = len(c.g)),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP1 = """
WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
k AS (SELECT conv_id AS pair_id, coalesce(max(turn) FILTER (role = 'assistant'), 0) AS cut FROM t GROUP BY conv_id),
c AS (SELECT pair_id, turn, min({'a': role, 'b': text}) AS s FROM t JOIN k ON conv_id = pair_id GROUP BY ALL),
r AS (
  SELECT pair_id, turn, min({'a': role, 'b': text}) AS s
  FROM t JOIN k ON (conv_id = pair_id AND turn < cut) OR (conv_id = xor(pair_id, 1) AND turn >= cut) GROUP BY ALL),
j AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, c.s AS cs, r.s AS rs
  FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.turn = r.turn),
f AS (SELECT pair_id, min(turn) AS split FROM j WHERE cs IS DISTINCT FROM rs GROUP BY pair_id),
p AS (SELECT j.*, turn < coalesce(split, turn + 1) AS shared FROM j LEFT JOIN f USING (pair_id)),
u AS (
  SELECT pair_id, CASE WHEN shared THEN 'prompt' ELSE 'chosen' END AS part, turn, cs AS s FROM p WHERE cs IS NOT NULL
  UNION ALL SELECT pair_id, 'rejected', turn, rs FROM p WHERE NOT shared AND rs IS NOT NULL)
SELECT pair_id, part, turn, '<|' || coalesce(s.a, 'unknown') || '|>' || chr(10) || coalesce(s.b, '') || chr(10) AS rendered,
  (length(coalesce(s.a, 'unknown')) + 5)::INT AS header_length, part <> 'prompt' AND coalesce(s.a = 'assistant', false) AS trained
FROM u
"""


#: Host, path and verdict, the longest first.
_RULES = (
    ("example.org", "/en/1", "block"),
    ("example.org", "/es/", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
    ("org", "/", "allow"),
)
_FITS = [(f"('.' || host).ends_with('.{h}') AND starts_with(path, '{p}')", f"{h}{p}", v) for h, p, v in _RULES]

OP11 = f"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {fits} THEN '{rule}'" for fits, rule, _ in _FITS)} END AS rule,
  CASE {" ".join(f"WHEN {fits} THEN '{verdict}'" for fits, _, verdict in _FITS)} ELSE 'allow' END AS verdict
FROM u
"""

OP12 = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, {LOWER} AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, w[i:i + k - 1] AS g FROM w, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i)),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY ALL HAVING f >= 10),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang HAVING n > 0),
c AS (
  SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
  FROM f c, unnest(range(1, len(c.g))) AS t(k)
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:len(c.g)]),
m AS (SELECT lang, g, a, arg_min({{'l': l, 'r': r, 'score': score}}, score * 10 + k) AS m FROM c GROUP BY ALL),
inner_ AS (
  SELECT lang, unnest([g[1:2], g[2:3]]) AS g, f FROM f WHERE len(g) = 3),
gone AS (SELECT m.lang, m.g FROM m JOIN (SELECT lang, g, max(f) AS f FROM inner_ GROUP BY ALL) i USING (lang, g) WHERE 100 * i.f >= 50 * a),
k AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, m.l AS l, m.r AS r, m.score AS score FROM m ANTI JOIN gone USING (lang, g)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000
"""

OP13 = f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM grp LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 5) // (n + 5 * v) AS p
  FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term),
ln AS (SELECT lang, sum(n) AS n FROM gn GROUP BY lang),
q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 5) // (any_value(n) + 5 * any_value(v)) AS q
  FROM c JOIN ln USING (lang) JOIN v USING (lang) GROUP BY lang, term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS s
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) z
  ON z.lang = a.lang AND z.source = a.source AND z.other = b.source),
term AS (SELECT p.lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""

ORACLES = {
    "op1_preference_formatting": OP1,
    "op5_kd_tree_search": OP5,
    "op9_decontamination": OP9,
    "op11_url_filter": OP11,
    "op12_phrase_mining": OP12,
    "op13_source_divergence": OP13,
}
