"""DuckDB SQL for the queries that SQL can express: plain joins and windows
over whole tables, by none of the operators' methods."""

from __future__ import annotations

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, word: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{word}')"


BLANK_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = rf"""
WITH a AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{CAPITALS}', '{SMALL}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             coalesce(len(regexp_extract_all(html, '[#*$%&]{{3}}')) >= 20, false) AS junk FROM a),
c AS (SELECT *, bool_or(junk) OVER (PARTITION BY host || path) AS listed,
             CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM b)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict FROM c
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, {_words('text', BLANK_WORD)} AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 12), ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d)),
hits AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS f FROM windows) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM hits),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(f"translate(text, '{CAPITALS}', '{SMALL}')", BLANK_WORD)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_ AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ ON a = doc_id
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, {_words(f"translate(text, '{CAPITALS}', '{SMALL}')", ALNUM_WORD)} AS w FROM documents),
b AS (SELECT item_id, {_words(f"translate(text, '{CAPITALS}', '{SMALL}')", ALNUM_WORD)} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS k
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS k
           FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes)),
hits AS (SELECT doc_id, s, p.size AS size, item_id FROM places p JOIN windows USING (size, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP12 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
             translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[.,;:!?\x0A-\x0D]') AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(p) AS p FROM d)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, list_slice(w, s, s + k - 1) AS g, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM w, (VALUES (1), (2), (3)) AS t(k))
      GROUP BY lang, list_slice(w, s, s + k - 1)),
c AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1 AND f >= 10),
cuts AS (SELECT c.*, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
         FROM c JOIN f AS x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
                JOIN f AS y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
longer AS (SELECT lang, g, max(f) AS f FROM (
             SELECT lang, list_slice(g, 1, 2) AS g, f FROM f WHERE len(g) = 3 AND f >= 10
             UNION ALL SELECT lang, list_slice(g, 2, 3) AS g, f FROM f WHERE len(g) = 3 AND f >= 10) GROUP BY lang, g),
kept AS (SELECT low.*, array_to_string(low.g, ' ') AS phrase FROM low LEFT JOIN longer USING (lang, g)
         WHERE longer.f IS NULL OR 100 * longer.f < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

OP13 = """
WITH r AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM r WHERE vec_id % 100 = 0),
s AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, r.row, r.vec_id, r.label = a.label AS same,
             CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
      FROM a JOIN r ON a.row <> r.row),
p AS (SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
        AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""

SQL: dict[str, str] = {
    "op2_url_filter": OP2,
    "op6_substring_dedup": OP6,
    "op9_minhash_near_dedup": OP9,
    "op10_decontamination": OP10,
    "op12_collocations": OP12,
    "op13_hard_negatives": OP13,
}
