"""SQL twins in DuckDB's dialect, over whole tables; no code or table is shared with the operators."""

from __future__ import annotations

import string


def lowered(column: str) -> str:
    """Only A-Z change."""
    return f"translate(coalesce({column}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def closure(links: str, nodes: str, key: str) -> str:
    """Recursive table reach(node, root): every node with each smaller node that leads to it, and itself."""
    return f"""
  reach(node, root) AS (
    SELECT {key}, {key} FROM {nodes}
    UNION
    SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.node WHERE l.b > r.root
  )"""


NEAR_DOCUMENTS = rf"""
WITH RECURSIVE
  texts AS (
    SELECT doc_id, regexp_extract_all({lowered('text')}, '[^\x20\x09-\x0D]+') AS words FROM documents
  ),
  classes AS (
    SELECT array_to_string(words, ' ') AS body, min(doc_id) AS class, any_value(words) AS words
    FROM texts WHERE len(words) > 0 GROUP BY 1
  ),
  shingles AS (
    SELECT DISTINCT class, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT class, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM classes)
  ),
  sizes AS (SELECT class, count(*) AS n FROM shingles GROUP BY 1),
  shared AS (
    SELECT x.class AS a, y.class AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.class < y.class GROUP BY 1, 2
  ),
  half AS (
    SELECT o.a, o.b FROM shared o JOIN sizes s ON s.class = o.a JOIN sizes t ON t.class = o.b
    WHERE 100 * o.n >= 75 * (s.n + t.n - o.n)
  ),
  links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
  {closure('links', 'classes', 'class')},
  roots AS (SELECT node, min(root) AS root FROM reach GROUP BY 1)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.root, t.doc_id) AS component_id,
  t.doc_id = coalesce(r.root, t.doc_id) AS kept
FROM texts t
LEFT JOIN classes c ON len(t.words) > 0 AND c.body = array_to_string(t.words, ' ')
LEFT JOIN sizes s ON s.class = c.class
LEFT JOIN roots r ON r.node = c.class
"""


CONTAMINATION_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

CONTAMINATION = f"""
WITH
  texts AS (
    SELECT doc_id, regexp_extract_all({lowered('text')}, {CONTAMINATION_WORDS}) AS words FROM documents
  ),
  items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({lowered('text')}, {CONTAMINATION_WORDS}) AS words
    FROM benchmark WHERE item_id IS NOT NULL
  ),
  item_windows AS (
    SELECT DISTINCT item, words[i:i + 9] AS terms
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)
  ),
  positions AS (SELECT doc_id, unnest(words) AS term, generate_subscripts(words, 1) AS i FROM texts),
  starts AS (SELECT DISTINCT terms[1] AS term, len(terms) AS size FROM item_windows),
  places AS (
    SELECT p.doc_id, p.i, s.size, t.words[p.i:p.i + s.size - 1] AS terms
    FROM positions p JOIN starts s USING (term) JOIN texts t USING (doc_id)
    WHERE p.i + s.size - 1 <= len(t.words)
  ),
  found AS (SELECT p.doc_id, p.i, p.size, w.item FROM places p JOIN item_windows w USING (terms)),
  hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY 1
  ),
  found_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
  ),
  frequency AS (
    SELECT term, count(DISTINCT doc_id) AS n FROM positions GROUP BY 1
  ),
  anchors AS (
    SELECT terms, arg_min(term, n * 100 + j) AS anchor
    FROM (
      SELECT w.terms, w.term, w.j, coalesce(f.n, 0) AS n
      FROM (
        SELECT terms, unnest(terms) AS term, generate_subscripts(terms, 1) AS j
        FROM (SELECT DISTINCT terms FROM item_windows)
      ) w LEFT JOIN frequency f USING (term)
    ) GROUP BY 1
  ),
  around AS (
    SELECT p.doc_id, p.term, t.words[greatest(p.i - 11, 1):p.i + 11] AS span
    FROM positions p JOIN (SELECT DISTINCT anchor AS term FROM anchors) USING (term) JOIN texts t USING (doc_id)
  ),
  near AS (
    SELECT a.doc_id, count(DISTINCT n.terms) AS n_near
    FROM around a JOIN anchors n ON n.anchor = a.term AND list_has_all(a.span, n.terms) GROUP BY 1
  )
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
  h.n_hit IS NOT NULL AS contaminated, CAST(coalesce(n.n_near, 0) AS BIGINT) AS n_near
FROM texts t LEFT JOIN hits h USING (doc_id) LEFT JOIN found_items i USING (doc_id) LEFT JOIN near n USING (doc_id)
"""


NEAR_VECTORS = f"""
WITH RECURSIVE
  vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  usable AS (
    SELECT vec_id, v FROM vectors
    WHERE len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in v if x <> 0]) > 0
  ),
  lengths AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM usable),
  units AS (SELECT vec_id, [x / size for x in v] AS v FROM lengths),
  links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_dot_product(x.v, y.v) >= 0.95
  ),
  counted AS (SELECT a, count(*) AS n FROM links GROUP BY 1),
  {closure('links', 'units', 'vec_id')},
  roots AS (SELECT node, min(root) AS root FROM reach GROUP BY 1)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, coalesce(r.root, v.vec_id) AS component_id,
  v.vec_id = coalesce(r.root, v.vec_id) AS kept
FROM vectors v LEFT JOIN counted c ON c.a = v.vec_id LEFT JOIN roots r ON r.node = v.vec_id
"""


PHRASES = rf"""
WITH
  pieces AS (
    SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, {lowered('text')} AS body FROM documents)
  ),
  words AS (
    SELECT lang, p, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
  ),
  following AS (
    SELECT lang, w1, lead(w1) OVER place AS w2, lead(w1, 2) OVER place AS w3
    FROM words WINDOW place AS (PARTITION BY p ORDER BY i)
  ),
  grams AS (
    SELECT lang, 1 AS k, w1 AS phrase FROM following
    UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM following WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM following WHERE w3 IS NOT NULL
  ),
  counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
  totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY 1),
  cuts AS (
    SELECT lang, phrase, f AS a, cut, string_split(phrase, ' ') AS w
    FROM counts, (VALUES (1), (2)) AS places(cut) WHERE k > 1 AND f >= 10 AND cut < k
  ),
  valued AS (
    SELECT c.lang, c.phrase, c.a, c.cut, c.w, x.f AS l, y.f AS r,
      (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.k = c.cut AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.k = len(c.w) - c.cut AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
  ),
  candidates AS (
    SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
  ),
  inner_pairs AS (
    SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase
    FROM candidates, (VALUES (1), (2)) AS places(i) WHERE len(w) = 3
  ),
  kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
      SELECT 1 FROM inner_pairs p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 50 * c.a)
  ),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
  )
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


ORACLE_SQL: dict[str, str] = {
    "op5_minhash_near_dedup": NEAR_DOCUMENTS,
    "op8_benchmark_decontamination": CONTAMINATION,
    "op10_projection_dedup": NEAR_VECTORS,
    "op11_phrase_mining": PHRASES,
}
