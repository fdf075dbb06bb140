"""The same results as plain SQL over the given tables, where SQL can say them (ids are distinct there)."""

from __future__ import annotations

import string

from lakepipe.llm import licenses

_COMPONENTS = """
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
components AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""


def jaccard_join(width: int = 3, percent: int = 90) -> str:
    words = f"string_split_regex(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\\x20\\x09-\\x0D]+')"
    window = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, list_filter({words}, lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {width} THEN list_transform(range(1, len(w) - {width} + 2), lambda i: {window})
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
nodes AS (SELECT doc_id AS id FROM documents),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM grams x JOIN grams y USING (gram)
           WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
          WHERE 100 * k >= {percent} * (x.n + y.n - k)),{_COMPONENTS}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM components LEFT JOIN sizes ON doc_id = id"""


def near_vectors(threshold: float = 0.93) -> str:
    return f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
          WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= {threshold}),{_COMPONENTS}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept
FROM components"""


def ranked_search(k: int = 10) -> str:
    folded = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    terms = f"regexp_extract_all({folded}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH split AS (SELECT doc_id, {terms} AS w FROM documents),
sizes AS (SELECT doc_id, len(w) AS n FROM split WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
postings AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM split) t GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) f, total),
asked AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), total
  GROUP BY item_id, doc_id),
placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM placed WHERE rank <= {k}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": jaccard_join(),
        "op7_near_vectors": near_vectors(),
        "op8_licence_rules": licenses.oracle_sql(),
        "op13_ranked_search": ranked_search(),
    }
