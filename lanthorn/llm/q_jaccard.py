"""Query of the n-gram Jaccard join."""

from lanthorn.llm.jaccard import jaccard_components
from lanthorn.session import read_table, spread


def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op4_ngram_jaccard_join": op4_ngram_jaccard_join}

#: Smallest document reachable over links by brute force: all pairs that share a shingle
ORACLES = {"op4_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS sh
  FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce((SELECT min(y) FROM r WHERE r.x = s.doc_id), s.doc_id)) AS component_id
FROM s
"""}
