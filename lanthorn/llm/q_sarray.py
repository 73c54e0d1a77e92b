"""Query of the repeated-string removal."""

from lanthorn.llm.sarray import repeated_spans
from lanthorn.session import read_table, spread


def op1_suffix_array_dedup(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return repeated_spans(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op1_suffix_array_dedup": op1_suffix_array_dedup}

#: Every 200-byte string counted outright
ORACLES = {"op1_suffix_array_dedup": r"""
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), w AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM t
), h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_slice(b, i, i + 199)) AS n FROM w
), p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM h WHERE n > 1
), g AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM p
), r AS (SELECT doc_id, min(i) AS s, max(i) + 199 AS e FROM g GROUP BY doc_id, run
), k AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS done FROM r
), a AS (SELECT doc_id, sum(e - s + 1) AS removed, count(*) AS spans, max(e) AS upto FROM k GROUP BY doc_id
), f AS (SELECT k.doc_id, string_agg(hex(array_slice(b, done + 1, s - 1)), '' ORDER BY s) AS front
         FROM k JOIN t USING (doc_id) WHERE s > done + 1 GROUP BY k.doc_id)
SELECT t.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || CASE WHEN coalesce(upto, 0) < octet_length(b)
                    THEN hex(array_slice(b, coalesce(upto, 0) + 1, octet_length(b))) ELSE '' END)) AS kept_sha256
FROM t LEFT JOIN a USING (doc_id) LEFT JOIN f USING (doc_id)
"""}
