"""Query of the ranked lexical search."""

from lanthorn.llm.fptree import rank_documents
from lanthorn.session import read_table, spread


def op11_ranked_search(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rank_documents(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {"op11_ranked_search": op11_ranked_search}

#: Every document that shares a term with an item scored outright
ORACLES = {"op11_ranked_search": r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term
), len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
), tot AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM len
), m AS (SELECT doc_id, 100 - 75 + (75 * n * nd) // l AS m FROM len, tot
), w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, tot GROUP BY term
), q AS (SELECT item_id, term, count(*) AS c FROM i GROUP BY item_id, term
), s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
         FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
), r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""}
