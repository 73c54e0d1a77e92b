"""Query of the Merkle manifest."""

from pyspark.sql import functions as F

from lanthorn.llm.merkle import FIELDS, manifest
from lanthorn.session import read_table, spread


def op12_merkle_manifest(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents").select(*FIELDS))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, altered=tampered, alter={"n_chars": F.try_add(F.col("n_chars"), F.lit(1))})
    return rows.withColumnRenamed("id", "doc_id")


QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}

#: Every level of every tree as rows; the crc32 bit by bit
ORACLES = {"op12_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, concat(
    coalesce(concat(octet_length(encode(CAST(doc_id AS VARCHAR))), ':', doc_id), '-'),
    coalesce(concat(octet_length(encode(source)), ':', source), '-'), coalesce(concat(octet_length(encode(lang)), ':', lang), '-')) AS head,
    n_chars, coalesce(concat(octet_length(encode(text)), ':', text), '-') AS tail,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda r, c: list_reduce(list_prepend(xor(r, c), [0::BIGINT,0,0,0,0,0,0,0]),
                            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)) AS crc
  FROM documents
), l AS (
  SELECT doc_id, lang, sha256(concat(head, coalesce(concat(octet_length(encode(CAST(n_chars AS VARCHAR))), ':', n_chars), '-'), tail)) AS leaf,
    CASE WHEN xor(crc, 4294967295::BIGINT) % 7 = 0
      THEN sha256(concat(head, coalesce(concat(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))), ':', n_chars + 1), '-'), tail)) END AS other,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n
  FROM d
), t AS (
  SELECT 0 AS lev, lang, p, n, leaf AS h FROM l
  UNION ALL
  SELECT any_value(lev) + 1, lang, p // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM t WHERE n > 1 GROUP BY lang, p // 2
), s AS (
  SELECT lang, h AS subroot, lev AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lev, p, n, subroot AS h FROM s
  UNION ALL
  SELECT any_value(lev) + 1, p // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM u WHERE n > 1 GROUP BY p // 2
), top AS (SELECT h AS root FROM u WHERE n = 1
), st AS (
  SELECT l.doc_id, t.lev, x.h AS sib, (l.p >> t.lev) % 2 = 1 AS is_right
  FROM l JOIN t ON t.lang IS NOT DISTINCT FROM l.lang AND t.p = l.p >> t.lev AND t.n > 1
  LEFT JOIN t x ON x.lang IS NOT DISTINCT FROM t.lang AND x.lev = t.lev AND x.p = xor(t.p, 1)
  UNION ALL
  SELECT l.doc_id, s.depth + u.lev, x.h, (s.p >> u.lev) % 2 = 1
  FROM l JOIN s ON s.lang IS NOT DISTINCT FROM l.lang JOIN u ON u.p = s.p >> u.lev AND u.n > 1
  LEFT JOIN u x ON x.lev = u.lev AND x.p = xor(u.p, 1)
), pr AS (SELECT doc_id, sha256(coalesce(string_agg(sib, '' ORDER BY lev), '')) AS proof FROM st GROUP BY doc_id
), f AS (
  SELECT doc_id, 0 AS lev, coalesce(other, leaf) AS h FROM l
  UNION ALL
  SELECT f.doc_id, f.lev + 1, sha256(CASE WHEN sib IS NULL THEN h WHEN is_right THEN concat(sib, h) ELSE concat(h, sib) END)
  FROM f JOIN st ON st.doc_id = f.doc_id AND st.lev = f.lev
), e AS (SELECT doc_id, arg_max(h, lev) AS folded FROM f GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.subroot, top.root, coalesce(pr.proof, sha256('')) AS proof_sha256, e.folded AS folded_root, e.folded = top.root AS verified
FROM l JOIN s ON s.lang IS NOT DISTINCT FROM l.lang JOIN top ON true LEFT JOIN pr ON pr.doc_id = l.doc_id JOIN e ON e.doc_id = l.doc_id
"""}
