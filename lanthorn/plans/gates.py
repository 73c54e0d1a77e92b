"""Quality gates one rule family at a time, bound to the driver tables.

``constraint_audit`` and ``quality_gates`` run several rule families in one
report; here each family (``expect_*``) has its own entry, over whole
tables, with rules that hold and rules that are broken (the drv line-item
key is not unique, the passenger table has planted nulls, the line-item
table is smaller than a million rows at small scale factors).  Every entry
returns (rule, violations); ``quality.enforce`` turns such a report into an
error where a pipeline must stop.
"""

from __future__ import annotations

from lanthorn.operators import quality as qa
from lanthorn.operators import relational as rel
from lanthorn.plans import analytics as an
from lanthorn.plans import catalog as cat
from lanthorn.plans.registry import query
from lanthorn.session import read_table


@query("expect_nonempty", cat._with("""
SELECT 'categories not empty' AS rule,
  CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS violations FROM categories
UNION ALL SELECT 'user turns not empty',
  CAST(CASE WHEN count(*) FILTER (WHERE role = 'user') > 0 THEN 0 ELSE 1 END AS BIGINT) FROM conversations
UNION ALL SELECT 'moderator turns not empty',
  CAST(CASE WHEN count(*) FILTER (WHERE role = 'moderator') > 0 THEN 0 ELSE 1 END AS BIGINT)
  FROM conversations"""))
def q_expect_nonempty(spark, sf_dir):
    categories = cat.catalog_tables(spark, sf_dir)[3]
    conv = read_table(spark, sf_dir, "conversations")
    return qa.audit([
        qa.expect_nonempty(categories, "categories not empty"),
        qa.expect_nonempty(conv.filter("role = 'user'"), "user turns not empty"),
        qa.expect_nonempty(conv.filter("role = 'moderator'"), "moderator turns not empty"),
    ])


@query("expect_min_rows", cat._with("""
SELECT 'at least 60 clean books' AS rule, CAST(greatest(60 - count(*), 0) AS BIGINT) AS violations
  FROM clean
UNION ALL SELECT 'at least 1000000 line items', CAST(greatest(1000000 - count(*), 0) AS BIGINT)
  FROM lineitem"""))
def q_expect_min_rows(spark, sf_dir):
    clean = cat.catalog_tables(spark, sf_dir)[1]
    return qa.audit([
        qa.expect_min_rows(clean, 60, "at least 60 clean books"),
        qa.expect_min_rows(read_table(spark, sf_dir, "lineitem"), 1000000,
                           "at least 1000000 line items"),
    ])


@query("expect_min_distinct", cat._with("""
SELECT 'at least 3 categories' AS rule,
  CAST(greatest(3 - count(DISTINCT category), 0) AS BIGINT) AS violations FROM clean
UNION ALL SELECT 'at least 10 order priorities',
  CAST(greatest(10 - count(DISTINCT o_orderpriority), 0) AS BIGINT) FROM orders"""))
def q_expect_min_distinct(spark, sf_dir):
    clean = cat.catalog_tables(spark, sf_dir)[1]
    return qa.audit([
        qa.expect_min_distinct(clean, "category", 3, "at least 3 categories"),
        qa.expect_min_distinct(read_table(spark, sf_dir, "orders"), "o_orderpriority", 10,
                               "at least 10 order priorities"),
    ])


@query("expect_equal", cat._with("""
, j AS (SELECT b.book_id, b.title, b.price_gbp, b.price_inr, b.rating, b.in_stock,
              c.category_name AS category FROM books b JOIN categories c USING (category_id)),
k AS (SELECT b.book_id, b.title, b.price_gbp, b.price_inr, b.rating, b.in_stock,
             (SELECT max(c.category_name) FROM categories c WHERE c.category_id = b.category_id) AS category FROM books b
      WHERE b.category_id IN (SELECT category_id FROM categories))
SELECT 'sql join equals frame join' AS rule, (SELECT count(*) FROM (SELECT * FROM j EXCEPT ALL SELECT * FROM k))
  + (SELECT count(*) FROM (SELECT * FROM k EXCEPT ALL SELECT * FROM j)) + abs((SELECT count(*) FROM j) - (SELECT count(*) FROM k)) AS violations"""
                                     .replace("\n, j AS", ", j AS")))
def q_expect_equal(spark, sf_dir):
    """The catalog join by SQL and by the frame API, rows and order compared."""
    from pyspark.sql import functions as F

    books, categories = cat.register_catalog_views(spark, sf_dir)
    eq = rel.frames_equal(spark.sql(cat.STATEMENTS["05_join"]), rel.catalog_join_df(books, categories),
                          order=rel.join_order())
    return eq.select(F.lit("sql join equals frame join").alias("rule"),
                     (F.col("left_only") + F.col("right_only")
                      + F.abs(F.col("left_rows") - F.col("right_rows"))).cast("long").alias("violations"))


@query("expect_unique", cat._with("""
SELECT 'books.book_id unique' AS rule, CAST(count(*) - count(DISTINCT book_id) AS BIGINT) AS violations
  FROM books
UNION ALL SELECT 'customer.c_custkey unique', CAST(count(*) - count(DISTINCT c_custkey) AS BIGINT)
  FROM customer
UNION ALL SELECT 'lineitem (l_orderkey, l_linenumber) unique',
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem
  GROUP BY l_orderkey, l_linenumber)"""))
def q_expect_unique(spark, sf_dir):
    books = cat.catalog_tables(spark, sf_dir)[4]
    return qa.audit([
        qa.expect_unique(books, ["book_id"], "books.book_id unique"),
        qa.expect_unique(read_table(spark, sf_dir, "customer"), ["c_custkey"], "customer.c_custkey unique"),
        qa.expect_unique(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                         "lineitem (l_orderkey, l_linenumber) unique"),
    ])


@query("expect_not_null", an._with("""
SELECT 'passengers key and target not null' AS rule,
  count(*) FILTER (WHERE passenger_id IS NULL OR survived IS NULL) AS violations FROM passengers
UNION ALL SELECT 'passengers age not null', count(*) FILTER (WHERE age IS NULL) FROM passengers
UNION ALL SELECT 'passengers age or embarked not null',
  count(*) FILTER (WHERE age IS NULL OR embarked IS NULL) FROM passengers"""))
def q_expect_not_null(spark, sf_dir):
    p = an.passengers(spark, sf_dir)
    return qa.audit([
        qa.expect_not_null(p, ["passenger_id", "survived"], "passengers key and target not null"),
        qa.expect_not_null(p, ["age"], "passengers age not null"),
        qa.expect_not_null(p, ["age", "embarked"], "passengers age or embarked not null"),
    ])


@query("expect_between", cat._with("""
SELECT 'books.rating between 1 and 5' AS rule,
  count(*) FILTER (WHERE NOT rating BETWEEN 1 AND 5) AS violations FROM books
UNION ALL SELECT 'lineitem.l_discount between 0 and 0.1',
  count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.1) FROM lineitem
UNION ALL SELECT 'lineitem.l_quantity between 1 and 40',
  count(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 40) FROM lineitem
UNION ALL SELECT 'books.in_stock in (0, 1)', count(*) FILTER (WHERE in_stock NOT IN (0, 1)) FROM books
UNION ALL SELECT 'lineitem.l_returnflag in (A, N)',
  count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem"""))
def q_expect_between(spark, sf_dir):
    books = cat.catalog_tables(spark, sf_dir)[4]
    li = read_table(spark, sf_dir, "lineitem")
    return qa.audit([
        qa.expect_between(books, "rating", 1, 5, "books.rating between 1 and 5"),
        qa.expect_between(li, "l_discount", 0, 0.1, "lineitem.l_discount between 0 and 0.1"),
        qa.expect_between(li, "l_quantity", 1, 40, "lineitem.l_quantity between 1 and 40"),
        qa.expect_in(books, "in_stock", [0, 1], "books.in_stock in (0, 1)"),
        qa.expect_in(li, "l_returnflag", ["A", "N"], "lineitem.l_returnflag in (A, N)"),
    ])


@query("expect_fk", cat._with("""
SELECT 'books.category_id -> categories' AS rule, count(*) AS violations FROM books b
  WHERE NOT EXISTS (SELECT 1 FROM categories c WHERE c.category_id = b.category_id)
UNION ALL SELECT 'labels.doc_id -> documents', count(*) FROM labels l
  WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL SELECT 'lineitem.l_partkey -> part', count(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'embeddings.vec_id -> documents', count(*) FROM embeddings e
  WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = e.vec_id)"""))
def q_expect_fk(spark, sf_dir):
    _, _, _, categories, books = cat.catalog_tables(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents")
    return qa.audit([
        qa.expect_fk(books, "category_id", categories, "category_id", "books.category_id -> categories"),
        qa.expect_fk(read_table(spark, sf_dir, "labels"), "doc_id", docs, "doc_id",
                     "labels.doc_id -> documents"),
        qa.expect_fk(read_table(spark, sf_dir, "lineitem"), "l_partkey", read_table(spark, sf_dir, "part"),
                     "p_partkey", "lineitem.l_partkey -> part"),
        qa.expect_fk(read_table(spark, sf_dir, "embeddings"), "vec_id", docs, "doc_id",
                     "embeddings.vec_id -> documents"),
    ])
