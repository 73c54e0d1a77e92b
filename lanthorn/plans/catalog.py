"""Catalog module bound to the driver's ``part`` table.

``part`` plays the listing: title = p_name, a price text built from
p_size and p_partkey, a star-rating word from p_size, an availability text from
p_partkey and category = p_type.  A few rows get planted defects (blank
title, free / missing price, unknown or lower-case rating word) so the
quarantine side is never empty.  The same expressions appear in every
oracle below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanthorn.functions import text as tx
from lanthorn.operators import clean as cl
from lanthorn.operators import relational as rel
from lanthorn.operators import quality as qa
from lanthorn.operators.ordinal import global_ordinal
from lanthorn.plans.registry import query
from lanthorn.session import read_table

# The five statements of the catalog's query suite, as written there.
STATEMENTS = {
    "01_select_where": """
        SELECT title, rating, in_stock
        FROM books
        WHERE rating = 5 AND in_stock = 1
        ORDER BY title
    """,
    "02_order_by_limit": """
        SELECT title, price_gbp
        FROM books
        ORDER BY price_gbp DESC
        LIMIT 10
    """,
    "03_distinct": """
        SELECT DISTINCT category_name AS category
        FROM categories
        ORDER BY category
    """,
    "04_between": """
        SELECT title, price_gbp
        FROM books
        WHERE price_gbp BETWEEN 20 AND 40
        ORDER BY price_gbp
    """,
    "05_join": """
        SELECT b.book_id, b.title, b.price_gbp, b.price_inr, b.rating, b.in_stock,
               c.category_name AS category
        FROM books AS b
        JOIN categories AS c ON b.category_id = c.category_id
        ORDER BY c.category_name ASC, b.rating DESC, b.book_id ASC
    """,
}


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    # price text "<size>.<key mod 100, two digits>": values 1.00 .. 50.99
    price_txt = F.concat(F.col("p_size").cast("string"), F.lit("."),
                         F.lpad((k % 100).cast("string"), 2, "0"))
    size7 = F.col("p_size") % 7
    rating_word = F.when(size7 == 1, "One").when(size7 == 2, "Two").when(size7 == 3, "Three") \
        .when(size7 == 4, "Four").when(size7 == 5, "Five").when(size7 == 6, "five")
    return p.select(
        k.alias("ordinal"),
        F.when(k % 53 == 0, F.lit(" \t\n")).otherwise(F.col("p_name")).alias("title"),
        F.when(k % 97 == 0, F.lit("free")).when(k % 89 == 0, F.lit(None).cast("string"))
         .when(k % 2 == 1, F.concat(F.lit("Â£"), price_txt))
         .otherwise(F.concat(F.lit("£"), price_txt)).alias("price"),
        rating_word.alias("star_rating"),
        F.when(k % 11 == 0, F.lit("Out of stock")).when(k % 11 == 1, F.lit("soon"))
         .otherwise(F.concat(F.lit("\tIn stock ("), F.col("p_size").cast("string"),
                             F.lit(" available) "))).alias("availability"),
        F.col("p_type").alias("category"),
    )


def catalog_tables(spark: SparkSession, sf_dir: str):
    raw = catalog_raw(spark, sf_dir)
    clean, dropped = cl.split_clean(raw, keep=["ordinal"])
    categories = cl.categories_table(clean)
    books = cl.books_table(clean, categories, arrival="ordinal")
    return raw, clean, dropped, categories, books


def register_catalog_views(spark: SparkSession, sf_dir: str):
    raw, clean, dropped, categories, books = catalog_tables(spark, sf_dir)
    books.createOrReplaceTempView("books")
    categories.createOrReplaceTempView("categories")
    return books, categories


# ---------------------------------------------------------------- oracle text
RAW_SQL = r"""
catalog_raw AS (
  SELECT p_partkey AS ordinal,
    CASE WHEN p_partkey % 53 = 0 THEN ' ' || chr(9) || chr(10) ELSE p_name END AS title,
    CASE WHEN p_partkey % 97 = 0 THEN 'free' WHEN p_partkey % 89 = 0 THEN NULL
         WHEN p_partkey % 2 = 1 THEN 'Â£' || CAST(p_size AS VARCHAR) || '.' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0')
         ELSE '£' || CAST(p_size AS VARCHAR) || '.' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') END AS price,
    CASE p_size % 7 WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three' WHEN 4 THEN 'Four'
         WHEN 5 THEN 'Five' WHEN 6 THEN 'five' END AS star_rating,
    CASE WHEN p_partkey % 11 = 0 THEN 'Out of stock' WHEN p_partkey % 11 = 1 THEN 'soon'
         ELSE chr(9) || 'In stock (' || CAST(p_size AS VARCHAR) || ' available) ' END AS availability,
    p_type AS category
  FROM part),
parsed AS (
  SELECT *,
    TRY_CAST(NULLIF(regexp_extract(price, '(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) AS price_gbp,
    CASE star_rating WHEN 'One' THEN 1 WHEN 'Two' THEN 2 WHEN 'Three' THEN 3 WHEN 'Four' THEN 4
         WHEN 'Five' THEN 5 END AS rating,
    CASE WHEN lower(availability) LIKE '%out of stock%' THEN false
         WHEN lower(availability) LIKE '%in stock%' THEN true END AS in_stock
  FROM catalog_raw),
marked AS (
  SELECT *, price_gbp * 105.5 AS price_inr,
    concat_ws(',',
      CASE WHEN NOT regexp_matches(coalesce(title, ''), '\S') THEN 'blank_title' END,
      CASE WHEN NOT regexp_matches(coalesce(category, ''), '\S') THEN 'blank_category' END,
      CASE WHEN price_gbp IS NULL THEN 'no_price' END,
      CASE WHEN rating IS NULL THEN 'no_rating' END,
      CASE WHEN in_stock IS NULL THEN 'no_availability' END) AS reasons
  FROM parsed),
clean AS (SELECT * FROM marked WHERE reasons = ''),
categories AS (
  SELECT CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS category_id,
         category AS category_name
  FROM (SELECT DISTINCT category FROM clean)),
books AS (
  SELECT CAST(row_number() OVER (ORDER BY c.ordinal) AS INTEGER) AS book_id, c.title, c.price_gbp,
         c.price_inr, c.rating, CAST(c.in_stock AS INTEGER) AS in_stock, k.category_id
  FROM clean c JOIN categories k ON c.category = k.category_name)
"""


def _with(body: str) -> str:
    return "WITH " + RAW_SQL.strip() + "\n" + body


# ---------------------------------------------------------------- queries
@query("parse_price", _with("SELECT ordinal, price, price_gbp FROM parsed"))
def q_parse_price(spark, sf_dir):
    return catalog_raw(spark, sf_dir).select("ordinal", "price",
                                             tx.parse_price("price").alias("price_gbp"))


@query("parse_rating", _with("SELECT ordinal, star_rating, rating FROM parsed"))
def q_parse_rating(spark, sf_dir):
    return catalog_raw(spark, sf_dir).select("ordinal", "star_rating",
                                             tx.parse_rating("star_rating").alias("rating"))


@query("parse_availability", _with("SELECT ordinal, availability, in_stock FROM parsed"))
def q_parse_availability(spark, sf_dir):
    return catalog_raw(spark, sf_dir).select(
        "ordinal", "availability", tx.parse_availability("availability").alias("in_stock"))


@query("clean_rows", _with("""
SELECT ordinal, title, price, star_rating, availability, category, price_gbp, rating, in_stock,
       price_inr FROM clean"""))
def q_clean_rows(spark, sf_dir):
    clean, _ = cl.split_clean(catalog_raw(spark, sf_dir), keep=["ordinal"])
    return clean


@query("quarantine_rows", _with("""
SELECT ordinal, title, price, star_rating, availability, category, price_gbp, rating, in_stock,
       reasons FROM marked WHERE reasons <> ''"""))
def q_quarantine_rows(spark, sf_dir):
    _, dropped = cl.split_clean(catalog_raw(spark, sf_dir))
    return dropped


@query("coerce_types", _with("""
SELECT ordinal, CAST(price_gbp AS DOUBLE) AS price_gbp, CAST(rating AS INTEGER) AS rating,
       CAST(in_stock AS BOOLEAN) AS in_stock FROM clean"""))
def q_coerce_types(spark, sf_dir):
    clean, _ = cl.split_clean(catalog_raw(spark, sf_dir), keep=["ordinal"])
    return clean.select("ordinal", "price_gbp", "rating", "in_stock")


@query("convert_currency", _with("SELECT ordinal, price_gbp, price_inr FROM clean"))
def q_convert_currency(spark, sf_dir):
    clean, _ = cl.split_clean(catalog_raw(spark, sf_dir), keep=["ordinal"])
    return clean.select("ordinal", "price_gbp", "price_inr")


@query("split_by_mask", _with("""
SELECT reasons = '' AS kept, count(*) AS n_rows FROM marked GROUP BY 1"""))
def q_split_by_mask(spark, sf_dir):
    clean, dropped = cl.split_clean(catalog_raw(spark, sf_dir))
    return (clean.select(F.lit(True).alias("kept"))
            .unionByName(dropped.select(F.lit(False).alias("kept")))
            .groupBy("kept").agg(F.count(F.lit(1)).alias("n_rows")))


@query("row_counts", _with("""
SELECT count(*) AS raw_rows, count(*) FILTER (WHERE reasons <> '') AS dropped_rows,
       count(*) FILTER (WHERE reasons = '') AS clean_rows,
       count(DISTINCT CASE WHEN reasons = '' THEN category END) AS clean_categories
FROM marked"""))
def q_row_counts(spark, sf_dir):
    return cl.row_counts(catalog_raw(spark, sf_dir))


@query("blank_test", _with("""
SELECT ordinal, NOT regexp_matches(coalesce(title, ''), '\\S') AS title_blank FROM catalog_raw"""))
def q_blank_test(spark, sf_dir):
    return catalog_raw(spark, sf_dir).select("ordinal", tx.is_blank("title").alias("title_blank"))


@query("text_normalise", _with("""
SELECT ordinal, lower(regexp_replace(availability, '^\\s+|\\s+$', '', 'g')) AS availability_norm,
       regexp_replace(regexp_replace(availability, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')
         AS availability_squeezed
FROM catalog_raw"""))
def q_text_normalise(spark, sf_dir):
    return catalog_raw(spark, sf_dir).select(
        "ordinal", tx.normalise("availability").alias("availability_norm"),
        tx.squeeze_ws("availability").alias("availability_squeezed"))


@query("dense_category_id", _with("SELECT category_id, category_name FROM categories"))
def q_dense_category_id(spark, sf_dir):
    _, clean, _, categories, _ = catalog_tables(spark, sf_dir)
    return categories


@query("arrival_id", _with("""
SELECT book_id, title, price_gbp, price_inr, rating, in_stock, category_id FROM books"""))
def q_arrival_id(spark, sf_dir):
    return catalog_tables(spark, sf_dir)[4]


@query("lookup_join", _with("""
SELECT c.ordinal, c.category, k.category_id FROM clean c LEFT JOIN categories k
  ON c.category = k.category_name"""))
def q_lookup_join(spark, sf_dir):
    _, clean, _, categories, _ = catalog_tables(spark, sf_dir)
    return rel.lookup_join(clean.select("ordinal", "category"), categories,
                           "category", "category_name", "category_id")


@query("position_index", _with("""
SELECT CAST(row_number() OVER (ORDER BY price_gbp DESC, book_id) AS BIGINT) AS position,
       book_id, price_gbp FROM books"""))
def q_position_index(spark, sf_dir):
    books = catalog_tables(spark, sf_dir)[4]
    return global_ordinal(books.select("book_id", "price_gbp"),
                          [F.col("price_gbp").desc(), F.col("book_id")], "position")


@query("project", _with("SELECT book_id, title, price_gbp FROM books"))
def q_project(spark, sf_dir):
    return catalog_tables(spark, sf_dir)[4].select("book_id", "title", "price_gbp")


@query("rename", _with("""
SELECT b.book_id, c.category_name AS category FROM books b JOIN categories c USING (category_id)"""))
def q_rename(spark, sf_dir):
    _, _, _, categories, books = catalog_tables(spark, sf_dir)
    return (books.join(categories, "category_id").select("book_id", "category_name")
            .withColumnRenamed("category_name", "category"))


@query("prefix_columns", _with("""
SELECT category_id AS cat_category_id, category_name AS cat_category_name FROM categories"""))
def q_prefix_columns(spark, sf_dir):
    return rel.prefix_columns(catalog_tables(spark, sf_dir)[3], "cat_")


@query("drop_columns", _with("SELECT book_id, title, rating FROM books"))
def q_drop_columns(spark, sf_dir):
    books = catalog_tables(spark, sf_dir)[4]
    return books.drop("price_gbp", "price_inr", "in_stock", "category_id")


@query("bool_to_int", _with("SELECT ordinal, CAST(in_stock AS INTEGER) AS in_stock FROM clean"))
def q_bool_to_int(spark, sf_dir):
    clean = catalog_tables(spark, sf_dir)[1]
    return clean.select("ordinal", F.col("in_stock").cast("int").alias("in_stock"))


@query("append_batches", _with("""
SELECT ordinal, title, category FROM catalog_raw
UNION ALL
SELECT ordinal, title, category FROM marked WHERE reasons <> ''"""))
def q_append_batches(spark, sf_dir):
    raw, _, dropped, _, _ = catalog_tables(spark, sf_dir)
    return rel.append_batches([raw.select("ordinal", "title", "category"),
                               dropped.select("ordinal", "title", "category")])


@query("quota_prefix", _with("""
, per_cat AS (
  SELECT category, min(ordinal) AS pos, count(*) FILTER (WHERE reasons = '') AS n_clean
  FROM marked GROUP BY category),
cum AS (
  SELECT *, sum(n_clean) OVER (ORDER BY pos, category) AS cum_rows,
         sum(CASE WHEN n_clean > 0 THEN 1 ELSE 0 END) OVER (ORDER BY pos, category) AS cum_cats
  FROM per_cat),
stop AS (SELECT min(pos) AS stop_pos FROM cum WHERE cum_rows >= 60 AND cum_cats >= 3)
SELECT r.* FROM catalog_raw r WHERE r.category IN (
  SELECT category FROM per_cat, stop WHERE pos <= stop_pos)""".replace("\n, per_cat", ", per_cat")))
def q_quota_prefix(spark, sf_dir):
    return cl.quota_prefix(catalog_raw(spark, sf_dir), "category", "ordinal", 60, 3)


# The five statements run as written, on the normalised tables.
@query("sql_01_select_where", _with(STATEMENTS["01_select_where"]))
def q_sql_01(spark, sf_dir):
    register_catalog_views(spark, sf_dir)
    return spark.sql(STATEMENTS["01_select_where"])


@query("sql_02_order_by_limit", _with("""
SELECT title, price_gbp FROM books ORDER BY price_gbp DESC, book_id LIMIT 10"""))
def q_sql_02(spark, sf_dir):
    # Driver prices can tie: the book id is added as tie-break so the ten
    # rows are one set in every engine.
    register_catalog_views(spark, sf_dir)
    return spark.sql("SELECT title, price_gbp FROM books ORDER BY price_gbp DESC, book_id LIMIT 10")


@query("sql_03_distinct", _with(STATEMENTS["03_distinct"]))
def q_sql_03(spark, sf_dir):
    register_catalog_views(spark, sf_dir)
    return spark.sql(STATEMENTS["03_distinct"])


@query("sql_04_between", _with(STATEMENTS["04_between"]))
def q_sql_04(spark, sf_dir):
    register_catalog_views(spark, sf_dir)
    return spark.sql(STATEMENTS["04_between"])


@query("sql_05_join", _with(STATEMENTS["05_join"]))
def q_sql_05(spark, sf_dir):
    register_catalog_views(spark, sf_dir)
    return spark.sql(STATEMENTS["05_join"])


@query("select_where", _with("""
SELECT title, rating, in_stock FROM books WHERE rating = 5 AND in_stock = 1"""))
def q_select_where(spark, sf_dir):
    books = catalog_tables(spark, sf_dir)[4]
    return (books.filter((F.col("rating") == 5) & (F.col("in_stock") == 1))
            .select("title", "rating", "in_stock").orderBy("title"))


@query("between", _with("""
SELECT title, price_gbp FROM books WHERE price_gbp BETWEEN 20 AND 40"""))
def q_between(spark, sf_dir):
    books = catalog_tables(spark, sf_dir)[4]
    return (books.filter(F.col("price_gbp").between(20, 40))
            .select("title", "price_gbp").orderBy("price_gbp"))


@query("order_by_limit", _with("""
SELECT book_id, title, price_gbp FROM books ORDER BY price_gbp DESC, book_id LIMIT 10"""))
def q_order_by_limit(spark, sf_dir):
    books = catalog_tables(spark, sf_dir)[4]
    return rel.top_k(books.select("book_id", "title", "price_gbp"), 10,
                     [F.col("price_gbp").desc(), F.col("book_id")])


@query("distinct_sorted", _with("SELECT DISTINCT category AS category FROM clean"))
def q_distinct_sorted(spark, sf_dir):
    clean = catalog_tables(spark, sf_dir)[1]
    return clean.select("category").distinct().orderBy("category")


@query("count_distinct", _with("""
SELECT count(DISTINCT category) AS n_categories, count(DISTINCT title) AS n_titles FROM clean"""))
def q_count_distinct(spark, sf_dir):
    clean = catalog_tables(spark, sf_dir)[1]
    return clean.agg(F.count_distinct("category").alias("n_categories"),
                     F.count_distinct("title").alias("n_titles"))


JOIN_ORDER_SQL = "ORDER BY c.category_name ASC, b.rating DESC, b.book_id ASC"


@query("inner_join_sql", _with(f"""
SELECT CAST(row_number() OVER ({JOIN_ORDER_SQL}) AS BIGINT) AS position, b.book_id, b.title,
       b.price_gbp, b.price_inr, b.rating, b.in_stock, c.category_name AS category
FROM books b JOIN categories c ON b.category_id = c.category_id"""))
def q_inner_join_sql(spark, sf_dir):
    register_catalog_views(spark, sf_dir)
    return rel.with_position(spark.sql(STATEMENTS["05_join"]), rel.join_order(), "position")


@query("inner_join_df", _with(f"""
SELECT CAST(row_number() OVER ({JOIN_ORDER_SQL}) AS BIGINT) AS position, b.book_id, b.title,
       b.price_gbp, b.price_inr, b.rating, b.in_stock, c.category_name AS category
FROM books b JOIN categories c ON b.category_id = c.category_id"""))
def q_inner_join_df(spark, sf_dir):
    _, _, _, categories, books = catalog_tables(spark, sf_dir)
    return rel.with_position(rel.catalog_join_df(books, categories), rel.join_order(), "position")


@query("multi_key_sort", _with(f"""
SELECT CAST(row_number() OVER ({JOIN_ORDER_SQL}) AS BIGINT) AS position, b.book_id,
       c.category_name AS category, b.rating
FROM books b JOIN categories c ON b.category_id = c.category_id"""))
def q_multi_key_sort(spark, sf_dir):
    _, _, _, categories, books = catalog_tables(spark, sf_dir)
    joined = rel.catalog_join_df(books, categories).select("book_id", "category", "rating")
    return rel.with_position(joined, rel.join_order(), "position")


_ZIP_SQL = f"""
, j AS (SELECT row_number() OVER ({JOIN_ORDER_SQL}) AS position, b.book_id, b.title, b.rating,
              c.category_name AS category
       FROM books b JOIN categories c ON b.category_id = c.category_id)
SELECT CAST(l.position AS BIGINT) AS position, l.book_id AS sql_book_id, l.title AS sql_title,
       l.rating AS sql_rating, l.category AS sql_category, r.book_id AS df_book_id,
       r.title AS df_title, r.rating AS df_rating, r.category AS df_category
FROM j l FULL OUTER JOIN j r ON l.position = r.position"""


@query("positional_zip", _with(_ZIP_SQL.replace("\n, j AS", ", j AS")))
def q_positional_zip(spark, sf_dir):
    books, categories = register_catalog_views(spark, sf_dir)
    cols = ["book_id", "title", "rating", "category"]
    sql_side = spark.sql(STATEMENTS["05_join"]).select(*cols)
    df_side = rel.catalog_join_df(books, categories).select(*cols)
    return rel.positional_zip(sql_side, df_side, rel.join_order(), "sql_", "df_")


@query("side_by_side", _with(_ZIP_SQL.replace("\n, j AS", ", j AS")))
def q_side_by_side(spark, sf_dir):
    return q_positional_zip(spark, sf_dir)


@query("frames_equal", _with("""
, j AS (SELECT b.book_id, b.title, b.price_gbp, b.price_inr, b.rating, b.in_stock,
              c.category_name AS category FROM books b JOIN categories c USING (category_id))
, k AS (SELECT b.book_id, b.title, b.price_gbp, b.price_inr, b.rating, b.in_stock,
              (SELECT max(c.category_name) FROM categories c WHERE c.category_id = b.category_id) AS category FROM books b
       WHERE b.category_id IN (SELECT category_id FROM categories)),
o AS (SELECT (SELECT count(*) FROM (SELECT * FROM j EXCEPT ALL SELECT * FROM k)) AS left_only,
             (SELECT count(*) FROM (SELECT * FROM k EXCEPT ALL SELECT * FROM j)) AS right_only)
SELECT left_only + right_only = 0 AS equal, (SELECT count(*) FROM j) AS left_rows, (SELECT count(*) FROM k) AS right_rows,
       left_only, right_only FROM o""".replace("\n, j AS", ", j AS")))
def q_frames_equal(spark, sf_dir):
    books, categories = register_catalog_views(spark, sf_dir)
    return rel.frames_equal(spark.sql(STATEMENTS["05_join"]), rel.catalog_join_df(books, categories),
                            order=rel.join_order())


@query("frames_differ", _with("""
, l AS (SELECT b.book_id, b.title, b.rating, c.category_name AS category FROM books b JOIN categories c USING (category_id)),
r AS (SELECT book_id, title, CASE WHEN book_id % 10 = 0 THEN rating + 1 WHEN book_id % 17 = 0 THEN NULL ELSE rating END AS rating,
             category FROM l WHERE book_id % 7 <> 0
      UNION ALL SELECT * FROM l WHERE book_id % 11 = 0)
SELECT false AS equal, (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
       (SELECT count(*) FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)) AS left_only,
       (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)) AS right_only""".replace("\n, l AS", ", l AS")))
def q_frames_differ(spark, sf_dir):
    """Planted differences: changed and nulled values, dropped rows, extra copies."""
    books, categories = register_catalog_views(spark, sf_dir)
    left = rel.catalog_join_df(books, categories).select("book_id", "title", "rating", "category")
    rating = F.when(F.col("book_id") % 10 == 0, F.col("rating") + 1).when(F.col("book_id") % 17 != 0, F.col("rating"))
    right = left.where("book_id % 7 <> 0").withColumn("rating", rating.cast(left.schema["rating"].dataType)) \
        .unionByName(left.where("book_id % 11 = 0"))
    return rel.frames_equal(left, right)


@query("constraint_audit", _with("""
SELECT 'books.book_id unique' AS rule, count(*) - count(DISTINCT book_id) AS violations FROM books
UNION ALL SELECT 'categories.category_name unique', count(*) - count(DISTINCT category_name)
  FROM categories
UNION ALL SELECT 'books not null', count(*) FILTER (WHERE title IS NULL OR price_gbp IS NULL
  OR price_inr IS NULL OR rating IS NULL OR in_stock IS NULL OR category_id IS NULL) FROM books
UNION ALL SELECT 'books.rating between 1 and 5', count(*) FILTER (WHERE NOT rating BETWEEN 1 AND 5)
  FROM books
UNION ALL SELECT 'books.in_stock in (0, 1)', count(*) FILTER (WHERE in_stock NOT IN (0, 1)) FROM books
UNION ALL SELECT 'books.category_id -> categories', count(*) FROM books b
  WHERE NOT EXISTS (SELECT 1 FROM categories c WHERE c.category_id = b.category_id)
UNION ALL SELECT 'orders.o_custkey -> customer', count(*) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'lineitem.l_orderkey -> orders', count(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem (l_orderkey, l_linenumber) unique',
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem
  GROUP BY l_orderkey, l_linenumber)"""))
def q_constraint_audit(spark, sf_dir):
    _, _, _, categories, books = catalog_tables(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    lineitem = read_table(spark, sf_dir, "lineitem")
    rules = [
        qa.expect_unique(books, ["book_id"], "books.book_id unique"),
        qa.expect_unique(categories, ["category_name"], "categories.category_name unique"),
        qa.expect_not_null(books, ["title", "price_gbp", "price_inr", "rating", "in_stock",
                                   "category_id"], "books not null"),
        qa.expect_between(books, "rating", 1, 5, "books.rating between 1 and 5"),
        qa.expect_in(books, "in_stock", [0, 1], "books.in_stock in (0, 1)"),
        qa.expect_fk(books, "category_id", categories, "category_id",
                     "books.category_id -> categories"),
        qa.expect_fk(orders, "o_custkey", customer, "c_custkey", "orders.o_custkey -> customer"),
        qa.expect_fk(lineitem, "l_orderkey", orders, "o_orderkey", "lineitem.l_orderkey -> orders"),
        qa.expect_unique(lineitem, ["l_orderkey", "l_linenumber"],
                         "lineitem (l_orderkey, l_linenumber) unique"),
    ]
    return qa.audit(rules)


@query("fk_audit", """
SELECT 'orders.o_custkey' AS relation, count(*) AS orphans FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem.l_partkey', count(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'lineitem.l_suppkey', count(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL SELECT 'labels.doc_id', count(*) FROM labels l
  WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)""")
def q_fk_audit(spark, sf_dir):
    t = {n: read_table(spark, sf_dir, n) for n in
         ("orders", "customer", "lineitem", "part", "supplier", "labels", "documents")}
    pairs = [("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
             ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
             ("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
             ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
             ("labels.doc_id", "labels", "doc_id", "documents", "doc_id")]
    parts = [rel.orphans(t[child], ck, t[parent], pk).agg(F.count(F.lit(1)).alias("orphans"))
             .select(F.lit(name).alias("relation"), "orphans")
             for name, child, ck, parent, pk in pairs]
    return rel.append_batches(parts)
