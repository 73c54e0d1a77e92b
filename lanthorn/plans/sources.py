"""Source and sink bindings: pages, link chains, CSV, table replacement, SQL suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanthorn.operators import quality as qa
from lanthorn.plans import analytics as an
from lanthorn.plans import catalog as cat
from lanthorn.plans.registry import query
from lanthorn.session import read_table, scratch_path, spread
from lanthorn.sources import files as fs
from lanthorn.sources import html as hx

PAGE_FIELDS = [
    hx.FieldSpec("title", "title", "text"),
    hx.FieldSpec("heading", "article h1", "text"),
    hx.FieldSpec("paragraphs", "article p", "count"),
    hx.FieldSpec("nav_links", "nav a", "count"),
    hx.FieldSpec("ad", "div.ad", "joined"),
]


def _dec(x: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


@query("html_extract_records", f"""
SELECT page_id, 0 AS position,
  {_dec(_strip("regexp_extract(html, '(?s)<title>([^<]*)</title>', 1)"))} AS title,
  {_dec(_strip("regexp_extract(html, '(?s)<h1>([^<]*)</h1>', 1)"))} AS heading,
  CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')) AS INTEGER)
    AS paragraphs,
  CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a ')) AS INTEGER) AS nav_links,
  {_dec(_strip("regexp_extract(html, '(?s)<div class=\"ad\">([^<]*)</div>', 1)"))} AS ad
FROM pages""")
def q_html_extract_records(spark, sf_dir):
    pages = spread(read_table(spark, sf_dir, "pages"))
    return hx.extract_records(pages, "page_id", "html", "", PAGE_FIELDS)


_LINKS_SQL = """
, tags AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a [^>]*>[^<]*</a>')) AS tag,
                  generate_subscripts(regexp_extract_all(html, '<a [^>]*>[^<]*</a>'), 1) - 1 AS position
           FROM pages)"""


@query("html_extract_links", "WITH " + _LINKS_SQL.lstrip("\n, ") + f"""
SELECT page_id, url, CAST(position AS INTEGER) AS position,
  {_dec(_strip("regexp_extract(tag, '>([^<]*)<', 1)"))} AS text,
  regexp_extract(tag, 'href=\"([^\"]*)\"', 1) AS href,
  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || regexp_extract(tag, 'href=\"([^\"]*)\"', 1)
    AS resolved
FROM tags""")
def q_html_extract_links(spark, sf_dir):
    pages = spread(read_table(spark, sf_dir, "pages"))
    links = hx.extract_links(pages, "page_id", "url", "html", "a")
    return hx.required_nonempty(links, "links")


@query("resolve_url", "WITH " + _LINKS_SQL.lstrip("\n, ") + """
SELECT page_id, CAST(position AS INTEGER) AS position,
  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || regexp_extract(tag, 'href="([^"]*)"', 1)
    AS resolved FROM tags""")
def q_resolve_url(spark, sf_dir):
    pages = spread(read_table(spark, sf_dir, "pages"))
    return hx.extract_links(pages, "page_id", "url", "html", "a").select("page_id", "position", "resolved")


@query("page_chain", """
WITH RECURSIVE chain AS (
  SELECT conv_id * 1000 + turn AS start, conv_id * 1000 + turn AS node, 0 AS hop
  FROM conversations WHERE turn = 0
  UNION ALL
  SELECT c.start, n.conv_id * 1000 + n.turn, c.hop + 1 FROM chain c
  JOIN conversations n ON n.conv_id * 1000 + n.turn = c.node + 1 AND n.conv_id = c.node // 1000)
SELECT start, node, CAST(hop AS INTEGER) AS hop FROM chain""")
def q_page_chain(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("page"), "conv_id", "turn")
    nxt = conv.select(F.col("conv_id"), (F.col("turn") - 1).alias("turn"), F.col("page").alias("next_page"))
    edges = conv.join(nxt, ["conv_id", "turn"]).select("page", "next_page")
    starts = conv.filter(F.col("turn") == 0).select("page")
    out = hx.follow_links(edges, starts, "page", "next_page")
    return out.select("start", "node", F.col("hop").cast("int").alias("hop"))


@query("csv_round_trip", "SELECT * FROM customer")
def q_csv_round_trip(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer")
    path = fs.write_csv(cust, scratch_path(spark, "csv-customer"))
    return fs.read_csv(spark, path, cust.schema)


@query("csv_read", an._with("SELECT * FROM passengers"))
def q_csv_read(spark, sf_dir):
    """The passenger table through CSV: its planted nulls are written as empty
    cells and read back as missing values (strings, doubles and booleans)."""
    p = an.passengers(spark, sf_dir)
    path = fs.write_csv(p, scratch_path(spark, "csv-passengers"))
    return fs.read_csv(spark, path, p.schema)


@query("normalise_load", "WITH " + cat.RAW_SQL.strip() + """
SELECT b.book_id, b.title, b.price_gbp, b.price_inr, b.rating, b.in_stock, c.category_name AS category
FROM books b JOIN categories c USING (category_id)""")
def q_normalise_load(spark, sf_dir):
    _, _, _, categories, books = cat.catalog_tables(spark, sf_dir)
    paths = fs.replace_tables({"categories": categories, "books": books}, scratch_path(spark, "catalog"))
    b, c = spark.read.parquet(paths["books"]), spark.read.parquet(paths["categories"])
    from lanthorn.operators.relational import catalog_join_df
    return catalog_join_df(b, c)


@query("run_query_suite", "WITH " + cat.RAW_SQL.strip() + """
SELECT '01_select_where' AS query, count(*) AS rows FROM books WHERE rating = 5 AND in_stock = 1
UNION ALL SELECT '02_order_by_limit', least(count(*), 10) FROM books
UNION ALL SELECT '03_distinct', count(DISTINCT category_name) FROM categories
UNION ALL SELECT '04_between', count(*) FROM books WHERE price_gbp BETWEEN 20 AND 40
UNION ALL SELECT '05_join', count(*) FROM books b JOIN categories c USING (category_id)""")
def q_run_query_suite(spark, sf_dir):
    cat.register_catalog_views(spark, sf_dir)
    out = fs.run_query_suite(spark, cat.STATEMENTS, scratch_path(spark, "suite"))
    return out.select("query", "rows")


@query("sql_read", "WITH " + cat.RAW_SQL.strip() + "\nSELECT * FROM books")
def q_sql_read(spark, sf_dir):
    cat.register_catalog_views(spark, sf_dir)
    return spark.sql("SELECT * FROM books")


@query("quality_gates", "WITH " + cat.RAW_SQL.strip() + """
SELECT 'links not empty' AS rule, CAST(CASE WHEN (SELECT count(*) FROM pages
  WHERE regexp_matches(html, '<a ')) > 0 THEN 0 ELSE 1 END AS BIGINT) AS violations
UNION ALL SELECT 'at least 60 clean rows', CAST(greatest(60 - count(*), 0) AS BIGINT) FROM clean
UNION ALL SELECT 'at least 3 categories', CAST(greatest(3 - count(DISTINCT category), 0) AS BIGINT) FROM clean""")
def q_quality_gates(spark, sf_dir):
    links = hx.extract_links(spread(read_table(spark, sf_dir, "pages")), "page_id", "url", "html", "a")
    clean = cat.catalog_tables(spark, sf_dir)[1]
    return qa.audit([qa.expect_nonempty(links, "links not empty"),
                     qa.expect_min_rows(clean, 60, "at least 60 clean rows"),
                     qa.expect_min_distinct(clean, "category", 3, "at least 3 categories")])
