"""Scalar cleaning functions against the edge values of the catalog fixtures."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from lanthorn.functions import text as tx


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).collect()[0]["r"]


def test_parse_price_edges(spark):
    cases = {"£51.77": 51.77, "Â£51.77": 51.77, "1,234.50": 1.0, "-5.00": 5.0, "free": None, None: None,
             "12": 12.0}
    for raw, want in cases.items():
        assert _one(spark, tx.parse_price, raw) == want, raw


def test_parse_rating_is_exact(spark):
    assert _one(spark, tx.parse_rating, "Three") == 3
    assert _one(spark, tx.parse_rating, "three") is None
    assert _one(spark, tx.parse_rating, None) is None


def test_parse_availability(spark):
    assert _one(spark, tx.parse_availability, " IN STOCK (3) ") is True
    assert _one(spark, tx.parse_availability, "Out of stock, back in stock soon") is False
    assert _one(spark, tx.parse_availability, "soon") is None
    assert _one(spark, tx.parse_availability, None) is None


def test_blank_handles_tabs_and_newlines(spark):
    assert _one(spark, tx.is_blank, " \t\n") is True
    assert _one(spark, tx.is_blank, None) is True
    assert _one(spark, tx.is_blank, " a ") is False


def test_snippet_cuts_then_replaces_then_strips(spark):
    text = "  line one\nline two " + "x" * 300
    got = _one(spark, tx.snippet, text)
    assert got == text[:200].replace("\n", " ").strip()


def test_contains_any_keyword_cases(spark):
    kws = ["delivery", "return", "refund", "membership", "tracking", "cancel", "gift card", "support hours"]
    cases = {"What is the DELIVERY fee?": True, "I am returning shoes": True,
             "my item arrived damaged": False, "gift cards": True, "gift  cards": False, "": False,
             None: False}
    for q, want in cases.items():
        assert _one(spark, lambda c: tx.contains_any(c, kws), q) is want, q


def test_resolve_url_matches_urljoin(spark):
    base = "http://a.example.com/b/c/d.html?q=1#f"
    hrefs = ["/x", "y.html", "../z", "./w", "//other.org/p", "https://abs.org/k", "?n=2", "#g", "../../u"]
    rows = spark.createDataFrame([(base, h) for h in hrefs], "base string, href string") \
        .select("href", tx.resolve_url("base", "href").alias("r")).collect()
    for r in rows:
        assert r["r"] == urljoin(base, r["href"]), r["href"]


def test_format_ids(spark):
    assert _one(spark, tx.format_doc_id, 3, "int") == "doc_03"
    assert _one(spark, tx.format_chunk_id, 12, "int") == "doc_12_chunk_01"


URLS = [("http://h/a/b/c", h) for h in (
    "x", "..", ".", "../..", "../../../x", "./../../q", "/x/../y", "/../../z", "x/./y/../z", "?u=/x/../y", "#f/../g", "x?u=/a/../b#c/../d", "",
    "//other/a", "https://k/a/../b", "a//b", "x/", "../", "../" * 10 + "z", "x?", "mailto:me@h")]
URLS += [("http://h", "q"), ("http://h/", "q/../r"), ("http://h/a/?p=/1/2", "x"), ("http://h/a/b?p#f", ""), ("http://h/a", "./../../q")]


def test_resolve_url_like_urljoin(spark):
    from urllib.parse import urljoin

    df = spark.createDataFrame(URLS, "base string, href string")
    got = [r[0] for r in df.select(tx.resolve_url("base", "href")).collect()]
    assert got == [urljoin(b, h) for b, h in URLS]
