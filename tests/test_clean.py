"""Cleaning and quarantine properties with planted defects."""

from pyspark.sql import functions as F

from lanthorn.operators import clean as cl
from lanthorn.operators import quality as qa
from lanthorn.plans.catalog import catalog_raw

from conftest import SF_SMALL

SCHEMA = "title string, price string, star_rating string, availability string, category string"


def test_clean_plus_dropped_is_input(spark):
    raw = catalog_raw(spark, SF_SMALL)
    clean, dropped = cl.split_clean(raw)
    assert clean.count() + dropped.count() == raw.count()
    assert dropped.filter(F.col("reasons") == "").count() == 0


def test_planted_defects_are_dropped(spark):
    raw = spark.createDataFrame([
        ("A & B", "£47.82", "Four", " In stock ", "Mystery"),
        (" \t\n", "£1.00", "One", "In stock", "Mystery"),
        ("C", "free", "One", "In stock", "Mystery"),
        ("D", "£2.00", "four", "In stock", "Mystery"),
        ("E", "£3.00", "Two", "soon", "Mystery"),
        ("F", "£3.00", "Two", "In stock", " "),
    ], SCHEMA)
    clean, dropped = cl.split_clean(raw)
    assert [r["title"] for r in clean.collect()] == ["A & B"]
    reasons = {r["title"]: r["reasons"] for r in dropped.collect()}
    assert reasons == {" \t\n": "blank_title", "C": "no_price", "D": "no_rating", "E": "no_availability",
                       "F": "blank_category"}
    row = clean.collect()[0]
    assert row["price_inr"] == 47.82 * 105.5 and row["in_stock"] is True and row["rating"] == 4


def test_constraint_audit_finds_violations(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 7, 0), (2, None, 3)], "id int, rating int, flag int")
    parent = spark.createDataFrame([(1,)], "id int")
    report = {r["rule"]: r["violations"] for r in qa.audit([
        qa.expect_unique(df, ["id"], "unique"),
        qa.expect_not_null(df, ["rating"], "not null"),
        qa.expect_between(df, "rating", 1, 5, "between"),
        qa.expect_in(df, "flag", [0, 1], "in"),
        qa.expect_fk(df, "id", parent, "id", "fk"),
        qa.expect_min_rows(df, 60, "min rows"),
        qa.expect_nonempty(df.limit(0), "nonempty"),
    ]).collect()}
    assert report == {"unique": 1, "not null": 1, "between": 1, "in": 1, "fk": 1, "min rows": 57,
                      "nonempty": 1}
