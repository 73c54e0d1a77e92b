"""The five catalog statements on the published 69-row join (golden fixture).

The rows are fixed values kept in ``tests/fixtures/catalog_join_golden.tsv``.
"""

import pytest
from pyspark.sql import functions as F

from lanthorn.operators import clean as cl
from lanthorn.operators import relational as rel
from lanthorn.plans.catalog import STATEMENTS

from conftest import GOLDEN_JOIN


@pytest.fixture(scope="module")
def golden(spark):
    lines = open(GOLDEN_JOIN, encoding="utf-8").read().splitlines()
    rows = [tuple(line.split("\t")) for line in lines if line and not line.startswith("#")]
    assert len(rows) == 69
    cats = sorted({r[6] for r in rows})
    cat_id = {c: i + 1 for i, c in enumerate(cats)}
    books = spark.createDataFrame(
        [(int(r[0]), r[1], float(r[2]), float(r[3]), int(r[4]), int(r[5]), cat_id[r[6]]) for r in rows],
        "book_id int, title string, price_gbp double, price_inr double, rating int, in_stock int, "
        "category_id int")
    categories = spark.createDataFrame([(i, c) for c, i in cat_id.items()], "category_id int, category_name string")
    books.createOrReplaceTempView("books")
    categories.createOrReplaceTempView("categories")
    return rows, books, categories


def test_select_where(spark, golden):
    assert spark.sql(STATEMENTS["01_select_where"]).count() == 14


def test_order_by_limit(spark, golden):
    got = [r["price_gbp"] for r in spark.sql(STATEMENTS["02_order_by_limit"]).collect()]
    assert len(got) == 10 and got[0] == 59.48 and got[-1] == 53.74


def test_distinct(spark, golden):
    got = [r["category"] for r in spark.sql(STATEMENTS["03_distinct"]).collect()]
    assert got == ["Historical Fiction", "Mystery", "Travel"]


def test_between(spark, golden):
    assert spark.sql(STATEMENTS["04_between"]).count() == 33


def test_join_order_and_values(spark, golden):
    rows, books, categories = golden
    got = spark.sql(STATEMENTS["05_join"]).collect()
    assert [r["book_id"] for r in got] == [int(r[0]) for r in rows]
    assert all(abs(r["price_inr"] - r["price_gbp"] * 105.5) < 1e-9 for r in got)


def test_sql_and_frame_join_are_equal(spark, golden):
    _, books, categories = golden
    eq = rel.frames_equal(spark.sql(STATEMENTS["05_join"]), rel.catalog_join_df(books, categories),
                          order=rel.join_order()).collect()[0]
    assert eq["equal"] and eq["left_rows"] == 69


def test_quota_prefix_stops_at_third_category(spark, golden):
    rows, _, _ = golden
    words = {1: "One", 2: "Two", 3: "Three", 4: "Four", 5: "Five"}
    # listing order: Travel 1-11, Mystery 12-43, Historical Fiction 44-69
    order = {"Travel": 0, "Mystery": 1, "Historical Fiction": 2}
    ranked = sorted(rows, key=lambda r: (order[r[6]], int(r[0])))
    raw = spark.createDataFrame(
        [(i, r[1], "£" + r[2], words[int(r[4])], "In stock", r[6]) for i, r in enumerate(ranked)],
        "ordinal int, title string, price string, star_rating string, availability string, category string")
    assert cl.quota_prefix(raw, "category", "ordinal", 60, 3).count() == 69
    assert cl.quota_prefix(raw, "category", "ordinal", 40, 2).count() == 43
    with pytest.raises(ValueError, match="never 70 clean rows"):
        cl.quota_prefix(raw, "category", "ordinal", 70, 3)


def test_frames_equal_by_sums_and_row_by_row(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, 0.5), (2, None, 0.5)], "i int, s string, f double")
    same = a.orderBy("i", ascending=False).repartition(3)
    assert tuple(rel.frames_equal(a, same, order=[a["i"]]).first()) == (True, 3, 3, 0, 0)
    assert tuple(rel.frames_equal(a.limit(0), a.limit(0)).first()) == (True, 0, 0, 0, 0)
    fewer = a.dropDuplicates()
    assert tuple(rel.frames_equal(a, fewer).first()) == (False, 3, 2, 1, 0)
    swapped = spark.createDataFrame([(1, None, None), (2, "x", 0.5), (2, None, 0.5)], "i int, s string, f double")
    assert tuple(rel.frames_equal(a, swapped).first()) == (False, 3, 3, 2, 2)
    # a null moved to another column
    left = spark.createDataFrame([("x", None)], "s string, t string")
    right = spark.createDataFrame([(None, "x")], "s string, t string")
    assert rel.bag_sums(left) != rel.bag_sums(right) and rel.frames_equal(left, right).first()["equal"] is False
