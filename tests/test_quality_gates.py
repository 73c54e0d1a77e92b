"""Quality gates on planted defects: each rule counts exactly the broken rows."""

import pytest

from lanthorn.operators import quality as qa


def _violations(report):
    return {r["rule"]: r["violations"] for r in report.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, 10, 3.0, "a"), (2, 10, None, "b"), (2, 11, 7.5, None), (3, 99, 0.5, "a"), (4, None, 5.0, "z")],
        "id int, parent int, score double, tag string")
    parent = spark.createDataFrame([(10,), (11,), (11,)], "pid int")
    return child, parent


def test_each_rule_counts_its_defects(spark, tables):
    child, parent = tables
    got = _violations(qa.audit([
        qa.expect_unique(child, ["id"], "unique"),
        qa.expect_not_null(child, ["score", "tag"], "not null"),
        qa.expect_between(child, "score", 1, 6, "between"),
        qa.expect_in(child, "tag", ["a", "b"], "in"),
        qa.expect_fk(child, "parent", parent, "pid", "fk"),
        qa.expect_min_rows(child, 7, "min rows"),
        qa.expect_min_distinct(child, "tag", 2, "min distinct"),
        qa.expect_nonempty(child, "nonempty"),
        qa.expect_nonempty(child.filter("id > 100"), "empty"),
    ]))
    # duplicate id 2; nulls in rows 2 and 3; 7.5 and 0.5 out of range (null ignored);
    # 'z' not allowed (null ignored); parent 99 orphaned (null key has no parent either)
    assert got == {"unique": 1, "not null": 2, "between": 2, "in": 1, "fk": 2, "min rows": 2,
                   "min distinct": 0, "nonempty": 0, "empty": 1}


def test_enforce_raises_on_violations(spark, tables):
    child, _ = tables
    with pytest.raises(qa.QualityError, match="unique: 1"):
        qa.enforce(qa.expect_unique(child, ["id"], "unique"))
    qa.enforce(qa.expect_min_rows(child, 5, "enough rows"))


def test_driver_gate_entries_report_known_defects(spark):
    from conftest import SF_SMALL
    from lanthorn.plans import load_all
    from lanthorn.plans.registry import QUERIES

    load_all()
    unique = _violations(QUERIES["expect_unique"](spark, SF_SMALL))
    assert unique["books.book_id unique"] == 0 and unique["customer.c_custkey unique"] == 0
    assert unique["lineitem (l_orderkey, l_linenumber) unique"] > 0
    nulls = _violations(QUERIES["expect_not_null"](spark, SF_SMALL))
    assert nulls["passengers key and target not null"] == 0
    assert 0 < nulls["passengers age not null"] <= nulls["passengers age or embarked not null"]
