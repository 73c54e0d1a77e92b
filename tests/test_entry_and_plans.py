"""Driver contract, a few oracles at the smallest scale, and plan shapes."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lanthorn.functions import text as tx
from lanthorn.operators import relational as rel
from lanthorn.session import TABLES, read_table
from tools.check_oracle import rows_of

from conftest import SF_SMALL

CHEAP = ["parse_price", "clean_rows", "sql_05_join", "missing_report", "describe_numeric",
         "stratified_split", "roc_auc", "knn_top3", "validate_response", "html_extract_links"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "category" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 130


@pytest.mark.parametrize("name", CHEAP)
def test_oracle_at_smallest_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert rows_of(got) == rows_of(want)  # names and values, in any order


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    assert "TakeOrderedAndProject" in _plan(rel.top_k(li, 10, [F.col("l_extendedprice").desc()]))


def test_cleaning_plans_have_no_python(spark):
    raw = read_table(spark, SF_SMALL, "part").select(F.col("p_name").alias("t"))
    df = raw.select(tx.parse_price("t"), tx.parse_rating("t"), tx.parse_availability("t"), tx.is_blank("t"),
                    tx.snippet("t"))
    plan = _plan(df)
    assert "Python" not in plan and "ArrowEval" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    li = read_table(spark, SF_SMALL, "lineitem").filter(F.col("l_quantity") > 10).select("l_orderkey")
    plan = li._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_spread_only_touches_narrow_frames(spark):
    from lanthorn.session import spread

    slots = spark.sparkContext.defaultParallelism
    narrow = spark.range(1000).coalesce(1)
    spread_out = spread(narrow)
    assert spread_out.rdd.getNumPartitions() == slots
    assert sorted(r.id for r in spread_out.collect()) == list(range(1000))
    wide = spark.range(0, 1000, 1, slots + 2)
    assert spread(wide) is wide


def test_corr_matrix_aggregates_once(spark):
    from lanthorn.operators import profile as pr

    li = read_table(spark, SF_SMALL, "lineitem")
    m = pr.corr_matrix(li, ["l_quantity", "l_discount", "l_tax"])
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Union" not in plan
    rows = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in m.collect()}
    assert len(rows) == 9 and rows[("l_tax", "l_quantity")] == rows[("l_quantity", "l_tax")]
    assert abs(rows[("l_discount", "l_discount")] - 1.0) < 1e-9
