"""Distributed ordinals and running sums against single-machine brute force."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanthorn.operators.ordinal import global_ordinal, rank_within, running_sums
from lanthorn.session import read_table

from conftest import SF_SMALL


def test_global_ordinal_equals_row_number(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    got = global_ordinal(li, order, "ord", partitions=7).select(*order, "ord")
    want = li.select(*order, F.row_number().over(Window.orderBy(*order)).alias("ord"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ordinal_consistent_under_pruning_and_filters(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    o = global_ordinal(li, order, "ord", partitions=5)
    n = li.count()
    assert o.filter(F.col("ord") <= 10).count() == 10
    assert o.select("ord").distinct().count() == n
    assert o.agg(F.max("ord")).collect()[0][0] == n


def test_rank_within_a_hot_group(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
                                  .alias("g"), F.col("id"))
    got = rank_within(df, ["g"], ["id"], "r", partitions=6)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert got.select("g", "id", "r").exceptAll(want).count() == 0


def test_running_sums_match_cumsum(spark):
    pdf_vals = np.arange(1, 501)
    df = spark.createDataFrame([(int(i), float(i % 7)) for i in pdf_vals], "k long, v double")
    got = running_sums(df, ["k"], {"cum": "v"}, ordinal="pos", partitions=4).orderBy("k").toPandas()
    assert np.allclose(got["cum"], np.cumsum(pdf_vals % 7))
    assert list(got["pos"]) == list(range(1, 501))


def test_descending_order(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("k"))
    got = global_ordinal(df, [F.col("k").desc()], "pos", partitions=3).orderBy("pos").collect()
    assert [r["k"] for r in got] == sorted(range(100), reverse=True)
