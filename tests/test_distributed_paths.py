"""Ordinals, ranks and running sums on the one range-partitioned path, and what its plans must not hold."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanthorn.operators import evaluate as ev
from lanthorn.operators import features as fe
from lanthorn.operators import profile as pr
from lanthorn.operators.ordinal import global_ordinal, rank_within, running_sums


def test_ordinal_and_ranks(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"),
                                  F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("g"))
    got = global_ordinal(df, ["k"], "o").select("k", "o")
    assert got.filter(F.col("o") != F.col("k") + 1).count() == 0
    r = rank_within(df, ["g"], ["k"], "r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert r.select("g", "k", "r").exceptAll(want.select("g", "k", "r")).count() == 0


def test_running_sums(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("v"))
    got = running_sums(df, ["k"], {"c": "v"}, ordinal="pos").orderBy("k").toPandas()
    assert np.allclose(got["c"], np.cumsum(np.arange(3000) % 5)) and list(got["pos"]) == list(range(1, 3001))


def test_quantiles_split_and_auc(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, 2000).astype(float)
    y = rng.integers(0, 2, 2000)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(2000), "x": x, "y": y}))
    q = {r["p"]: r["quantile"] for r in pr.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    for p, v in q.items():
        assert abs(v - np.percentile(x, p * 100)) < 1e-9
    s = fe.stratified_split(df, "y", "id")
    n_test = s.filter("split = 'test'").count()
    assert n_test == 400
    auc = ev.roc_auc(df, "y", "x").collect()[0]["auc"]
    pos, neg = x[y == 1], x[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]


def test_no_single_partition_over_data_rows(spark):
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), F.lit(1.0).alias("v"))
    for out in (global_ordinal(df, ["k"], "o"), running_sums(df, ["k"], {"c": "v"}), rank_within(df, ["g"], ["k"], "r")):
        # a one-partition exchange takes the offsets only, a row per range partition, right after their aggregation
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
        after = [b for a, b in zip(lines, lines[1:]) if "SinglePartition" in a]
        assert all("HashAggregate(keys=[__pid" in x for x in after)
        assert not [x for x in _exchanges(out) if "rangepartitioning" in x]


def test_rows_are_not_hashed_on_a_label(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(900), "x": rng.normal(size=900), "y": rng.integers(0, 2, 900)}))
    for out in (fe.stratified_split(df, "y", "id"), fe.with_class_weight(df, "y")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
