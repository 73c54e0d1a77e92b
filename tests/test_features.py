"""Splits, class weights and SMOTE."""

import numpy as np
from pyspark.sql import functions as F

from lanthorn.operators import features as fe


def _labels(spark, n0=549, n1=342):
    return spark.createDataFrame([(i, 0) for i in range(n0)] + [(n0 + i, 1) for i in range(n1)],
                                 "id long, y int")


def test_stratified_split_sizes(spark):
    s = fe.stratified_split(_labels(spark), "y", "id")
    counts = {(r["split"], r["y"]): r["count"] for r in s.groupBy("split", "y").count().collect()}
    assert counts[("test", 0)] + counts[("test", 1)] == 179
    assert (counts[("test", 0)], counts[("test", 1)]) == (110, 69)
    assert s.select("id").distinct().count() == 891


def test_nth_by_digits_equals_sorting(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("grp"), F.struct(
        F.md5((F.col("id") % 900).cast("string")).alias("h"), F.col("id").alias("k")).alias("p"))
    rows = {}
    for r in df.collect():
        rows.setdefault(r["grp"], []).append(tuple(r["p"]))
    wanted = spark.createDataFrame([(0, 1), (1, 1000), (2, 0)], "grp bigint, n bigint")
    for options in ({}, {"digits": 1, "ordered": 30}, {"digits": 11, "ordered": 0}):  # the last: all digits used up, ties by key
        got = {r["grp"]: tuple(r["last"]) for r in fe.nth_by_digits(df, wanted, **options).collect()}
        assert got == {0: sorted(rows[0])[0], 1: sorted(rows[1])[999]}


def test_random_split_takes_the_first_by_digest(spark):
    s = fe.random_split(_labels(spark), "id")
    order = sorted(range(891), key=lambda i: (__import__("hashlib").md5(str(i).encode()).hexdigest(), i))
    assert {r["id"] for r in s.where("split = 'test'").collect()} == set(order[:179])


def test_split_is_deterministic(spark):
    a = fe.stratified_split(_labels(spark), "y", "id").filter("split = 'test'").select("id")
    b = fe.stratified_split(_labels(spark).repartition(5), "y", "id").filter("split = 'test'").select("id")
    assert a.exceptAll(b).count() == 0


def test_class_weights_sum_to_n(spark):
    w = fe.class_weights(_labels(spark), "y").collect()
    assert abs(sum(r["weight"] * r["n_class"] for r in w) - 891) < 1e-9


def test_smote_balances_and_stays_on_segments(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 0, [float(x) for x in rng.normal(size=3)]) for i in range(60)] + \
           [(100 + i, 1, [float(x) for x in rng.normal(size=3) + 3]) for i in range(15)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    synth = fe.smote(df, "y", "id", "v", minority=1, k=5)
    out = synth.toPandas()
    assert len(out) == 45
    mins = {r[0]: np.array(r[2]) for r in rows if r[1] == 1}
    for _, r in out.iterrows():
        a = mins[r["parent"]]
        v = np.array(r["v"])
        # v = a + u (b - a) for some minority b and u in [0, 1)
        ok = False
        for b in mins.values():
            d = b - a
            if np.allclose(d, 0):
                continue
            u = np.dot(v - a, d) / np.dot(d, d)
            if -1e-9 <= u < 1 and np.allclose(a + u * d, v, atol=1e-9):
                ok = True
        assert ok


def test_one_hot_unseen_is_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    rows = fe.one_hot(train, test, "c").orderBy(F.col("c").asc_nulls_last()).collect()
    assert [(r["c_a"], r["c_b"]) for r in rows] == [(0, 1), (0, 0), (0, 0)]
