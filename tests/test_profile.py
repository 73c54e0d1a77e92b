"""Profiling operators against numpy / pandas on small made-up tables."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lanthorn.operators import profile as pr


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 20, 300).astype(float), [np.nan] * 20])
    other = rng.normal(size=320)
    pdf = pd.DataFrame({"a": vals, "b": other})
    df = spark.createDataFrame(pdf).withColumn("a", F.nanvl("a", F.lit(None)))
    got = {(r["column"], r["p"]): r["quantile"] for r in
           pr.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    for col in ("a", "b"):
        x = pdf[col].dropna().to_numpy()
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert abs(got[(col, p)] - np.percentile(x, p * 100)) < 1e-9


def test_quantiles_by_coarse_brackets_and_without_one(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.lognormal(0, 6, 3000), -rng.lognormal(0, 3, 1500), np.repeat(2.5, 700), [1e300, -1e300]])
    g = rng.integers(0, 3, len(x))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x}))
    probs = [0.0, 0.0004, 0.25, 0.5, 0.77, 0.9999, 1.0]
    want = {(k, p): np.percentile(x[g == k], p * 100) for k in range(3) for p in probs}
    # brackets of a coarse sketch; one that never fits its rank; values too many for one window
    for options in ({"sketch": 50}, {"sketch": 10 ** 9}, {"sketch": 50, "bracket": 3}):
        got = {(r["g"], r["p"]): r["quantile"] for r in pr.exact_quantiles(df, ["x"], probs, group="g", **options).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) <= 1e-9 * max(1, abs(want[k])) for k in want)


def test_a_missed_bracket_is_counted_again(spark, monkeypatch):
    monkeypatch.setattr(pr.F, "percentile_approx", lambda col, edges, acc: F.array(*[F.lit(5.0) for _ in edges]))
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    got = {r["p"]: r["quantile"] for r in pr.exact_quantiles(df, ["x"], [0.25, 0.5]).collect()}
    assert got == {0.25: 24.75, 0.5: 49.5}


def test_density_curve_equals_the_sum_of_kernels(spark):
    x = np.random.default_rng(5).normal(size=300).round(2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(4)
    rows = pr.density_curve(df, "x", points=40).orderBy("point").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * bw, x.max() + 3 * bw, 40)
    want = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(axis=1) / (np.sqrt(2 * np.pi) * len(x) * bw)
    assert np.allclose([r["x_value"] for r in rows], grid) and np.allclose([r["density"] for r in rows], want)
    assert pr.density_curve(df.limit(0), "x").count() == 0


def test_grouped_quantiles(spark):
    df = spark.createDataFrame([(g, float(v)) for g in (0, 1) for v in range(g * 10, g * 10 + 11)], "g int, v double")
    got = {r["g"]: r["quantile"] for r in pr.exact_quantiles(df, ["v"], [0.5], group="g").collect()}
    assert got == {0: 5.0, 1: 15.0}


def test_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert pr.modes(df, ["s"]).collect()[0]["mode"] == "a"


def _made_up(spark, n=1000):
    rows = []
    for i in range(n):
        rows.append((i,
                     None if i % 1000 < 49 else float(i),          # 4.9 % -> drop rows
                     None if i % 20 == 0 else float(i % 13),        # 5.0 % -> median
                     None if i % 10 < 3 else ("x" if i % 3 else "y"),  # 30.0 % -> mode
                     None if i % 1000 < 301 else "d",               # 30.1 % -> drop column
                     7))                                            # constant
    return spark.createDataFrame(rows, "id int, a double, b double, c string, d string, k int")


def test_missing_policy_boundaries(spark):
    pol = {r["column"]: r["strategy"] for r in pr.missing_policy(_made_up(spark)).collect()}
    assert pol == {"a": pr.DROP_ROWS, "b": pr.MEDIAN, "c": pr.MODE, "d": pr.DROP_COLUMN}


def test_apply_policy_uses_current_frame(spark):
    df = _made_up(spark)
    out = pr.apply_missing_policy(df)
    assert "d" not in out.columns
    assert out.select([F.count_if(F.col(c).isNull()) for c in out.columns]).collect()[0] == tuple([0] * 5)
    pdf = df.toPandas()
    # order: d (30.1) dropped, c (30.0) mode, b (5.0) median from the full frame, a (4.9) rows dropped
    med_b = pdf["b"].median()
    got_b = out.filter(F.col("id") == 100).collect()[0]["b"]
    assert got_b == med_b
    assert out.count() == 1000 - 49


def test_iqr_and_corr(spark):
    pdf = pd.DataFrame({"x": [1, 2, 3, 4, 100.0], "y": [2, 4, 6, 8, 10.0], "z": [1.0] * 5})
    df = spark.createDataFrame(pdf)
    o = pr.iqr_outliers(df, ["x"]).collect()[0]
    assert (o["q1"], o["q3"], o["outlier_count"]) == (2.0, 4.0, 1)
    m = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in pr.corr_matrix(df, ["x", "y", "z"]).collect()}
    assert abs(m[("x", "y")] - pdf["x"].corr(pdf["y"])) < 1e-12
    assert m[("x", "z")] is None  # constant column: undefined, not an error
    top = pr.top_correlations(df, ["x", "y", "z"], 2).collect()
    assert len(top) == 1 and top[0]["feature_1"] == "x"


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    h = pr.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1]


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=500)], "v double")
    d = pr.density_curve(df, "v", 400).orderBy("point").toPandas()
    assert abs(np.trapezoid(d["density"], d["x_value"]) - 1.0) < 0.01


def test_standardise_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    z = pr.standardise_columns(df, ["v"]).toPandas()["v"]
    assert abs(z.mean()) < 1e-12 and abs(z.std(ddof=0) - 1) < 1e-12
