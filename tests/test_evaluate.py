"""Metric arithmetic: published confusion tables and brute-force AUC."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanthorn.operators import evaluate as ev

# (tp, fp, fn, tn) -> (accuracy, precision, recall, f1) as published, 4 decimals
PUBLISHED = [
    ((46, 12, 23, 98), (0.8045, 0.7931, 0.6667, 0.7244)),
    ((40, 13, 29, 97), (0.7654, 0.7547, 0.5797, 0.6557)),
    ((48, 12, 21, 98), (0.8156, 0.8000, 0.6957, 0.7442)),
    ((54, 20, 15, 90), (None, 0.7297, 0.7826, 0.7552)),
    ((54, 19, 15, 91), (None, 0.7397, 0.7826, 0.7606)),
]


def _frame(spark, tp, fp, fn, tn):
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn + [(0, 0)] * tn
    return spark.createDataFrame(rows, "y int, p int")


@pytest.mark.parametrize("counts,want", PUBLISHED)
def test_published_metrics(spark, counts, want):
    m = ev.classification_metrics(_frame(spark, *counts), "y", "p").collect()[0]
    for name, w in zip(("accuracy", "precision", "recall", "f1"), want):
        if w is not None:
            assert round(m[name], 4) == w, name


def test_zero_division_gives_zero(spark):
    m = ev.classification_metrics(_frame(spark, 0, 0, 10, 5), "y", "p").collect()[0]
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_auc_matches_pairwise_with_ties(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + y * 0.3, 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)])
    assert abs(ev.roc_auc(df, "y", "s").collect()[0]["auc"] - brute) < 1e-12
    curve = ev.roc_curve(df, "y", "s").orderBy("step").toPandas()
    assert curve.iloc[0][["fpr", "tpr"]].tolist() == [0.0, 0.0]
    assert curve.iloc[-1][["fpr", "tpr"]].tolist() == [1.0, 1.0]
    assert abs(np.trapezoid(curve["tpr"], curve["fpr"]) - brute) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    assert ev.roc_auc(df, "y", "s").collect()[0]["auc"] is None


def test_adjusted_r2(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(size=179)
    yh = y + rng.normal(size=179)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, yh)], "y double, yh double")
    m = ev.regression_metrics(df, "y", "yh", 10).collect()[0]
    r2 = 1 - np.sum((y - yh) ** 2) / np.sum((y - y.mean()) ** 2)
    assert abs(m["r2"] - r2) < 1e-12
    assert abs(m["adjusted_r2"] - (1 - (1 - r2) * 178 / 168)) < 1e-12
    assert abs(1 - (1 - 0.3975) * 178 / 168 - 0.3616) < 1e-4


def test_confusion_matrix_has_every_cell(spark):
    cm = ev.confusion_matrix(_frame(spark, 3, 0, 2, 0), "y", "p").collect()
    assert {(r["label"], r["predicted"]): r["count"] for r in cm} == {(0, 0): 0, (0, 1): 0, (1, 0): 2, (1, 1): 3}
