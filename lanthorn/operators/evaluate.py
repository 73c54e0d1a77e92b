"""Exact evaluation metrics as aggregates (no sampling, no binning)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanthorn.operators.ordinal import running_sums


def _safe_div(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (the zero_division=0 rule)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    """TP, FP, FN, TN in one aggregate."""
    y = F.col(label) == positive
    p = F.col(prediction) == positive
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1 of the positive class from TP/FP/FN/TN."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return counts.select(
        "tp", "fp", "fn", "tn",
        _safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def classification_metrics(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    return metrics_from_counts(confusion_counts(df, label, prediction, positive))


def confusion_matrix(df: DataFrame, label: str, prediction: str,
                     classes: Sequence = (0, 1)) -> DataFrame:
    """label x prediction counts; every cell of ``classes`` x ``classes`` present."""
    cells = [F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"{i}_{j}")
             for i, a in enumerate(classes) for j, b in enumerate(classes)]
    wide = df.agg(*cells)
    long = wide.unpivot([], wide.columns, "cell", "count")
    idx = F.split("cell", "_")
    vals = F.array(*[F.lit(c) for c in classes])
    return long.select(F.element_at(vals, idx[0].cast("int") + 1).alias("label"),
                       F.element_at(vals, idx[1].cast("int") + 1).alias("predicted"), "count")


def _score_table(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Positives and negatives per distinct score (map-side combined)."""
    y = F.col(label) == positive
    return (df.where(F.col(score).isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def roc_curve(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, descending, plus (0, 0).

    Ties share one point.  Intermediate collinear points are kept (the
    full curve); the area is the same either way.
    """
    per = _score_table(df, label, score, positive)
    cum = running_sums(per, [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, ordinal="step")
    totals = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).collect()[0]
    P, N = totals["P"] or 0, totals["N"] or 0
    pts = cum.select(F.col("step").cast("long").alias("step"), F.col("score").alias("threshold"),
                     _safe_div(F.col("fp"), F.lit(N)).alias("fpr"),
                     _safe_div(F.col("tp"), F.lit(P)).alias("tpr"))
    origin = per.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("step"), F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def roc_auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Trapezoid area under the ROC curve; tied scores count half.

    For the distinct score s with p positives and n negatives, the step
    adds n * (TP before s + p / 2); the sum over P * N is the area.  Null
    when only one class is present.
    """
    per = _score_table(df, label, score, positive)
    cum = running_sums(per, [F.col("score").desc()], {"tp": "pos"})
    part = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0)
    return cum.agg(F.sum(part).alias("area"), F.sum("pos").alias("P"), F.sum("neg").alias("N")) \
        .select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                       F.col("area") / (F.col("P").cast("double") * F.col("N"))).alias("auc"))


def regression_metrics(df: DataFrame, label: str, prediction: str, n_features: int) -> DataFrame:
    """MAE, RMSE, R^2 and adjusted R^2 = 1 - (1 - R^2)(n - 1)/(n - p - 1)."""
    y, yh = F.col(label).cast("double"), F.col(prediction).cast("double")
    mean_y = df.agg(F.avg(y).alias("m")).collect()[0]["m"]
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - yh)).alias("mae"),
                 F.avg((y - yh) * (y - yh)).alias("mse"),
                 F.sum((y - yh) * (y - yh)).alias("ss_res"),
                 F.sum((y - F.lit(mean_y)) * (y - F.lit(mean_y))).alias("ss_tot"))
    r2 = F.when(F.col("ss_tot") > 0, 1 - F.col("ss_res") / F.col("ss_tot"))
    dof = F.col("n") - n_features - 1
    adj = F.when(dof > 0, 1 - (1 - r2) * (F.col("n") - 1) / dof)
    return agg.select("n", "mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"),
                      adj.alias("adjusted_r2"))


def residuals(df: DataFrame, label: str, prediction: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(prediction).alias("predicted"),
                     (F.col(label) - F.col(prediction)).alias("residual"))


def residual_spread(df: DataFrame, label: str, prediction: str, bins: int = 10) -> DataFrame:
    """Residual mean and spread per equal-width bin of the prediction."""
    st = df.agg(F.min(prediction).alias("lo"), F.max(prediction).alias("hi")).collect()[0]
    width = (st["hi"] - st["lo"]) / bins if st["hi"] is not None and st["hi"] > st["lo"] else 1.0
    b = F.least(F.floor((F.col(prediction) - F.lit(st["lo"])) / F.lit(width)).cast("int"),
                F.lit(bins - 1))
    r = F.col(label) - F.col(prediction)
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(r).alias("mean_residual"),
                                          F.stddev_samp(r).alias("std_residual"))
