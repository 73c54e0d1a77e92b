"""Profiling: shape, missing values, exact quantiles, outliers, correlations.

All per-column statistics are computed for every column in one pass: the
frame is unpivoted to (column, value) and aggregated by column.  Exact
quantiles avoid ``percentile``'s single-task value map on a global
aggregate: values are counted per (column, value) with map-side combine,
running counts along (column, value) come from the distributed
``running_sums``, and the ranks a quantile needs are looked up with a
join with the (columns x probabilities) targets - a table the size of the
report.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanthorn.operators.ordinal import running_sums
from lanthorn.session import small_side

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def is_numeric(dt: T.DataType, bool_numeric: bool = False) -> bool:
    return isinstance(dt, NUMERIC) or (bool_numeric and isinstance(dt, T.BooleanType))


def numeric_columns(df: DataFrame, bool_numeric: bool = False) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType, bool_numeric)]


def scalars(one_row: DataFrame) -> dict:
    """Collect a global aggregate (exactly one row) as learned parameters."""
    return one_row.collect()[0].asDict()


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "non_null")
    types = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    meta = df.sparkSession.createDataFrame(types, "position int, column string, dtype string")
    return meta.join(long, "column").select("position", "column", "dtype", "non_null")


def to_long(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """(id..., column, value) with value as double."""
    return df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(list(id_cols), list(cols), "column", "value")


def missing_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """% null per column, long form, sorted descending (one pass)."""
    n = F.count(F.lit(1)).cast("double")
    wide = df.agg(*[(F.count_if(F.col(f"`{c}`").isNull()).cast("double") * 100.0 / n).alias(c)
                    for c in df.columns])
    long = wide.unpivot([], df.columns, "column", "missing_percentage")
    if only_missing:
        long = long.filter(F.col("missing_percentage") > 0)
    return long.orderBy(F.col("missing_percentage").desc(), "column")


# Fixed output values: the policy sentences of the missing-value report.
DROP_ROWS = "Drop rows containing missing values"
MEDIAN = "Impute using median"
MODE = "Impute using mode"
DROP_COLUMN = "Drop column because missingness is too high for reliable imputation"


def missing_policy(df: DataFrame, low: float = 5.0, high: float = 30.0) -> DataFrame:
    """Strategy per column: < low drop rows; low..high impute; > high drop column."""
    report = missing_report(df)
    types = [(f.name, is_numeric(f.dataType, bool_numeric=True)) for f in df.schema.fields]
    meta = df.sparkSession.createDataFrame(types, "column string, is_numeric boolean")
    pct = F.col("missing_percentage")
    strategy = (F.when(pct < low, F.lit(DROP_ROWS))
                .when((pct <= high) & F.col("is_numeric"), F.lit(MEDIAN))
                .when(pct <= high, F.lit(MODE))
                .otherwise(F.lit(DROP_COLUMN)))
    return report.join(F.broadcast(meta), "column").select("column", "missing_percentage",
                                                           strategy.alias("strategy"))


def apply_missing_policy(df: DataFrame, low: float = 5.0, high: float = 30.0) -> DataFrame:
    """Apply the policy column by column in descending missing share.

    Shares come from the original frame; medians and modes from the frame
    as it is when the column's turn comes (columns and rows dropped by
    earlier steps are gone).  The driver only sees one row per column.
    """
    plan = [(r["column"], r["strategy"]) for r in
            missing_policy(df, low, high).orderBy(F.col("missing_percentage").desc(), "column")
            .collect()]
    current = df
    for col, strategy in plan:
        if strategy == DROP_ROWS:
            current = current.dropna(subset=[col])
        elif strategy == DROP_COLUMN:
            current = current.drop(col)
        elif strategy == MEDIAN:
            med = exact_quantiles(current, [col], [0.5]).collect()
            value = med[0]["quantile"] if med else None
            current = current.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(
                current.schema[col].dataType)))
        else:
            mode_rows = modes(current, [col]).collect()
            value = mode_rows[0]["mode"] if mode_rows else None
            current = current.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return current


#: of a quantile sketch: ranks are off by at most n / SKETCH
SKETCH = 10_000
#: distinct values between two brackets that one window may order
BRACKET = 1 << 20


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group: str | None = None,
                    sketch: int = SKETCH, bracket: int = BRACKET) -> DataFrame:
    """Linear-interpolation quantiles (like ``percentile``/``quantile_cont``).

    Output: (group?, column, p, quantile).  Nulls are ignored.  Nothing is
    sorted: a mergeable quantile sketch brackets each wanted rank between two
    values, one more pass counts the rows below the lower one and the distinct values
    between, a small share of all, and the wanted values are read off those.  A rank
    that its bracket should miss is counted without one.  The values are written once
    (checkpoint), so the input plan runs once.
    """
    ids = [group] if group else []
    keys = [*ids, "column"]
    long = to_long(df, cols, ids).filter(F.col("value").isNotNull()).select(*keys, "value").checkpoint(eager=True)
    wanted = [float(p) for p in probs]
    edges = [min(max(p + d * 2.0 / sketch, 0.0), 1.0) for p in wanted for d in (-1, 1)]
    marks = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", edges, sketch).alias("marks"),
                                    F.min("value").alias("least"), F.max("value").alias("most"))
    per_p = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(i).alias("i")) for i, p in enumerate(wanted)]))
    h = (F.col("n") - 1) * F.col("w.p")
    # the outermost edges are the extremes themselves, whatever the sketch says
    targets = marks.withColumn("w", per_p).select(
        *keys, F.col("w.p").alias("p"), F.floor(h).cast("long").alias("lo"), F.ceil(h).cast("long").alias("hi"), (h - F.floor(h)).alias("frac"),
        F.when(F.col("w.p") <= 2.0 / sketch, F.col("least")).otherwise(F.element_at("marks", F.col("w.i") * 2 + 1)).alias("a"),
        F.when(F.col("w.p") >= 1 - 2.0 / sketch, F.col("most")).otherwise(F.element_at("marks", F.col("w.i") * 2 + 2)).alias("b"))
    targets = targets.checkpoint(eager=True)

    def counted(targets):
        """Rows per (target, value) of each bracket; value null: the rows below it."""
        rows = long.join(small_side(targets), keys).where(F.col("value") <= F.col("b"))
        inside = F.when(F.col("value") >= F.col("a"), F.col("value"))
        return rows.groupBy(*keys, "p", "lo", "hi", "frac", inside.alias("v")).agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)

    counts = counted(targets)
    below = F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0))
    state = counts.groupBy(*keys, "p", "lo", "hi").agg(below.alias("below"), F.sum("c").alias("upto"), F.count("v").alias("values"))
    missed = (F.col("below") > F.col("lo")) | (F.col("upto") <= F.col("hi"))
    checked = state.agg(F.count_if(missed).alias("missed"), F.max("values").alias("values")).first()
    if checked["missed"]:
        again = targets.join(state.where(missed).select(*keys, "p"), [*keys, "p"], "left_semi")
        again = again.withColumn("a", F.lit(float("-inf"))).withColumn("b", F.lit(float("nan")))  # NaN is the largest value
        kept = counts.join(state.where(missed).select(*keys, "p"), [*keys, "p"], "left_anti")
        counts = kept.unionByName(counted(again)).checkpoint(eager=True)
    if checked["missed"] or (checked["values"] or 0) > bracket:
        order = [*keys, "p", F.asc_nulls_first("v")]
        cum = running_sums(counts, order, {"upto": "c"}, stored=True)
        start = counts.groupBy(*keys, "p").agg(F.sum("c").alias("all"))
        start = running_sums(start, [*keys, "p"], {"end": "all"}).select(*keys, "p", (F.col("end") - F.col("all")).alias("start"))
        cum = cum.join(small_side(start), [*keys, "p"]).withColumn("upto", F.col("upto") - F.col("start"))
    else:
        w = Window.partitionBy(*keys, "p").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = counts.withColumn("upto", F.sum("c").over(w))
    covers = lambda r: (F.col(r) >= F.col("upto") - F.col("c")) & (F.col(r) < F.col("upto"))
    out = cum.where(F.col("v").isNotNull()).where(covers("lo") | covers("hi")).groupBy(*keys, "p").agg(
        F.max(F.when(covers("lo"), F.col("v"))).alias("v_lo"), F.max(F.when(covers("hi"), F.col("v"))).alias("v_hi"),
        F.first("frac").alias("frac"))
    return out.select(*keys, "p", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")).alias("quantile"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value per column; ties go to the smallest value.

    Values are compared as strings for text columns and as doubles for
    numeric ones; the result keeps the column's own type as text.
    """
    parts = []
    for c in cols:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        # min_by over (-n, value): the largest count, then the smallest value
        best = counts.agg(F.min_by(F.col(c), F.struct((-F.col("n")).alias("k"), F.col(c)))
                          .alias("mode"), F.max("n").alias("count"))
        parts.append(best.select(F.lit(c).alias("column"), F.col("mode").cast("string").alias("mode"),
                                 "count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (interpolated), max per column."""
    cols = list(cols or numeric_columns(df))
    long = to_long(df, cols)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").pivot(
        "p", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    q = q.toDF("column", "p25", "p50", "p75")
    return moments.join(q, "column", "left").select("column", "count", "mean", "std", "min",
                                                    "p25", "p50", "p75", "max")


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Q1, Q3, IQR, fences and the count strictly outside, per column."""
    q = exact_quantiles(df, cols, [0.25, 0.75]).groupBy("column").pivot("p", [0.25, 0.75]) \
        .agg(F.first("quantile")).toDF("column", "q1", "q3")
    fences = q.select("column", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr")) \
        .withColumn("lower_bound", F.col("q1") - k * F.col("iqr")) \
        .withColumn("upper_bound", F.col("q3") + k * F.col("iqr"))
    long = to_long(df, cols)
    # fences: one row per column, a bounded broadcast.  The fence columns
    # ride through the aggregate (constant per column), so the quantile
    # plan is read once, not once more for a join back.
    flagged = long.join(F.broadcast(fences), "column")
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    fence_cols = ["q1", "q3", "iqr", "lower_bound", "upper_bound"]
    return flagged.groupBy("column").agg(
        *[F.max(c).alias(c) for c in fence_cols],
        F.count_if(F.coalesce(outside, F.lit(False))).alias("outlier_count"))


def skew_by_order(df: DataFrame, col: str) -> DataFrame:
    """mean > median > mode: right-skewed; mean < median < mode: left-skewed."""
    mean = df.agg(F.avg(col).alias("mean"))
    med = exact_quantiles(df, [col], [0.5]).select("column", F.col("quantile").alias("median"))
    mode = modes(df, [col]).select("column", F.col("mode").cast("double").alias("mode"))
    row = mean.withColumn("column", F.lit(col)).join(med, "column").join(mode, "column")
    # fixed output values: the three distribution labels
    label = (F.when((F.col("mean") > F.col("median")) & (F.col("median") > F.col("mode")),
                    F.lit("right-skewed"))
             .when((F.col("mean") < F.col("median")) & (F.col("median") < F.col("mode")),
                   F.lit("left-skewed"))
             .otherwise(F.lit("not clearly classified by strict mean/median/mode ordering")))
    return row.select("column", "mean", "median", "mode", label.alias("distribution"))


def group_rate(df: DataFrame, keys: Sequence[str], target: str, name: str = "rate") -> DataFrame:
    """Mean of a 0/1 target per group, sorted by the keys (one shuffle)."""
    return (df.where(F.col(target).isNotNull())
            .groupBy(*keys).agg(F.avg(F.col(target).cast("double")).alias(name),
                                F.count(F.lit(1)).alias("n"))
            .orderBy(*keys))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and % per value, sorted by value (total via a window over classes)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = scalars(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    return counts.withColumn("percentage", F.col("count").cast("double") * 100.0 / F.lit(total)) \
        .orderBy(col)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair (i, j), one aggregate pass.

    A constant column makes r undefined: the result is null instead of an
    ANSI divide-by-zero error.
    """
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            xa, xb = F.col(a).cast("double"), F.col(b).cast("double")
            both = xa.isNotNull() & xb.isNotNull()
            va, vb = F.when(both, xa), F.when(both, xb)
            # cov / (sd * sd) with try_divide: a constant column gives null,
            # where corr() would raise under ANSI mode
            aggs.append(F.try_divide(F.covar_pop(va, vb), F.stddev_pop(va) * F.stddev_pop(vb))
                        .alias(f"{i}_{j}"))
    wide = df.agg(*aggs)
    # both orders of a pair read the same aggregate column: one pass, no union
    n = len(cols)
    both_orders = wide.select(*[F.col(f"{min(i, j)}_{max(i, j)}").alias(f"{i}_{j}")
                                for i in range(n) for j in range(n)])
    row = both_orders.unpivot([], both_orders.columns, "pair", "correlation")
    ij = F.split("pair", "_")
    names = F.array(*[F.lit(c) for c in cols])
    pairs = row.select(ij[0].cast("int").alias("i"), ij[1].cast("int").alias("j"), "correlation")
    return pairs.select("i", "j", F.element_at(names, F.col("i") + 1).alias("feature_1"),
                        F.element_at(names, F.col("j") + 1).alias("feature_2"), "correlation")


def top_correlations(df: DataFrame, cols: Sequence[str], k: int = 2) -> DataFrame:
    """Upper triangle without the diagonal, by |r| descending, top k, sign kept."""
    m = corr_matrix(df, cols).filter((F.col("i") < F.col("j")) & F.col("correlation").isNotNull())
    return (m.withColumn("absolute_correlation", F.abs("correlation"))
            .orderBy(F.col("absolute_correlation").desc(), "i", "j").limit(k)
            .select("feature_1", "feature_2", "correlation", "absolute_correlation"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins kept."""
    x = F.col(col).cast("double")
    st = scalars(df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")))
    lo = F.lit(st["lo"]).cast("double")
    width = (F.lit(st["hi"]).cast("double") - lo) / bins
    idx = F.when(width > 0, F.least(F.floor((x - lo) / width).cast("int"), F.lit(bins - 1))) \
        .otherwise(F.lit(0))
    counted = (df.where(x.isNotNull()).groupBy(idx.alias("bin"))
               .agg(F.count(F.lit(1)).alias("count")))
    all_bins = counted.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counted, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def density_curve(df: DataFrame, col: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a grid (Scott bandwidth n^(-1/5) * std).

    Every task adds the kernels of its values to one vector of ``points`` sums (the input as the scan
    gives it, no shuffle before); the tasks' vectors meet per grid point, so the shuffle holds ``points`` numbers per task.
    """
    x = F.col(col).cast("double")
    values = df.where(x.isNotNull()).select(x.alias("x"))
    st = scalars(values.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    n, bw = st["n"], (st["sd"] or 0.0) * max(st["n"], 1) ** -0.2
    spark = df.sparkSession
    if not bw > 0:  # fewer than two values, or one value only: no density
        return spark.createDataFrame([], "point int, x_value double, density double")
    grid = st["lo"] - cut * bw + np.arange(points) * ((st["hi"] - st["lo"] + 2 * cut * bw) / (points - 1))
    norm = 1.0 / (math.sqrt(2 * math.pi) * n * bw)

    def add(batches):
        total = np.zeros(points)
        for b in batches:
            found, times = np.unique(b["x"].to_numpy(), return_counts=True)
            for at in range(0, len(found), 4096):
                z = (grid[:, None] - found[None, at:at + 4096]) / bw
                total += np.exp(-0.5 * z * z) @ times[at:at + 4096]
        yield pd.DataFrame({"point": np.arange(points, dtype=np.int32), "part": total})

    sums = values.mapInPandas(add, "point int, part double").groupBy("point").agg(F.sum("part").alias("total"))
    places = F.element_at(F.array(*[F.lit(float(g)) for g in grid]), F.col("point") + 1)
    return sums.select("point", places.alias("x_value"), (F.col("total") * F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, value: str, group: str, k: float = 1.5) -> DataFrame:
    """Per group: quartiles, whiskers (most extreme value inside the fences), outliers."""
    q = exact_quantiles(df, [value], [0.25, 0.5, 0.75], group=group) \
        .groupBy(group).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("quantile")) \
        .toDF(group, "q1", "median", "q3")
    fences = q.withColumn("lower_fence", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
        .withColumn("upper_fence", F.col("q3") + k * (F.col("q3") - F.col("q1")))
    x = F.col(value).cast("double")
    joined = df.select(group, x.alias("__x")).where(F.col("__x").isNotNull()).join(small_side(fences), group)
    inside = (F.col("__x") >= F.col("lower_fence")) & (F.col("__x") <= F.col("upper_fence"))
    # fence columns are constant per group: carried through the aggregate
    # instead of joining the quantile plan a second time
    fence_cols = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    return joined.groupBy(group).agg(
        *[F.max(c).alias(c) for c in fence_cols],
        F.min(F.when(inside, F.col("__x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def mean_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = to_long(df, cols)
    return long.groupBy("column").agg(F.avg("value").alias("mean"),
                                      F.stddev_samp("value").alias("std"),
                                      F.stddev_pop("value").alias("std_pop"))


def standardise_columns(df: DataFrame, cols: Sequence[str], stats_from: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, learned on ``stats_from`` (default: df).

    The learned parameters are one row; a zero std divides by 1.
    """
    src = stats_from if stats_from is not None else df
    params = scalars(src.agg(*[F.avg(c).alias(f"{c}__m") for c in cols],
                             *[F.stddev_pop(c).alias(f"{c}__s") for c in cols]))
    out = df
    for c in cols:
        std = params[f"{c}__s"] or 1.0
        out = out.withColumn(c, (F.col(c) - F.lit(params[f"{c}__m"])) / F.lit(std))
    return out
