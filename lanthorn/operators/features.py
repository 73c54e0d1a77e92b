"""Deterministic feature preparation: splits, imputation, scaling, one-hot,
class weights and SMOTE oversampling.

Randomness comes only from ``md5`` of a key (the same digits in any SQL
engine): a unit value u = first 8 hex digits / 2^32.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.operators.ordinal import global_ordinal
from lanthorn.session import small_side
from lanthorn.operators.profile import exact_quantiles, modes, scalars


def md5_unit(*parts: Column | str) -> Column:
    """u in [0, 1) from md5 of the parts joined by '-'."""
    text = F.concat_ws("-", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


#: hexadecimal digits counted at once, and the rows that may be ordered in one window
DIGITS = 3
ORDERED = 100_000


def nth_by_digits(places: DataFrame, wanted: DataFrame, digits: int = DIGITS, ordered: int = ORDERED) -> DataFrame:
    """(grp, last): the n-th smallest position of each group, without sorting the rows.

    ``places``: (grp, p) with p a struct (h, k), h the hexadecimal digits of a digest; ``wanted``: (grp, n), one
    row per group.  Each round counts the rows of every value of the next ``digits`` digits (4,096 numbers a
    group) and keeps those of the value that the n-th falls into, a 4,096th; what is left is ordered once it is
    ``ordered`` rows a group or less, or once all digits are used up.  Groups with n below 1 have no row.
    """
    rows, left, used = places.withColumnRenamed("grp", "g"), small_side(wanted.where(F.col("n") > 0)), 0
    while True:
        used += digits
        head = F.substring("p.h", 1, used)
        counts = rows.groupBy("g", head.alias("head")).agg(F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy("g").orderBy("head").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = counts.withColumn("upto", F.sum("c").over(w)).join(left, F.col("g").eqNullSafe(F.col("grp")))
        found = found.where((F.col("upto") >= F.col("n")) & (F.col("upto") - F.col("c") < F.col("n"))).select(
            "grp", "head", "c", (F.col("n") - F.col("upto") + F.col("c")).alias("n")).checkpoint(eager=True)
        most = found.agg(F.max("c")).first()[0]
        near = small_side(found)
        rows = rows.join(near.select("grp", F.col("head").alias("at")), F.col("g").eqNullSafe(F.col("grp")) & (head == F.col("at"))).select("g", "p")
        if most is None or most <= ordered or used >= 32:
            break
        rows, left = rows.checkpoint(eager=True), small_side(found.select("grp", "n"))
    order = Window.partitionBy("g").orderBy("p")
    nth = rows.withColumn("r", F.row_number().over(order)).join(near.select("grp", "n"), F.col("g").eqNullSafe(F.col("grp")))
    return nth.where(F.col("r") == F.col("n")).select("grp", F.col("p").alias("last"))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                     split_col: str = "split") -> DataFrame:
    """Exact, stratified, deterministic train/test split.

    test size = ceil(f * n); each label gets floor(test * n_label / n) and
    the rows left over go to the labels with the largest remainders (ties
    to the smaller label).  Inside a label, rows are taken by md5(key),
    key.  The last test position of a label is found without sorting (``nth_by_digits``).
    """
    place = F.struct(F.md5(F.col(key).cast("string")).alias("h"), F.col(key).alias("k"))
    # the input runs once for (label, position), and once more for the rows themselves
    places = df.select(F.col(label).alias("grp"), place.alias("p")).checkpoint(eager=True)
    per = places.groupBy(F.col("grp").alias(label)).agg(F.count(F.lit(1)).alias("n_label")).checkpoint(eager=True)
    n = scalars(per.agg(F.sum("n_label").alias("n")))["n"] or 0
    test = math.ceil(n * test_fraction) if n else 0
    exact = F.lit(test) * F.col("n_label") / F.lit(max(n, 1))
    alloc = per.select(label, F.floor(exact).alias("base"), (exact - F.floor(exact)).alias("frac"))
    left = test - (scalars(alloc.agg(F.sum("base").alias("s")))["s"] or 0)
    # largest remainders first (ties to the smaller label); one row per label
    alloc = global_ordinal(alloc, [F.col("frac").desc(), F.col(label)], "__k", bounded=True) \
        .select(label, (F.col("base") + (F.col("__k") <= left).cast("long")).cast("long").alias("n_test"))
    # the rows compare with their label's last test position, found digit by digit
    alloc = alloc.checkpoint(eager=True)
    last = nth_by_digits(places, alloc.select(F.col(label).alias("grp"), F.col("n_test").alias("n")))
    last = last.toDF(label, "__last")
    borders = alloc.select(label).join(last, label, "left").checkpoint(eager=True)  # one row per label
    return (df.join(small_side(borders), label)
            .withColumn(split_col, F.when(place <= F.col("__last"), F.lit("test")).otherwise(F.lit("train")))
            .drop("__last"))


def random_split(df: DataFrame, key: str, test_fraction: float = 0.2,
                 split_col: str = "split") -> DataFrame:
    """Not stratified: the ceil(f * n) rows first by md5(key), key are test."""
    place = F.struct(F.md5(F.col(key).cast("string")).alias("h"), F.col(key).alias("k"))
    places = df.select(F.lit(0).alias("grp"), place.alias("p")).checkpoint(eager=True)
    test = math.ceil(places.count() * test_fraction)
    one = df.sparkSession.createDataFrame([(0, test)], "grp int, n bigint")
    last = nth_by_digits(places, one).first()
    last = last["last"] if last else None  # the last test position
    if last is None:
        return df.withColumn(split_col, F.lit("train"))
    border = F.struct(F.lit(last["h"]).alias("h"), F.lit(last["k"]).alias("k"))
    return df.withColumn(split_col, F.when(place <= border, F.lit("test")).otherwise(F.lit("train")))


def split_balance(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Class % in train and in test, side by side."""
    counts = df.groupBy(label).pivot(split_col, ["train", "test"]).agg(F.count(F.lit(1)))
    totals = scalars(df.groupBy().pivot(split_col, ["train", "test"]).agg(F.count(F.lit(1))))
    return counts.select(
        label,
        (F.coalesce(F.col("train"), F.lit(0)).cast("double") * 100.0 / F.lit(totals["train"] or 1))
        .alias("train_pct"),
        (F.coalesce(F.col("test"), F.lit(0)).cast("double") * 100.0 / F.lit(totals["test"] or 1))
        .alias("test_pct"))


def learn_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    rows = exact_quantiles(train, cols, [0.5]).collect()
    return {r["column"]: r["quantile"] for r in rows}


def learn_modes(train: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    return {r["column"]: r["mode"] for r in modes(train, cols).collect()}


def impute(df: DataFrame, values: dict) -> DataFrame:
    out = df
    for c, v in values.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)))
    return out


def learn_scaling(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column (std 0 -> 1)."""
    st = scalars(train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                           *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]))
    return {c: (st[f"m_{c}"], st[f"s_{c}"] or 1.0) for c in cols}


def scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    out = df
    for c, (m, s) in params.items():
        out = out.withColumn(c, (F.col(c) - F.lit(m)) / F.lit(s))
    return out


def one_hot(train: DataFrame, df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """0/1 column per category seen in train (sorted); unseen and null -> zeros.

    Uses StringIndexer (alphabetical, 'keep' bucket for unseen) and
    OneHotEncoder with dropLast=True, which drops exactly the unseen slot.
    """
    prefix = prefix if prefix is not None else f"{col}_"
    indexer = StringIndexer(inputCol=col, outputCol=f"{col}__idx", handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(train)
    enc = OneHotEncoder(inputCols=[f"{col}__idx"], outputCols=[f"{col}__vec"], dropLast=True) \
        .fit(indexer.transform(train))
    out = enc.transform(indexer.transform(df)).withColumn(f"{col}__arr", vector_to_array(f"{col}__vec"))
    for i, lab in enumerate(indexer.labels):
        out = out.withColumn(f"{prefix}{lab}", F.col(f"{col}__arr")[i].cast("int"))
    return out.drop(f"{col}__idx", f"{col}__vec", f"{col}__arr")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """'balanced' weight n / (k * n_class) per class."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    st = scalars(per.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k")))
    return per.select(label, "n_class",
                      (F.lit(float(st["n"] or 0)) / (F.lit(st["k"]) * F.col("n_class"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    return df.join(small_side(class_weights(df, label).select(label, weight_col)), label)


def smote(df: DataFrame, label: str, key: str, vector: str, minority, k: int = 5,
          neighbours: DataFrame | None = None) -> DataFrame:
    """Synthetic minority rows up to the majority count.

    Synthetic row j (1..m, m = majority - minority) starts from the minority
    row at position ((j - 1) mod n_min) + 1 in key order, picks one of its
    k nearest minority neighbours by md5(key, j) and moves u(key, j) of the
    way towards it: a + u * (b - a).  Neighbours are exact (``knn``).
    Output: key of the parent, copy j, label, vector.
    """
    from lanthorn.operators.vectors import knn  # local import: vectors imports features

    counts = scalars(df.agg(F.count_if(F.col(label) == minority).alias("n_min"),
                            F.count_if(F.col(label) != minority).alias("n_maj")))
    n_min, m = counts["n_min"], counts["n_maj"] - counts["n_min"]
    if m <= 0 or n_min == 0:
        return df.limit(0).select(F.col(key).alias("parent"), F.lit(0).alias("copy"), label, vector)
    mino = global_ordinal(df.filter(F.col(label) == minority).select(key, vector), [key], "__o")
    reps = F.lit(m // n_min) + (F.col("__o") <= m % n_min).cast("long")
    copies = mino.withColumn("__c", F.explode(F.sequence(F.lit(1).cast("long"), reps.cast("long")))) \
        .where(reps > 0) \
        .withColumn("copy", ((F.col("__c") - 1) * n_min + F.col("__o")).cast("long"))
    nn = neighbours if neighbours is not None else knn(
        mino.select(key, vector), mino.select(key, vector), k, key, key, vector, vector,
        exclude_self=True)
    pick = (F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"),
                                                  F.col("copy").cast("string"))), 1, 8), 16, 10)
            .cast("long") % k) + 1
    chosen = copies.withColumn("rank", pick).join(
        nn.select(F.col("query_id").alias(key), "rank", F.col("neighbor_id").alias("__nb")),
        [key, "rank"])
    nb_vec = mino.select(F.col(key).alias("__nb"), F.col(vector).alias("__b"))
    u = md5_unit(F.col(key), F.lit("u"), F.col("copy"))
    synth = chosen.join(nb_vec, "__nb").withColumn("__u", u)
    return synth.select(
        F.col(key).alias("parent"), "copy", F.lit(minority).alias(label),
        F.zip_with(F.col(vector), F.col("__b"),
                   lambda a, b: a.cast("double") + F.col("__u") * (b.cast("double") - a.cast("double")))
        .alias(vector))
