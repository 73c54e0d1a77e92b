"""Models on ``pyspark.ml``: feature preparation, classifiers, tuning, OOB.

The fits run as Spark jobs; the driver only holds learned parameters.
Choices that keep the semantics of the scikit-learn defaults used by the
reference are noted where they are made.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)  # noqa: F401, forests that forest_grid_counts takes as well
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanthorn.operators import evaluate as ev
from lanthorn.operators import features as fe
from lanthorn.operators.forest import Forest, ForestModel
from lanthorn.operators.ordinal import rank_within


def _num_lit(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _str_lit(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class FeaturePrep(Estimator):
    """Numeric: median imputation then (x - mean) / population std.
    Categorical: mode imputation then one-hot over the sorted categories
    seen in training (unseen -> all zeros).  Output: one ``features``
    vector, numeric block first; its attribute metadata carries the names.

    Fitting returns a ``PipelineModel`` of built-in stages (SQL transform
    with the learned constants, string indexers, one-hot encoder, vector
    assembler), so a fitted pipeline saves and loads like any other.
    """

    numeric = Param(Params._dummy(), "numeric", "numeric input columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "categorical input columns",
                        TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "features column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numeric=(), categorical=(), outputCol="features"):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        num = self.getOrDefault(self.numeric)
        cat = self.getOrDefault(self.categorical)
        out = self.getOrDefault(self.outputCol)
        medians = fe.learn_medians(df, num) if num else {}
        modes = fe.learn_modes(df, cat) if cat else {}
        imputed = df
        for c in num:
            imputed = imputed.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))))
        scaling = fe.learn_scaling(imputed, num) if num else {}
        exprs = []
        for c in num:
            m, s = scaling[c]
            med = medians.get(c)
            filled = f"coalesce(CAST(`{c}` AS DOUBLE), {_num_lit(med) if med is not None else 'NULL'})"
            exprs.append(f"({filled} - {_num_lit(m)}) / {_num_lit(s)} AS `{c}__z`")
        for c in cat:
            mode = modes.get(c)
            exprs.append(f"coalesce(`{c}`, {_str_lit(mode) if mode is not None else 'NULL'}) AS `{c}__f`")
        sqlt = SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__")
        stages = [sqlt]
        staged = sqlt.transform(df)
        vec_inputs = [f"{c}__z" for c in num]
        if cat:
            idx = [StringIndexer(inputCol=f"{c}__f", outputCol=f"{c}__i", handleInvalid="keep",
                                 stringOrderType="alphabetAsc").fit(staged) for c in cat]
            for m in idx:
                staged = m.transform(staged)
            ohe = OneHotEncoder(inputCols=[f"{c}__i" for c in cat], outputCols=[f"{c}__v" for c in cat],
                                dropLast=True).fit(staged)
            stages += [*idx, ohe]
            vec_inputs += [f"{c}__v" for c in cat]
        stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=out, handleInvalid="keep"))
        return PipelineModel(stages=stages)


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the assembled vector's slots, from its column metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def sklearn_subset(strategy: str, p: int) -> str:
    """scikit-learn rounds sqrt/log2 feature counts down; Spark rounds up."""
    if strategy == "sqrt":
        return str(max(1, int(math.sqrt(p))))
    if strategy == "log2":
        return str(max(1, int(math.log2(p))))
    return strategy


def logistic_regression(label: str, n_train: int, weight_col: str | None = None) -> LogisticRegression:
    """L2, C = 1: scikit's sum-of-losses objective equals Spark's mean loss
    with regParam = 1 / n (features are already standardised)."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", regParam=1.0 / max(n_train, 1),
                            elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-10)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


# Deep trees: keep each row's node id cached between levels and let one
# pass split many nodes; without these a depth-30 forest is ~5x slower.
TREE_SPEED = dict(cacheNodeIds=True, maxMemoryInMB=2048, checkpointInterval=10)
# Split candidates per feature (Spark quantises them); a parameter of every tree operator.
MAX_BINS = 64


def decision_tree(label: str, max_depth: int = 5, seed: int = 42, max_bins: int = MAX_BINS) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth,
                                  impurity="gini", seed=seed, maxBins=max_bins, **TREE_SPEED)


def random_forest(label: str, p: int, trees: int = 100, max_depth: int | None = None,
                  max_features: str = "sqrt", seed: int = 42, max_bins: int = MAX_BINS, key: str = "id") -> Forest:
    """Unbounded depth maps to Spark's largest depth (30).  ``key`` tells the rows apart in the bags."""
    return Forest(labelCol=label, featuresCol="features", keyCol=key, numTrees=trees, maxDepth=30 if max_depth is None else max_depth,
                  subset=int(sklearn_subset(max_features, p)), maxBins=max_bins, seed=seed)


def with_scores(pred: DataFrame, prob: str = "probability") -> DataFrame:
    return pred.withColumn("score", vector_to_array(prob)[1])


def classifier_report(model_name: str, pred: DataFrame, label: str) -> DataFrame:
    """accuracy, precision, recall, F1 (positive class) and AUC for one model."""
    scored = with_scores(pred)
    auc = ev.roc_auc(scored, label, "score").collect()[0]["auc"]
    m = ev.classification_metrics(scored, label, "prediction", 1)
    return m.select(F.lit(model_name).alias("model"), "accuracy", "precision", "recall", "f1",
                    F.lit(auc).cast("double").alias("auc"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, fold_col: str = "fold") -> DataFrame:
    """fold = (rank within label by md5(key), key - 1) mod k: stratified, deterministic."""
    ranked = rank_within(df.withColumn("__h", F.md5(F.col(key).cast("string"))), [label], ["__h", key],
                         "__r")
    return ranked.withColumn(fold_col, ((F.col("__r") - 1) % k).cast("int")).drop("__h", "__r")


class NodeTable:
    """The trees of a fitted forest as arrays: children, split, prediction and class votes of every node.

    Read back from the saved model (standard ML persistence).  Inner nodes carry a prediction and votes of their
    own, so a forest grown to any depth also holds every shallower one, and its first trees every smaller one.
    """

    def __init__(self, spark: SparkSession, model, save_to: str):
        model.write().overwrite().save(save_to)
        rows = spark.read.parquet(f"{save_to}/data").select(
            "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild",
            "nodeData.split.featureIndex", F.col("nodeData.split.leftCategoriesOrThreshold").alias("values"),
            F.coalesce("nodeData.split.numCategories", F.lit(-1)).alias("categories"))
        table = rows.orderBy("treeID", "id").toPandas()
        start = table.groupby("treeID")["id"].transform("size").groupby(table["treeID"]).first().cumsum().shift(fill_value=0)
        first = table["treeID"].map(start).to_numpy(dtype=np.int64)
        self.roots = start.to_numpy(dtype=np.int64)
        self.leaf = (table["leftChild"] < 0).to_numpy()
        self.left = np.where(self.leaf, 0, first + table["leftChild"].to_numpy())
        self.right = np.where(self.leaf, 0, first + table["rightChild"].to_numpy())
        self.feature = np.where(self.leaf, 0, table["featureIndex"].fillna(0).to_numpy(dtype=np.int64))
        values = [v if v is not None else () for v in table["values"]]
        # a feature marked as categorical is split by a set of values, any other by a threshold
        sets = (~self.leaf) & (table["categories"] >= 0).to_numpy()
        self.threshold = np.array([v[0] if len(v) and not s else 0.0 for v, s in zip(values, sets)])
        self.set_no = np.where(sets, np.cumsum(sets), 0)
        self.goes_left = np.zeros((int(sets.sum()) + 1, int(max(table["categories"].max(), 0)) + 1), dtype=bool)
        for no, v in zip(self.set_no[sets], (v for v, s in zip(values, sets) if s)):
            self.goes_left[no, np.asarray(v, dtype=np.int64)] = True
        self.prediction = table["prediction"].to_numpy()
        stats = np.stack(table["impurityStats"].to_list()).astype(np.float64)
        total = stats.sum(axis=1, keepdims=True)
        self.votes = np.divide(stats, total, out=np.zeros_like(stats), where=total > 0)

    def cut(self, depth: int | None) -> np.ndarray:
        """Which nodes are leaves of the forest of at most ``depth``: siblings that end with one prediction are one leaf, as Spark prunes."""
        levels = [self.roots]
        while depth is None or len(levels) <= depth:
            inner = levels[-1][~self.leaf[levels[-1]]]
            if not len(inner):
                break
            levels.append(np.concatenate([self.left[inner], self.right[inner]]))
        ends = self.leaf.copy()
        if depth is not None and len(levels) > depth:
            ends[levels[depth]] = True
        for level in reversed(levels[:-1]):
            inner = level[~ends[level]]
            l, r = self.left[inner], self.right[inner]
            ends[inner[ends[l] & ends[r] & (self.prediction[l] == self.prediction[r])]] = True
        return ends

    def walk(self, x: np.ndarray, ends: Sequence[np.ndarray], trees: Sequence[int]) -> np.ndarray:
        """Predictions of class 1 against class 0, shape (cut, number of trees, row), every tree walked level by level once."""
        votes = np.zeros((len(ends), 2, len(x)))
        out = np.zeros((len(ends), len(trees), len(x)), dtype=bool)
        rows = np.arange(len(x))
        for t, root in enumerate(self.roots, 1):
            at = np.full(len(x), root)
            done = np.zeros((len(ends), len(x)), dtype=bool)
            while True:
                for i, leaves in enumerate(ends):
                    new = ~done[i] & leaves[at]
                    votes[i][:, new] += self.votes[at[new]].T
                    done[i] |= new
                if done.all():
                    break
                value, no = x[rows, self.feature[at]], self.set_no[at]
                category = np.clip(np.where(no > 0, value, 0), 0, self.goes_left.shape[1] - 1).astype(np.int64)
                low = np.where(no > 0, self.goes_left[no, category], value <= self.threshold[at])
                at = np.where(self.leaf[at], at, np.where(low, self.left[at], self.right[at]))
            for j, number in enumerate(trees):
                if number == t:
                    out[:, j] = votes[:, 1] > votes[:, 0]
        return out


def forest_grid_counts(model, unseen: DataFrame, label: str, trees: Sequence[int], depths: Sequence[int | None], save_to: str) -> dict:
    """{(trees, depth): (tp, fp, fn)} of class 1 on ``unseen``, all settings from one walk through one forest.

    The subtrees of a ``ForestModel`` are walked where they lie; a forest of pyspark.ml is saved to ``save_to`` and read by every task.
    """
    if isinstance(model, ForestModel):
        return model.grid_counts(unseen, trees, depths)
    nodes = NodeTable(unseen.sparkSession, model, save_to)
    ends = [nodes.cut(d) for d in depths]

    def count(batches):
        total = np.zeros((len(depths), len(trees), 3), dtype=np.int64)
        for b in batches:
            pred, y = nodes.walk(np.stack(b["x"].to_list()), ends, trees), b["y"].to_numpy() == 1
            total += np.stack([(pred & y).sum(axis=2), (pred & ~y).sum(axis=2), (~pred & y).sum(axis=2)], axis=2)
        yield pd.DataFrame([(trees[j], i, *map(int, total[i, j])) for i in range(len(depths)) for j in range(len(trees))],
                           columns=["trees", "depth_no", "tp", "fp", "fn"])

    rows = unseen.select(vector_to_array("features").alias("x"), F.col(label).alias("y"))
    sums = rows.mapInPandas(count, "trees int, depth_no int, tp bigint, fp bigint, fn bigint").groupBy("trees", "depth_no").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    return {(r["trees"], depths[r["depth_no"]]): (r["tp"], r["fp"], r["fn"]) for r in sums.collect()}


def grid_search(train: DataFrame, label: str, prep: FeaturePrep, p: int,
                trees: Sequence[int] = (100, 200), depths: Sequence[int | None] = (None, 5, 10),
                max_features: Sequence[str] = ("sqrt", "log2"), folds: int = 5, key: str = "id",
                parallelism: int = 5, max_bins: int = MAX_BINS):
    """Cross-validated grid of forests: (rows, best setting).

    The defaults of ``trees``, ``depths``, ``max_features`` and ``folds`` are fixed values of the reference grid.

    Rows are (trees, depth, max_features, mean F1 of class 1), one per named setting; depth ``None`` is
    unbounded.  A fold fits one forest per number of features (``sqrt`` and ``log2`` of p can be one number), of the
    largest number of trees and the largest depth; a setting is its first trees, cut at the setting's depth.  The folds are
    fitted side by side.  Ties go to the setting named first.
    """
    data = stratified_folds(train, label, key, folds).checkpoint(eager=True)
    named = [(t, d, m) for t in trees for d in depths for m in max_features]
    subsets = list(dict.fromkeys(sklearn_subset(m, p) for m in max_features))
    deepest = None if None in depths else max(depths)

    def fold_scores(f: int) -> dict:
        vectors = prep.fit(data.where(F.col("fold") != f)).transform(data).select(key, label, "fold", "features").checkpoint(eager=True)
        out = {}
        for subset in subsets:
            forest = random_forest(label, p, max(trees), deepest, subset, max_bins=max_bins, key=key)
            counts = forest.grid_counts(vectors.where(F.col("fold") != f), vectors.where(F.col("fold") == f), list(trees), list(depths))
            for (t, d), (tp, fp, fn) in counts.items():
                out[t, d, subset] = 2.0 * tp / (2 * tp + fp + fn) if tp else 0.0
        return out

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scores = list(pool.map(fold_scores, range(folds)))
    rows = [(t, d, m, sum(s[t, d, sklearn_subset(m, p)] for s in scores) / folds) for t, d, m in named]
    best = max(range(len(rows)), key=lambda i: (rows[i][3], -i))
    return rows, rows[best][:3]


def oob_score(data: DataFrame, label: str, key: str, trees: int = 100, max_depth: int | None = None,
              max_features: str = "sqrt", p: int = 1, max_bins: int = MAX_BINS) -> DataFrame:
    """Out-of-bag accuracy of one forest.

    Tree t sees row r with weight Poisson(1) drawn from a hash of the row and t; rows with weight 0 are out of bag for t.
    A row's OOB vote is the mean class-1 probability over the trees that did not see it, copies of a key and label vote
    as one; rows never out of bag are left out, as scikit-learn does, and so are rows without a key.
    """
    forest = random_forest(label, p, trees, max_depth, max_features, max_bins=max_bins, key=key)
    rows = forest.out_of_bag(data.select(key, label, "features")).where(F.col(key).isNotNull())
    per_row = rows.groupBy(key, label).agg((F.sum("p1") / F.sum("n")).alias("p1"))
    return per_row.agg(F.avg(((F.col("p1") > 0.5).cast("int") == F.col(label)).cast("double"))
                       .alias("oob_score"), F.count(F.lit(1)).alias("rows_with_oob"))


def linear_regression(label: str) -> LinearRegression:
    """Ordinary least squares (normal equations, no penalty)."""
    return LinearRegression(labelCol=label, featuresCol="features", regParam=0.0, solver="normal")


def tree_table(model, names: Sequence[str], save_to: str) -> DataFrame:
    """Node table of a fitted decision tree with feature names.

    The tree is saved (standard ML persistence) and its node data read back
    as a table: id, prediction, impurity, instance count, children, split
    feature name and threshold.
    """
    model.write().overwrite().save(save_to)
    nodes = SparkSession.getActiveSession().read.parquet(f"{save_to}/data")
    names_arr = F.array(*[F.lit(n) for n in names]) if names else F.array()
    leaf = F.col("leftChild") < 0
    return nodes.select(
        "id", "prediction", "impurity", F.col("rawCount").alias("n"),
        F.when(~leaf, F.col("leftChild")).alias("left"), F.when(~leaf, F.col("rightChild")).alias("right"),
        F.when(~leaf, F.element_at(names_arr, F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(~leaf, F.element_at(F.col("split.leftCategoriesOrThreshold"), 1)).alias("threshold"))
