"""Model bindings on the passenger table (rows-only checks, unit-tested).

Numbers cannot equal scikit-learn's digit for digit (other solvers, binned
trees, other random streams); the semantics are the same: split before
fitting, features learned on train only, positive-class metrics.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.operators import evaluate as ev
from lanthorn.operators import features as fe
from lanthorn.operators import models as md
from lanthorn.operators import relational as rel
from lanthorn.plans import analytics as an
from lanthorn.plans.registry import query
from lanthorn.session import scratch_path

NUMERIC = ["pclass", "age", "sibsp", "parch", "fare"]
CATEGORICAL = ["sex", "embarked"]
REG_NUMERIC = ["pclass", "age", "sibsp", "parch", "survived"]
LABEL = "survived"
BASE_MODELS = ("Logistic Regression", "Decision Tree", "Random Forest")


class Prepared:
    """Split, fitted feature preparation and cached train/test features."""

    def __init__(self, spark, sf_dir):
        # the split is written once (shared checkpoint folder); train and
        # test are filters over those files, not two runs of the joins
        s = an.split(spark, sf_dir).checkpoint(eager=True)
        self.train_raw = s.filter(F.col("split") == "train").drop("split")
        self.test_raw = s.filter(F.col("split") == "test").drop("split")
        self.prep = md.FeaturePrep(numeric=NUMERIC, categorical=CATEGORICAL)
        self.prep_model = self.prep.fit(self.train_raw)
        cols = ["passenger_id", LABEL, "features"]
        self.train = self.prep_model.transform(self.train_raw).select(*cols).cache()
        self.test = self.prep_model.transform(self.test_raw).select(*cols).cache()
        self.n_train = self.train.count()
        self.names = md.feature_names(self.train)
        self.p = len(self.names)

    def estimator(self, name: str):
        if name == "Logistic Regression":
            return md.logistic_regression(LABEL, self.n_train)
        if name == "Decision Tree":
            return md.decision_tree(LABEL, 5)
        return md.random_forest(LABEL, self.p, trees=100, key="passenger_id")


def _report(spark, sf_dir, names=BASE_MODELS) -> DataFrame:
    pr = Prepared(spark, sf_dir)
    rows = [md.classifier_report(n, pr.estimator(n).fit(pr.train).transform(pr.test), LABEL) for n in names]
    return rel.append_batches(rows)


@query("column_transformer", an._with("""
, names AS (
  SELECT 0 AS grp, 0 AS k, 'pclass__z' AS feature UNION ALL SELECT 0, 1, 'age__z'
  UNION ALL SELECT 0, 2, 'sibsp__z' UNION ALL SELECT 0, 3, 'parch__z' UNION ALL SELECT 0, 4, 'fare__z'
  UNION ALL SELECT DISTINCT 1, 0, 'sex__v_' || sex FROM split WHERE split = 'train' AND sex IS NOT NULL
  UNION ALL SELECT DISTINCT 2, 0, 'embarked__v_' || embarked FROM split
    WHERE split = 'train' AND embarked IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY grp, k, feature) - 1 AS INTEGER) AS position, feature FROM names"""
                                         .replace("\n, names AS", ", names AS")))
def q_column_transformer(spark, sf_dir):
    pr = Prepared(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(pr.names)), "position int, feature string")


@query("logistic_regression")
def q_logistic_regression(spark, sf_dir):
    return _report(spark, sf_dir, ["Logistic Regression"])


@query("decision_tree")
def q_decision_tree(spark, sf_dir):
    return _report(spark, sf_dir, ["Decision Tree"])


@query("random_forest")
def q_random_forest(spark, sf_dir):
    return _report(spark, sf_dir, ["Random Forest"])


@query("train_all")
def q_train_all(spark, sf_dir):
    return _report(spark, sf_dir)


@query("predict")
def q_predict(spark, sf_dir):
    pr = Prepared(spark, sf_dir)
    pred = md.with_scores(pr.estimator("Logistic Regression").fit(pr.train).transform(pr.test))
    return pred.select("passenger_id", LABEL, F.col("prediction").cast("int").alias("prediction"), "score")


@query("tree_table")
def q_tree_table(spark, sf_dir):
    pr = Prepared(spark, sf_dir)
    tree = pr.estimator("Decision Tree").fit(pr.train)
    return md.tree_table(tree, pr.names, scratch_path(spark, "tree"))


def _smote_train(pr: Prepared) -> DataFrame:
    arr = pr.train.withColumn("fa", vector_to_array("features"))
    synth = fe.smote(arr, LABEL, "passenger_id", "fa", minority=1, k=5)
    extra = synth.select((-F.col("copy")).alias("passenger_id"),
                         F.col(LABEL).cast("int").alias(LABEL), array_to_vector("fa").alias("features"))
    # the search runs once: the count and every pass of the fit read the written rows
    return pr.train.unionByName(extra.checkpoint(eager=True))


@query("imbalance_compare")
def q_imbalance_compare(spark, sf_dir):
    pr = Prepared(spark, sf_dir)
    weighted = fe.with_class_weight(pr.train, LABEL, "weight")
    fits = {
        "Baseline": md.logistic_regression(LABEL, pr.n_train).fit(pr.train),
        # the balanced weights sum to n, so regParam = 1/n keeps C = 1
        "Class Weight Balanced": md.logistic_regression(LABEL, pr.n_train, "weight").fit(weighted),
        "SMOTE": None,
    }
    smoted = _smote_train(pr)
    fits["SMOTE"] = md.logistic_regression(LABEL, smoted.count()).fit(smoted)
    rows = []
    for name, model in fits.items():
        m = ev.classification_metrics(model.transform(pr.test), LABEL, "prediction", 1)
        rows.append(m.select(F.lit(name).alias("strategy"), "precision", "recall", "f1"))
    table = rel.append_batches(rows)
    best = rel.argmax_row(table, "f1", ["strategy"]).select(F.col("strategy").alias("__best"))
    return table.join(best, F.col("strategy") == F.col("__best"), "left") \
        .withColumn("best", F.col("__best").isNotNull()).drop("__best")


@query("cv_folds", an._with("""
SELECT passenger_id, survived, CAST((row_number() OVER (PARTITION BY survived
  ORDER BY md5(CAST(passenger_id AS VARCHAR)), passenger_id) - 1) % 5 AS INTEGER) AS fold
FROM split WHERE split = 'train'"""))
def q_cv_folds(spark, sf_dir):
    train = an.split(spark, sf_dir).filter(F.col("split") == "train")
    return md.stratified_folds(train, LABEL, "passenger_id").select("passenger_id", LABEL, "fold")


def _grid(pr: Prepared) -> tuple:
    """Rows and winner of the grid over the training rows."""
    return md.grid_search(pr.train_raw, LABEL, md.FeaturePrep(numeric=NUMERIC, categorical=CATEGORICAL), pr.p, key="passenger_id")


@query("grid_search_cv")
def q_grid_search_cv(spark, sf_dir):
    rows, best = _grid(Prepared(spark, sf_dir))
    return spark.createDataFrame([(*r, r[:3] == best) for r in rows],
                                 "n_estimators int, max_depth int, max_features string, mean_f1 double, best boolean")


@query("oob_score")
def q_oob_score(spark, sf_dir):
    """Out-of-bag score of the setting that wins the grid."""
    pr = Prepared(spark, sf_dir)
    _, (trees, depth, features) = _grid(pr)
    out = md.oob_score(pr.train, LABEL, "passenger_id", trees=trees, max_depth=depth, max_features=features, p=pr.p)
    return out.select(F.lit(trees).alias("n_estimators"), F.lit(depth).cast("int").alias("max_depth"),
                      F.lit(features).alias("max_features"), "oob_score", "rows_with_oob")


def _regression(spark, sf_dir):
    # the joins run once: every pass of the fits and metrics reads the written split
    p = fe.random_split(an.passengers(spark, sf_dir), "passenger_id").checkpoint(eager=True)
    train = p.filter(F.col("split") == "train")
    test = p.filter(F.col("split") == "test")
    prep = md.FeaturePrep(numeric=REG_NUMERIC, categorical=CATEGORICAL).fit(train)
    tr, te = prep.transform(train), prep.transform(test)
    model = md.linear_regression("fare").fit(tr)
    return model.transform(te), len(md.feature_names(te.limit(1)))


@query("linear_regression")
def q_linear_regression(spark, sf_dir):
    pred, p = _regression(spark, sf_dir)
    return ev.regression_metrics(pred, "fare", "prediction", p).withColumn("n_features", F.lit(p))


@query("final_comparison")
def q_final_comparison(spark, sf_dir):
    cls = _report(spark, sf_dir).select(
        "model", *[F.col(c).alias(f"classification_{c}") for c in ("accuracy", "precision", "recall",
                                                                   "f1", "auc")])
    pred, p = _regression(spark, sf_dir)
    reg = ev.regression_metrics(pred, "fare", "prediction", p).select(
        F.lit("Linear Regression").alias("model"),
        *[F.col(c).alias(f"regression_{c}") for c in ("mae", "rmse", "r2", "adjusted_r2")])
    return rel.append_batches([cls, reg])


@query("select_and_persist")
def q_select_and_persist(spark, sf_dir):
    """Best base model by F1, saved with its feature stage, reloaded, and the
    predictions of both compared on the whole test set."""
    from pyspark.ml import PipelineModel

    pr = Prepared(spark, sf_dir)
    fitted = {n: pr.estimator(n).fit(pr.train) for n in BASE_MODELS}
    table = rel.append_batches([md.classifier_report(n, m.transform(pr.test), LABEL)
                                for n, m in fitted.items()])
    best = rel.argmax_row(table, "f1", ["model"]).collect()[0]["model"]
    whole = PipelineModel(stages=[pr.prep_model, fitted[best]])
    path = scratch_path(spark, "best-pipeline")
    whole.write().overwrite().save(path)
    reloaded = PipelineModel.load(path)
    cols = ["passenger_id", "prediction", "probability"]
    a = whole.transform(pr.test_raw).select(*cols).withColumn("probability", vector_to_array("probability"))
    b = reloaded.transform(pr.test_raw).select(*cols).withColumn("probability", vector_to_array("probability"))
    eq = rel.frames_equal(a, b)
    return eq.select(F.lit(best).alias("best_model"), F.col("equal").alias("predictions_match"), "left_rows")


@query("expect_same_predictions", an._with("""
SELECT 'reloaded pipeline predicts as the original' AS rule, CAST(0 AS BIGINT) AS violations"""))
def q_expect_same_predictions(spark, sf_dir):
    """Feature stage + decision tree saved and reloaded; the violations are
    test rows whose prediction or probability differ (keyed join, so rows
    are compared one to one, on the whole test set)."""
    from pyspark.ml import PipelineModel

    pr = Prepared(spark, sf_dir)
    whole = PipelineModel(stages=[pr.prep_model, pr.estimator("Decision Tree").fit(pr.train)])
    path = scratch_path(spark, "reload-check")
    whole.write().overwrite().save(path)
    reloaded = PipelineModel.load(path)

    def scored(model, tag):
        out = model.transform(pr.test_raw)
        return out.select("passenger_id", F.col("prediction").alias(f"pred_{tag}"),
                          vector_to_array("probability").alias(f"prob_{tag}"))

    pairs = scored(whole, "a").join(scored(reloaded, "b"), "passenger_id", "full_outer")
    differ = ~F.coalesce((F.col("pred_a") == F.col("pred_b")) & (F.col("prob_a") == F.col("prob_b")),
                         F.lit(False))
    return pairs.agg(F.count_if(differ).alias("violations")).select(
        F.lit("reloaded pipeline predicts as the original").alias("rule"), F.col("violations").cast("long"))
