"""Feature preparation learned on train only; save / load parity."""

import random
import tempfile

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lanthorn.operators import models as md


def test_feature_prep_learns_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (None, "b"), (4.0, None)], "x double, c string")
    test = spark.createDataFrame([(100.0, "z"), (None, "b")], "x double, c string")
    model = md.FeaturePrep(numeric=["x"], categorical=["c"]).fit(train)
    out = model.transform(test).withColumn("f", vector_to_array("features")).collect()
    # train median of x = 2.0; mean / population std after imputation over (1, 2, 2, 4)
    mean, std = 2.25, (sum((v - 2.25) ** 2 for v in (1, 2, 2, 4)) / 4) ** 0.5
    assert abs(out[0]["f"][0] - (100 - mean) / std) < 1e-12
    assert abs(out[1]["f"][0] - (2 - mean) / std) < 1e-12
    assert out[0]["f"][1:] == [0.0, 0.0]  # unseen category -> zeros
    assert out[1]["f"][1:] == [0.0, 1.0]
    assert md.feature_names(model.transform(test)) == ["x__z", "c__v_a", "c__v_b"]


def test_pipeline_save_load_parity(spark):
    rows = [(float(i % 7), "a" if i % 3 else "b", int(i % 7 > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, c string, y int")
    prep = md.FeaturePrep(numeric=["x"], categorical=["c"]).fit(df)
    lr = md.logistic_regression("y", 200).fit(prep.transform(df))
    whole = PipelineModel(stages=[prep, lr])
    path = tempfile.mkdtemp(prefix="lanthorn-model-", dir="/tmp") + "/m"
    whole.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = whole.transform(df).select(F.col("prediction"), vector_to_array("probability").alias("p"))
    b = again.transform(df).select(F.col("prediction"), vector_to_array("probability").alias("p"))
    assert a.exceptAll(b).count() == 0


def _forest(label_rows, **options):
    return md.RandomForestClassifier(labelCol="y", featuresCol="features", impurity="gini", seed=7, featureSubsetStrategy="all", **options)


def test_cut_forest_equals_the_shallow_forest(spark):
    r = random.Random(4)
    rows = [(i, [r.random() for _ in range(4)]) for i in range(600)]
    rows = [(i, x, int(x[0] + 0.5 * x[1] * (x[2] > 0.4) + 0.35 * r.random() > 0.8)) for i, x in rows]
    rows = [(i, *x, "abc"[int(x[3] * 3)], int(y ^ (x[3] > 0.7) if r.random() > 0.1 else y)) for i, x, y in rows]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, kind string, y int")
    # one-hot columns are marked as categories, so trees split them by sets of values
    df = md.FeaturePrep(numeric=["a", "b", "c"], categorical=["kind"]).fit(df).transform(df)
    df = df.select("id", "features", "y").repartition(2, "id").cache()
    seen, unseen = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    deep = _forest(rows, numTrees=12, maxDepth=12).fit(seen)
    counts = md.forest_grid_counts(deep, unseen, "y", [12], [None, 1, 3, 5], tempfile.mkdtemp(prefix="lanthorn-forest-", dir="/tmp") + "/m")
    for depth in (None, 1, 3, 5):
        shallow = deep if depth is None else _forest(rows, numTrees=12, maxDepth=depth).fit(seen)
        c = shallow.transform(unseen).agg(F.count_if(F.expr("prediction = 1 and y = 1")), F.count_if(F.expr("prediction = 1 and y = 0")),
                                          F.count_if(F.expr("prediction = 0 and y = 1"))).first()
        assert counts[12, depth] == tuple(c), depth


def test_first_trees_of_a_forest(spark):
    rows = [(float(i % 13), float(i % 7), int((i % 13) * 2 + i % 7 > 14)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y int").select(array_to_vector(F.array("a", "b")).alias("features"), "y")
    model = _forest(rows, numTrees=5, maxDepth=3).fit(df)
    nodes = md.NodeTable(spark, model, tempfile.mkdtemp(prefix="lanthorn-forest-", dir="/tmp") + "/m")
    x = [[float(a), float(b)] for a in range(13) for b in range(7)]
    got = nodes.walk(np.array(x), [nodes.cut(None)], [2, 5])[0]
    for row, two, five in zip(x, *got):
        votes = [t.predictProbability(Vectors.dense(row)) for t in model.trees]
        assert two == (sum(v[1] for v in votes[:2]) > sum(v[0] for v in votes[:2]))
        assert five == (model.predict(Vectors.dense(row)) == 1)


def test_sklearn_feature_counts():
    assert md.sklearn_subset("sqrt", 15) == "3" and md.sklearn_subset("log2", 15) == "3"


def test_regression_reads_its_tables_once(spark):
    from conftest import SF_SMALL
    from lanthorn.plans import models as pm
    pred, _ = pm._regression(spark, SF_SMALL)
    plan = pred._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "parquet" not in plan.lower()  # the written split is read, not the joins run again


def test_smote_rows_are_written_once(spark):
    from conftest import SF_SMALL
    from lanthorn.plans import models as pm
    pr = pm.Prepared(spark, SF_SMALL)
    plan = pm._smote_train(pr)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan and "Join" not in plan.split("InMemoryRelation")[-1]  # fits read written rows, no search again
