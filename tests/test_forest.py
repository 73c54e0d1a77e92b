"""Forest grown by Spark-summed large nodes and subtrees of small ones."""

import random
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lanthorn.operators import forest as fo
from lanthorn.operators import models as md


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    data = [(i, r.random(), r.random(), float(i % 3), None) for i in range(900)]
    data = [(i, a, b, c, int((a > 0.5) ^ (b > 0.4))) for i, a, b, c, _ in data]
    df = spark.createDataFrame(data + data[:20], "id int, a double, b double, c double, y int")  # repeated rows are kept
    return df.select("id", array_to_vector(F.array("a", "b", "c")).alias("features"), "y").cache()


@pytest.mark.parametrize("small", [1 << 19, 60])
def test_forest_learns_by_either_way(spark, rows, monkeypatch, small):
    monkeypatch.setattr(fo, "SUBTREE_ROWS", small)  # 60: most levels are split by summed histograms
    seen, unseen = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    model = fo.Forest(labelCol="y", keyCol="id", numTrees=15, maxDepth=12, subset=2).fit(seen)
    out = model.transform(unseen)
    assert out.count() == unseen.count() and set(unseen.columns) < set(out.columns)
    assert out.where("prediction = y").count() > 0.92 * unseen.count()
    path = tempfile.mkdtemp(prefix="lanthorn-forest-", dir="/tmp") + "/m"
    PipelineModel(stages=[model]).write().overwrite().save(path)
    cols = ["id", "prediction", F.col("probability").cast("string")]
    again = PipelineModel.load(path).transform(unseen)
    assert again.select(*cols).exceptAll(out.select(*cols)).count() == 0


def test_stump_takes_the_best_threshold(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i), int(i >= 30)) for i in range(80)], "id int, a double, y int")
    df = df.select("id", array_to_vector(F.array("a")).alias("features"), "y")
    for small in (1 << 19, 10):
        monkeypatch.setattr(fo, "SUBTREE_ROWS", small)
        out = fo.Forest(labelCol="y", keyCol="id", numTrees=9, maxDepth=1, subset=1, maxBins=128).fit(df).transform(df)
        assert out.where("prediction <> y and id not in (29, 30)").count() == 0  # a bag may lack the rows beside the border


def test_grown_leaves_hold_the_rows_that_reach_them():
    r = np.random.default_rng(1)
    x, y = r.integers(0, 30, (4000, 5)).astype(np.uint8), (r.random(4000) < 0.4).astype(np.uint8)
    w = fo.bag(np.arange(4000), 42, 0)
    keep = w > 0
    tree = fo.grow(x[keep], y[keep], w[keep], 30, 2, np.random.default_rng(2))
    leaf = fo.descend(tree, x[keep])
    ends = np.unique(leaf)
    assert (tree["left"][ends] < 0).all() and len(ends) > 500
    assert (np.bincount(leaf, w[keep])[ends] == tree["total"][ends]).all()
    assert (np.bincount(leaf, w[keep] * y[keep])[ends] == tree["ones"][ends]).all()


def test_random_forest_is_the_scaled_one():
    assert isinstance(md.random_forest("y", 9, key="id"), fo.Forest) and md.random_forest("y", 9, key="id").getOrDefault("subset") == 3


@pytest.mark.parametrize("small", [1 << 19, 60])
def test_cut_counts_are_those_of_smaller_forests(spark, rows, monkeypatch, small):
    monkeypatch.setattr(fo, "SUBTREE_ROWS", small)
    seen, unseen = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    made = lambda t, d: fo.Forest(labelCol="y", keyCol="id", numTrees=t, maxDepth=d, subset=2).fit(seen)
    counts = md.forest_grid_counts(made(5, 12), unseen, "y", [2, 5], [None, 1, 4], "unused")
    assert len(counts) == 6
    for t, d in ((2, None), (5, 1), (2, 4)):
        out = made(t, 12 if d is None else d).transform(unseen).groupBy("prediction", "y").count().collect()
        out = {(r["prediction"], r["y"]): r["count"] for r in out}
        assert counts[t, d] == tuple(out.get(k, 0) for k in ((1, 1), (1, 0), (0, 1))), (t, d)


def test_grid_uses_the_scaled_forest(spark, rows, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("a forest of pyspark.ml sums every open node's histogram over all partitions")

    monkeypatch.setattr(md, "RandomForestClassifier", refused)
    named = rows.select("id", "y", fo.vector_to_array("features")[0].alias("a"), fo.vector_to_array("features")[1].alias("b"))
    found, best = md.grid_search(named, "y", md.FeaturePrep(numeric=["a", "b"]), 2, trees=(3, 5), depths=(None, 4), folds=2, key="id")
    assert [r[:3] for r in found] == [(t, d, m) for t in (3, 5) for d in (None, 4) for m in ("sqrt", "log2")]
    assert all(r[3] > 0.9 for r in found) and best in [r[:3] for r in found]


@pytest.mark.parametrize("small", [1 << 19, 60])
def test_only_trees_without_the_row_vote_out_of_bag(spark, rows, monkeypatch, small):
    monkeypatch.setattr(fo, "SUBTREE_ROWS", small)
    model = fo.Forest(labelCol="y", keyCol="id", numTrees=6, maxDepth=8, subset=2).fit(rows)
    row = rows.select("id", "y", F.xxhash64(F.col("id").alias("k"), fo.vector_to_array("features"), "y").alias("r")).toPandas()
    lacks = sum((fo.bag(row["r"].to_numpy(), 42, t) == 0).astype(int) for t in range(6))
    got = model.out_of_bag(rows).toPandas()
    assert sorted(zip(got["id"], got["n"])) == sorted((i, n) for i, n in zip(row["id"], lacks) if n)
    one = fo.Forest(labelCol="y", keyCol="id", numTrees=1, maxDepth=8, subset=2).fit(rows)  # the first tree alone
    first = one.out_of_bag(rows).select("id", "p1").distinct().toPandas().set_index("id")["p1"]
    share = one.transform(rows).select("id", fo.vector_to_array("probability")[1].alias("p")).distinct().toPandas().set_index("id")["p"]
    assert 200 < len(first) < 500 and np.allclose(first, share[first.index])


def test_oob_score_of_a_learnable_label_and_of_noise(spark, rows, monkeypatch):
    monkeypatch.setattr(md, "RandomForestClassifier", None)  # no forest of pyspark.ml per bag
    out = md.oob_score(rows, "y", "id", trees=25, max_depth=10, max_features="2", p=3).first()
    assert out["oob_score"] > 0.9 and out["rows_with_oob"] == 900  # copies of a key vote as one
    noise = rows.select("id", "features", (F.xxhash64("id") % 2 == 0).cast("int").alias("y"))
    assert 0.4 < md.oob_score(noise, "y", "id", trees=12, max_features="2", p=3).first()["oob_score"] < 0.6


def test_packed_rows_travel_and_walk_as_the_binned_ones():
    r = np.random.default_rng(4)
    for sizes in ([64] * 5 + [2] * 10, [256] * 20):  # one number a row, and several
        x = np.stack([r.integers(0, n, 3000) for n in sizes], axis=1).astype(np.uint8)
        y, w = (x[:, 0] > x[:, 1]).astype(np.uint8), fo.bag(np.arange(3000), 42, 1)
        lay = fo.Packing(sizes)
        rows = lay.receive(lay.send(lay.pack(x, y)))
        assert (rows == lay.pack(x, y)).all() and (lay.words > 1) == (len(sizes) == 20) and lay.bytes < 8 or lay.words > 1
        tree = fo.grow_packed(lay.weighed(rows, w), lay, 30, 4, np.random.default_rng(2))
        by_bins = fo.grow(x[w > 0], y[w > 0], w[w > 0], 30, 4, np.random.default_rng(2))
        assert all((tree[c] == by_bins[c]).all() for c in tree) and len(tree["left"]) > 100
        assert (fo.descend_packed(tree, rows, lay) == fo.descend(tree, x)).all()


@pytest.mark.parametrize("small", [1 << 19, 60])
def test_rows_meet_whole_trees_as_they_meet_subtrees(spark, rows, monkeypatch, small):
    monkeypatch.setattr(fo, "SUBTREE_ROWS", small)
    model = fo.Forest(labelCol="y", keyCol="id", numTrees=6, maxDepth=8, subset=2).fit(rows)

    def found():
        out = model.transform(rows).select("id", F.round(fo.vector_to_array("probability")[1], 9).alias("p")).collect()
        return sorted(map(tuple, out)), model.grid_counts(rows.withColumn("y", F.col("y")), [2, 6], [None, 2]), sorted(map(tuple, model.out_of_bag(rows).select("id", "n").collect()))

    whole = found()
    monkeypatch.setattr(fo, "TREE_BYTES", 0)
    assert found() == whole


def test_rows_are_sent_once_per_group_of_trees(spark, rows, monkeypatch):
    seen = []
    made = fo.Forest._whole_trees
    monkeypatch.setattr(fo.Forest, "_whole_trees", lambda self, *a, **k: seen.append(made(self, *a, **k)) or seen[-1])
    fo.Forest(labelCol="y", keyCol="id", numTrees=20, maxDepth=6, subset=2).fit(rows)
    assert seen[0].count() == 20 and seen[0].rdd.getNumPartitions() == 3  # not a copy of the rows for each of 20 trees


@pytest.mark.parametrize("small", [1 << 19, 60])
def test_trees_vote_where_they_are_grown_as_the_written_ones_do(spark, rows, monkeypatch, small):
    monkeypatch.setattr(fo, "SUBTREE_ROWS", small)
    seen, unseen = rows.where("id % 4 > 0"), rows.where("id % 4 = 0").withColumn("y", F.expr("if(id % 16 = 0, null, y)"))
    forest = fo.Forest(labelCol="y", keyCol="id", numTrees=5, maxDepth=9, subset=2)
    counts = forest.fit(seen).grid_counts(unseen, [2, 5], [None, 1, 4])
    kept = lambda df: sorted((r["id"], round(r["p1"], 9), r["n"]) for r in df.collect())
    votes = kept(forest.fit(rows).out_of_bag(rows))
    if small > 60:  # no tree is written
        monkeypatch.setattr(fo.Forest, "_fitted", None)
    assert forest.grid_counts(seen, unseen, [2, 5], [None, 1, 4]) == counts
    assert kept(forest.out_of_bag(rows)) == votes
