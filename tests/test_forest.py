"""Trees grown for a whole grid at once equal those of MLlib, and neighbours of all folds come from one search."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from flowguard.operators import balance as B
from flowguard.operators import forest as FO
from flowguard.operators.neighbours import knn_within_class
from flowguard.session import cut


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(3000, 5)), 3)
    x[:, 4] = np.round(x[:, 4])                          # a few values only
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=3000) / 4 > 0.6).astype(int) + (x[:, 2] > 1)
    data = [(i, float(min(c, 1)), float(c), [0.7, 1.9, 3.1][c], [0.7, 1.9][min(c, 1)], *map(float, v)) for i, (c, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(data, "row_id long, two double, label double, w3 double, w2 double, a double, b double, c double, d double, e double")
    return cut(VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df))


POINTS = [{"maxDepth": 3, "minInstancesPerNode": 1}, {"maxDepth": 9, "minInstancesPerNode": 1}, {"maxDepth": 6, "minInstancesPerNode": 40}]


@pytest.mark.parametrize("kind, label, weight, key", [(DecisionTreeRegressor, "two", "w2", "prediction"),
                                                      (DecisionTreeClassifier, "label", "w3", "probability")])
def test_trees_of_a_grid_are_those_of_mllib(rows, kind, label, weight, key):
    made = FO.fit_grid(rows, kind(seed=42, maxBins=64), POINTS, label, weight, "features")
    for point, model in zip(POINTS, made, strict=True):
        want = kind(seed=42, maxBins=64, labelCol=label, weightCol=weight, **point).fit(rows)
        a, b = [np.array([np.array(r[0].toArray() if key == "probability" else [r[0]]) for r in m.transform(rows).select(key).collect()])
                for m in (model, want)]
        # MLlib adds weights up in any order, by which splits of equal gain may part the few rows of a deep node otherwise
        deep = point["maxDepth"] == 9
        assert (np.abs(a - b).max(axis=1) > 1e-9).mean() <= (0.05 if deep else 0.0)
        assert model.depth == want.depth and abs(model.numNodes - want.numNodes) <= (10 if deep else 0)
        assert np.allclose(model.featureImportances.toArray(), want.featureImportances.toArray(), atol=0.02)


@pytest.mark.parametrize("gini", [False, True])
def test_a_grown_tree_is_that_of_mllib(rows, gini):
    label, weight = ("label", "w3") if gini else ("two", "w2")
    data, weights, thresholds = FO._table(rows, label, weight, "features", 64, 42, gini)
    table = np.frombuffer(data, np.uint8).reshape(-1, 6)
    tree = FO.grow(np.ascontiguousarray(table[:, 1:]), np.ascontiguousarray(table[:, 0]), None, weights,
                   np.array([len(t) for t in thresholds]), 8, 1, gini, 5, None)
    kind = DecisionTreeClassifier if gini else DecisionTreeRegressor
    for depth in (2, 4):
        made = FO.finished(tree, depth, weights, gini)
        want = kind(seed=42, maxBins=64, maxDepth=depth, labelCol=label, weightCol=weight).fit(rows)
        assert len(made["id"]) == want.numNodes and list(made["id"]) == list(range(want.numNodes))
        root = want._call_java("rootNode")
        assert root.split().featureIndex() == made["feature"][0]
        assert root.split().threshold() == thresholds[made["feature"][0]][made["cut"][0]]
        assert abs(root.gain() - made["gain"][0]) < 1e-12


@pytest.mark.parametrize("kind, label, weight", [(RandomForestRegressor, "two", "w2"), (RandomForestClassifier, "label", "w3")])
def test_forests_of_a_grid_share_their_trees(rows, kind, label, weight, tmp_path):
    inner = kind(seed=42, maxBins=64, featureSubsetStrategy="sqrt")
    points = [{"numTrees": t, "maxDepth": d} for t in (4, 12) for d in (3, 8)]
    made = FO.fit_grid(rows, inner, points, label, weight, "features")
    assert [(m.getNumTrees, max(t.depth for t in m.trees)) for m in made] == [(4, 3), (4, 8), (12, 3), (12, 8)]
    assert [t.toDebugString.split("\n", 1)[1] for t in made[3].trees[:4]] == [t.toDebugString.split("\n", 1)[1] for t in made[1].trees]
    assert len({t.toDebugString.split("\n", 1)[1] for t in made[3].trees}) == 12
    own = kind(seed=42, maxBins=64, featureSubsetStrategy="sqrt", labelCol=label, weightCol=weight, numTrees=12, maxDepth=8).fit(rows)
    hit = [m.transform(rows).agg(F.avg((F.abs(F.col("prediction") - F.col(label)) < 0.5).cast("double"))).first()[0] for m in (made[3], own)]
    assert abs(hit[0] - hit[1]) < 0.02 and hit[0] > 0.9
    made[3].write().save(str(tmp_path / "m"))
    assert type(own).load(str(tmp_path / "m")).totalNumNodes == made[3].totalNumNodes


def test_other_learners_and_rows_are_left_to_mllib(rows):
    trees = RandomForestRegressor(seed=1, featureSubsetStrategy="sqrt")
    assert FO.fit_grid(rows, trees, [{"maxDepth": 2}], "label", "w3", "features") is None         # a label beyond 1
    assert FO.fit_grid(rows, trees, [{"maxDepth": 2}], "two", "w3", "features") is None           # weights differ in a class
    assert FO.fit_grid(rows, trees, [{"minInfoGain": 0.1}], "two", "w2", "features") is None
    assert not FO.growable(RandomForestRegressor(featureSubsetStrategy="all"))


@pytest.mark.parametrize("few", [False, True])
def test_neighbours_without_a_fold_come_from_one_search(spark, rows, few, monkeypatch):
    monkeypatch.setattr(B, "SHORT", 0 if few else 500)
    # equal vectors and, in a corner, a fold that is among itself
    df = rows.where("row_id < 900").select("row_id", "label", "features", F.when(F.col("row_id") < 40, 0).otherwise(
        F.col("row_id") % 4).cast("int").alias("fold"))
    near_zero = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(spark.createDataFrame(
        [(1000 + i, 2.0, 0 if i % 30 else 1, *[50.0 + (i // 2) / 100] * 5) for i in range(60)],
        "row_id long, label double, fold int, a double, b double, c double, d double, e double")).select(df.columns)
    df = cut(df.unionByName(near_zero))
    shared = B.FoldNeighbours(df, "label", "features", 5)
    small = [r[0] for r in shared.rows.select("label").distinct().collect()]
    for fold in (None, 0, 1, 2, 3):
        rest = df if fold is None else df.where(F.col("fold") != fold)
        points = rest.where(F.col("label").isin(small)).select("label", F.col("row_id").alias("pid"), B.vector_to_array("features").alias("x"))
        want = {tuple(r) for r in knn_within_class(points, "label", 5).select("label", "pid", "nn_rank", "nn_pid").collect()}
        got = [tuple(r) for r in shared.without(fold).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_neighbours_of_scaled_folds_come_from_one_search(spark, rows):
    """Every fold scales its own way, one by far: neighbours are those of a search in the fold's own scale."""
    from flowguard.operators.prepare import PopulationScaler
    df = cut(rows.where("row_id < 900").select("row_id", "label", F.col("features").alias("plain"), F.when(
        F.col("a") > 1.2, 3).otherwise(F.col("row_id") % 3).cast("int").alias("fold")))
    scaler = PopulationScaler(inputCol="plain", outputCol="features")
    whole = scaler.fit(df)
    shared = B.FoldNeighbours(whole.transform(df), "label", "features", 5, plain="plain")
    small = [r[0] for r in shared.rows.select("label").distinct().collect()]
    for fold in (None, 0, 1, 2, 3):
        rest = df if fold is None else df.where(F.col("fold") != fold)
        own = scaler.fit(rest)
        std = own.getOrDefault(own.std)
        stretch = min(a / b for a, b in zip(whole.getOrDefault(whole.std), std))
        points = own.transform(rest).where(F.col("label").isin(small)).select(
            "label", F.col("row_id").alias("pid"), B.vector_to_array("features").alias("x"))
        want = {tuple(r) for r in knn_within_class(points, "label", 5).select("label", "pid", "nn_rank", "nn_pid").collect()}
        got = [tuple(r) for r in shared.without(fold, (range(5), own.getOrDefault(own.mean), std, stretch)).collect()]
        assert len(got) == len(set(got)) and set(got) == want
