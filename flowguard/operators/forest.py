"""Trees and forests of a whole grid, grown side by side.

MLlib grows a forest level by level in jobs of their own, anew for every point of a grid. Here the rows are binned once (a
byte a feature, as MLlib bins them) and sent to every executor; a task grows one tree over all of them. A point of the grid
needs no tree of its own: a tree cut off at a smaller depth is the tree grown to that depth, and the first trees of a
forest are a forest. The finished trees are written as MLlib saves them and loaded as its models.

Counts are of rows by class, and weights are those of classes, so that sums are exact whatever the order of the rows. Splits,
gains, leaves and the merging of equal leaves are MLlib's; the rows and features that a forest draws differ from those
that MLlib would draw, as they do there from one partitioning of the rows to another. Single trees, which draw nothing, are
grown by MLlib to the largest depth and cut off.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.session import checkpoint_dir, cut

WHOLE = 512 << 20       # bytes of binned rows that are sent to tasks; MLlib grows the trees of larger tables
ROWS = 1 << 20          # rows that are counted at once
EPSILON = 2.220446049250313e-16
MODELS = {DecisionTreeRegressor: DecisionTreeRegressionModel, DecisionTreeClassifier: DecisionTreeClassificationModel,
          RandomForestRegressor: RandomForestRegressionModel, RandomForestClassifier: RandomForestClassificationModel}
FORESTS = (RandomForestRegressor, RandomForestClassifier)
#: Parameters a point of a grid may set; all others are those of the learner.
GRID = {"numTrees", "maxDepth", "minInstancesPerNode"}
_ONE = threading.Lock()  # one table at a time passes through the driver
NODE = ("id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
        "leftChild int, rightChild int, split struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>")


def thresholds_of(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between the bins of a feature, as MLlib finds them: between all values if they are few, else at nearly
    equal weights."""
    v, at = np.unique(values + 0.0, return_inverse=True)
    between = (v[:-1] + v[1:]) / 2
    if len(between) < bins:
        return between
    counts = np.bincount(at, weights=weights)
    stride = target = counts.sum() / bins
    out, seen = [], counts[0]
    for i in range(1, len(v)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def impurity(counts: np.ndarray, weights: np.ndarray, gini: bool) -> np.ndarray:
    """Of rows by class (the last axis): Gini's, or the variance of labels 0 and 1."""
    w = counts * weights
    total = w.sum(axis=-1)
    safe = np.where(total > 0, total, 1.0)
    if gini:
        return np.where(total > 0, 1.0 - ((w / safe[..., None]) ** 2).sum(axis=-1), 0.0)
    ones = w[..., 1]
    return np.where(total > 0, (ones - ones * ones / safe) / safe, 0.0)


def grow(x: np.ndarray, y: np.ndarray, drawn: np.ndarray | None, weights: np.ndarray, splits: np.ndarray, depth: int,
         least: int, gini: bool, tried: int, rng) -> dict:
    """A tree over binned rows ``x`` (rows x features), level by level: arrays by node, the root first, each level behind
    the one above. ``drawn`` is how often a row counts, ``splits`` the thresholds of each feature (a number),
    ``tried`` the features looked at in a node."""
    n, size = x.shape
    flat, classes, bins = x.ravel(), len(weights), max(2, int(splits.max()) + 1)
    rows = np.arange(n, dtype=np.int64) if drawn is None else np.flatnonzero(drawn)
    root = np.bincount(y[rows], weights=None if drawn is None else drawn[rows], minlength=classes)[None, :].astype(float)
    node = np.zeros(len(rows), np.int32)
    levels, here = [], root
    open_ = np.array([impurity(root, weights, gini)[0] >= EPSILON])   # nodes of this level that may be split
    for level in range(depth + 1):
        found = {"counts": here, "feature": np.full(len(here), -1, np.int32), "cut": np.zeros(len(here), np.int32),
                 "gain": np.full(len(here), -1.0)}
        levels.append(found)
        active = np.flatnonzero(open_)
        if level == depth or not len(active):
            break
        a = len(active)
        features = (np.tile(np.arange(size), (a, 1)) if tried == size else
                    np.argsort(rng.random((a, size)), axis=1)[:, :tried]).astype(np.int64)
        total, own = here[active], impurity(here[active], weights, gini)
        whole = (total * weights).sum(axis=1)
        best = np.full(a, -1.0)
        feature, cut_at, lefts = np.zeros(a, np.int64), np.zeros(a, np.int64), np.zeros((a, classes))
        for s in range(tried):
            hist = np.zeros(a * bins * classes)
            for at in range(0, len(rows), ROWS):
                r, k = rows[at:at + ROWS], node[at:at + ROWS]
                place = (k * np.int64(bins) + flat[r * size + features[k, s]]) * classes + y[r]
                hist += np.bincount(place, weights=None if drawn is None else drawn[r], minlength=len(hist))
            left = hist.reshape(a, bins, classes).cumsum(axis=1)[:, :-1]
            right = total[:, None, :] - left
            lw, rw = (left * weights).sum(axis=2), (right * weights).sum(axis=2)
            gain = (own[:, None] - lw / whole[:, None] * impurity(left, weights, gini)
                    - rw / whole[:, None] * impurity(right, weights, gini))
            bad = (left.sum(axis=2) < least) | (right.sum(axis=2) < least) | (
                np.arange(bins - 1)[None, :] >= splits[features[:, s]][:, None])
            gain[bad] = -1.0
            top = gain.argmax(axis=1)
            value = gain[np.arange(a), top]
            better = value > best
            best[better], feature[better], cut_at[better] = value[better], features[better, s], top[better]
            lefts[better] = left[np.flatnonzero(better), top[better]]
        split = best > 0
        found["feature"][active[split]], found["cut"][active[split]] = feature[split], cut_at[split]
        found["gain"][active[split]] = best[split]
        if not split.any():
            break
        below = np.empty((2 * int(split.sum()), classes))
        below[0::2], below[1::2] = lefts[split], total[split] - lefts[split]
        open_ = impurity(below, weights, gini) >= EPSILON
        first = np.full(a, -1, np.int64)
        first[split] = 2 * np.arange(int(split.sum()))
        place = np.where(open_, np.cumsum(open_) - 1, -1).astype(np.int32)
        kept_rows, kept_nodes = [], []
        for at in range(0, len(rows), ROWS):
            r, k = rows[at:at + ROWS], node[at:at + ROWS]
            child = first[k]
            going = child >= 0
            r, k, child = r[going], k[going], child[going]
            new = place[child + (flat[r * size + feature[k]] > cut_at[k])]
            kept_rows.append(r[new >= 0])
            kept_nodes.append(new[new >= 0])
        rows, node, here = np.concatenate(kept_rows), np.concatenate(kept_nodes), below
    return {"sizes": [len(f["counts"]) for f in levels], **{k: np.concatenate([f[k] for f in levels]) for k in levels[0]}}


def finished(tree: dict, depth: int, weights: np.ndarray, gini: bool) -> dict:
    """The nodes of a grown tree down to ``depth``, equal sibling leaves merged, numbered from the root down, left first."""
    bounds = np.cumsum([0, *tree["sizes"][:depth + 1]])
    n = bounds[-1]
    counts, feature = tree["counts"][:n], tree["feature"][:n].copy()
    if len(bounds) == depth + 2:
        feature[bounds[depth]:] = -1
    w = counts * weights
    value = w.argmax(axis=1).astype(float) if gini else w[:, 1] / w.sum(axis=1)
    left = np.full(n, -1, np.int64)
    for a, b in zip(bounds[:-1], bounds[1:]):      # children stand behind their level in the order of their parents
        inner = np.flatnonzero(feature[a:b] >= 0) + a
        left[inner] = b + 2 * np.arange(len(inner))
    size = np.ones(n, np.int64)
    for a, b in reversed(list(zip(bounds[:-1], bounds[1:]))):
        inner = np.flatnonzero(left[a:b] >= 0) + a
        low, high = left[inner], left[inner] + 1
        same = (left[low] < 0) & (left[high] < 0) & (value[low] == value[high])
        value[inner[same]], left[inner[same]] = value[low[same]], -1
        inner, low, high = inner[~same], low[~same], high[~same]
        size[inner] = 1 + size[low] + size[high]
    number = np.full(n, -1, np.int64)
    number[0] = 0
    for a, b in zip(bounds[:-1], bounds[1:]):
        inner = np.flatnonzero((left[a:b] >= 0) & (number[a:b] >= 0)) + a
        number[left[inner]] = number[inner] + 1
        number[left[inner] + 1] = number[inner] + 1 + size[left[inner]]
    kept = np.flatnonzero(number >= 0)
    kept = kept[np.argsort(number[kept])]
    inner = left[kept] >= 0
    return {"node": kept, "id": number[kept], "value": value[kept], "counts": counts[kept], "weighted": w[kept],
            "impurity": impurity(counts[kept], weights, gini), "gain": np.where(inner, tree["gain"][kept], -1.0),
            "left": np.where(inner, number[left[kept]], -1), "right": np.where(inner, number[left[kept] + 1], -1),
            "feature": np.where(inner, feature[kept], -1), "cut": tree["cut"][kept]}


def _saved(made: dict, head: dict, thresholds: list, gini: bool) -> pa.RecordBatch:
    """Nodes as a batch of rows as MLlib saves them, behind the columns of ``head``."""
    stats = made["weighted"] if gini else np.column_stack([made["weighted"].sum(axis=1), made["weighted"][:, 1], made["weighted"][:, 1]])
    n = len(made["id"])
    split = [{"featureIndex": int(f), "leftCategoriesOrThreshold": [float(thresholds[f][c])] if f >= 0 else [], "numCategories": -1}
             for f, c in zip(made["feature"], made["cut"])]
    columns = {**{k: pa.array(np.full(n, v, np.int32)) for k, v in head.items()},
               "id": pa.array(made["id"].astype(np.int32)), "prediction": pa.array(made["value"]),
               "impurity": pa.array(made["impurity"]), "impurityStats": pa.array(stats.tolist(), pa.list_(pa.float64())),
               "rawCount": pa.array(made["counts"].sum(axis=1).astype(np.int64)), "gain": pa.array(made["gain"]),
               "leftChild": pa.array(made["left"].astype(np.int32)), "rightChild": pa.array(made["right"].astype(np.int32)),
               "split": pa.array(split, pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                                   ("numCategories", pa.int32())]))}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def growable(inner) -> bool:
    """Whether ``fit_grid`` fits this learner: a tree, or a forest whose nodes look at the root of the features."""
    if type(inner) not in FORESTS:
        return type(inner) in MODELS
    name = lambda p: inner.getOrDefault(p)
    return (name("minInfoGain") == 0 and name("minWeightFractionPerNode") == 0 and name("maxBins") <= 256
            and name("impurity") == ("variance" if type(inner) is RandomForestRegressor else "gini")
            and name("featureSubsetStrategy") == "sqrt" and name("subsamplingRate") == 1.0 and name("bootstrap"))


def cut_off(nodes: list, depth: int) -> list[tuple]:
    """Saved nodes (by id) of a tree, as they are saved of the same tree grown to ``depth`` only."""
    out: list = []

    def leaf(i: int, prediction: float, n) -> tuple:
        return i, prediction, n["impurity"], n["impurityStats"], n["rawCount"], -1.0, -1, -1, (-1, [], -1)

    def visit(i: int, level: int) -> int:
        n, at = nodes[i], len(out)
        out.append(leaf(at, n["prediction"], n))
        if n["leftChild"] < 0 or level == depth:
            return at
        low, high = visit(n["leftChild"], level + 1), visit(n["rightChild"], level + 1)
        if out[low][6] < 0 and out[high][6] < 0 and out[low][1] == out[high][1]:
            out[at:] = [leaf(at, out[low][1], n)]
        else:
            out[at] = (*out[at][:5], n["gain"], low, high, tuple(n["split"]))
        return at

    visit(0, 0)
    return out


def _trees(df: DataFrame, inner, points: list[dict], wanted: list[dict], label: str, weight: str, features: str) -> list:
    """Single trees of MLlib: one for each number of rows a node must have, to the largest depth; others are cut off it."""
    spark, grown, models = df.sparkSession, {}, []
    named = inner.copy({inner.labelCol: label, inner.weightCol: weight, inner.featuresCol: features})
    for point, p in zip(points, wanted):
        least, point = p["minInstancesPerNode"], {inner.getParam(k): v for k, v in point.items()}
        if least not in grown:
            deepest = max(q["maxDepth"] for q in wanted if q["minInstancesPerNode"] == least)
            model = named.copy({**point, inner.maxDepth: deepest}).fit(df)
            grown[least] = deepest, model, None
        deepest, model, nodes = grown[least]
        if p["maxDepth"] == deepest:
            models.append(model)
            continue
        if nodes is None:
            path = os.path.join(checkpoint_dir(spark), "forests", uuid.uuid4().hex)
            model.write().save(path)
            nodes = sorted(spark.read.parquet(os.path.join(path, "data")).collect(), key=lambda r: r["id"])
            grown[least] = deepest, model, nodes
        gini = type(inner) is DecisionTreeClassifier
        table = spark.createDataFrame(cut_off(nodes, p["maxDepth"]), NODE).withColumns(
            {"least": F.lit(least), "depth": F.lit(p["maxDepth"]), "treeID": F.lit(0)})
        models.append(_loaded(table, inner.copy(point), p, model.numFeatures, len(nodes[0]["impurityStats"]), False, gini,
                              label, weight, features))
    return models


def _table(df: DataFrame, label: str, weight: str, features: str, bins: int, seed: int, gini: bool):
    """(bytes of the binned rows, class weights, thresholds of each feature), or None if tasks cannot hold the rows or
    these are not as trees here need them: whole labels from 0 (0 and 1 for a variance), one weight a class."""
    x = vector_to_array(F.col(features))
    by = df.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min(weight).alias("lo"), F.max(weight).alias("hi"),
                                                 F.max(F.size(x)).alias("d")).collect()
    labels = [r["y"] for r in by]
    if not by or any(y is None or y < 0 or y != int(y) or y > 99 for y in labels) or any(r["lo"] != r["hi"] or r["lo"] is None for r in by):
        return None
    classes, n, size = int(max(labels)) + 1 if gini else 2, sum(r["n"] for r in by), by[0]["d"]
    if max(labels) >= classes or n * (size + 1) > WHOLE:
        return None
    weights = np.zeros(classes)
    for r in by:
        weights[int(r["y"])] = r["lo"]
    bins = min(bins, n)
    share = min(1.0, max(bins * bins, 10_000) / n)
    part = df if share >= 1.0 else df.sample(False, share, seed)
    drawn = part.select(F.col(weight).cast("double").alias("w"), x.alias("x")).toArrow()
    values = drawn.column("x").combine_chunks().flatten().to_numpy().reshape(-1, size)
    thresholds = [thresholds_of(values[:, j], drawn.column("w").to_numpy(), bins) for j in range(size)]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = batch.column(1).flatten().to_numpy().reshape(-1, size)
                out = np.empty((len(v), size + 1), np.uint8)
                out[:, 0] = batch.column(0).to_numpy()
                for j, t in enumerate(thresholds):
                    out[:, j + 1] = np.searchsorted(t, v[:, j])
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["block"])

    blocks = df.select(F.col(label).cast("double").alias("y"), x.alias("x")).mapInArrow(binned, "block binary").collect()
    return b"".join(r["block"] for r in blocks), weights, thresholds


def fit_grid(df: DataFrame, inner, points: list[dict], label: str, weight: str, features: str) -> list | None:
    """A model of ``inner`` for each of ``points`` (parameter name -> value), or None where they are to be fitted one by one:
    see ``growable`` and ``_table``. ``df`` is persisted."""
    if not growable(inner) or any(set(p) - GRID for p in points):
        return None
    spark, kind = df.sparkSession, type(inner)
    wanted = [{k: p.get(k, inner.getOrDefault(k)) if inner.hasParam(k) else 1 for k in GRID} for p in points]
    if kind not in FORESTS:
        return _trees(df, inner, points, wanted, label, weight, features)
    gini, seed = kind is RandomForestClassifier, inner.getOrDefault("seed")
    with _ONE:
        table = _table(df, label, weight, features, inner.getOrDefault("maxBins"), seed, gini)
        if table is None:
            return None
        data, weights, thresholds = table
        sent = spark.sparkContext.broadcast(data)
        del table, data
    size = len(thresholds)
    splits = np.array([len(t) for t in thresholds])
    # one tree for each number of rows a node must have; all depths come from the deepest
    most = {}
    for p in wanted:
        trees, depths = most.get(p["minInstancesPerNode"], (0, set()))
        most[p["minInstancesPerNode"]] = max(trees, p["numTrees"]), depths | {p["maxDepth"]}
    tasks = [(least, tree, tuple(sorted(depths)), trees) for least, (trees, depths) in sorted(most.items()) for tree in range(trees)]
    tried = min(size, int(np.ceil(np.sqrt(size)))) if max(p["numTrees"] for p in wanted) > 1 else size

    def one_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                least, tree, depths, trees = tasks[i]
                rows = np.frombuffer(sent.value, np.uint8).reshape(-1, size + 1)
                rng = np.random.default_rng([seed % (1 << 63), tree])
                drawn = None
                if trees > 1:
                    drawn = np.empty(len(rows), np.uint8)
                    for at in range(0, len(rows), ROWS):
                        drawn[at:at + ROWS] = rng.poisson(1.0, len(drawn[at:at + ROWS]))
                grown = grow(np.ascontiguousarray(rows[:, 1:]), np.ascontiguousarray(rows[:, 0]), drawn, weights, splits, depths[-1],
                             least, gini, tried, rng)
                for depth in depths:
                    yield _saved(finished(grown, depth, weights, gini),
                                 {"least": least, "depth": depth, "treeID": tree}, thresholds, gini)

    nodes = cut(spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(one_tree, f"least int, depth int, treeID int, {NODE}"))
    sent.destroy()
    return [_loaded(nodes, inner.copy({inner.getParam(k): v for k, v in point.items()}), p, size, len(weights), True, gini,
                    label, weight, features) for point, p in zip(points, wanted)]


def _loaded(nodes: DataFrame, inner, p: dict, size: int, classes: int, forest: bool, gini: bool, label: str, weight: str,
            features: str):
    """The model of MLlib of the nodes that belong to a point."""
    spark = nodes.sparkSession
    path = os.path.join(checkpoint_dir(spark), "forests", uuid.uuid4().hex)
    inner = inner.copy({inner.labelCol: label, inner.weightCol: weight, inner.featuresCol: features})
    model, package = MODELS[type(inner)], "classification" if gini else "regression"
    extra = {"numFeatures": size, **({"numClasses": classes} if gini else {})}

    def described(instance, name: str, more: dict) -> str:
        told = json.loads(DefaultParamsWriter._get_metadata_to_save(instance, spark.sparkContext, more))
        return json.dumps({**told, "class": f"org.apache.spark.ml.{package}.{name}"})

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(os.path.join(path, name))

    mine = nodes.where((F.col("least") == p["minInstancesPerNode"]) & (F.col("depth") == p["maxDepth"])).drop("least", "depth")
    if forest:
        extra["numTrees"] = p["numTrees"]
        single = (DecisionTreeClassifier if gini else DecisionTreeRegressor)(
            maxDepth=p["maxDepth"], maxBins=inner.getOrDefault("maxBins"), seed=inner.getOrDefault("seed"), labelCol=label,
            featuresCol=features, weightCol=weight, minInstancesPerNode=p["minInstancesPerNode"])
        one = MODELS[type(single)].__name__
        told = [(i, json.dumps({**json.loads(described(single, one, extra)), "uid": f"{single.uid}_{i}"}), 1.0)
                for i in range(p["numTrees"])]
        write(spark.createDataFrame(told, "_1 int, _2 string, _3 double").coalesce(1), "treesMetadata")
        write(mine.where(F.col("treeID") < p["numTrees"]).select(
            "treeID", F.struct(*[c for c in mine.columns if c != "treeID"]).alias("nodeData")).coalesce(1), "data")
    else:
        write(mine.drop("treeID").coalesce(1), "data")
    spark.createDataFrame([(described(inner, model.__name__, extra),)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "metadata"))
    return model.load(path)
