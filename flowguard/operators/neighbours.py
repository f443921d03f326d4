"""k nearest neighbours within a class, block against block.

Equal vectors are one point with its least row ids, so n identical rows are
never paired.  Points of a class are cut into the leaves of a k-d tree, which
grows in rounds: each round samples the leaves that are still too large, finds
their cut values in a task a leaf, and deals their points to the new leaves.
A point's k-th distance within its own leaf bounds the search.  Leaves that may
hold something nearer are found by descending the tree in pairs: a pair of
parents is opened only if their bounding boxes are near enough.  Distances are
computed in numpy, block by block; Spark deals the blocks and gathers the
nearest.

``knn_within_class`` is exact.  ``lsh_within_class`` looks only into the leaves
of several trees over Gaussian (2-stable) projections, for vectors of so many
dimensions that boxes overlap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.operators.joins import bounded_broadcast
from flowguard.session import cut

BLOCK = 2048            # points of a block, at most about; its distances to another are one array
FAN, CUT_SAMPLE = 256, 16_384   # parts of a leaf in one round, and points of it that their cut values come from
TREES_SENT = 10_000     # cut tables (about 4 KB each) that are broadcast; more are joined
ROWS = 256              # points of a block whose distances to another block are held at once
STEP = 3                # levels of the tree that a pair of boxes descends at once
PROJECTIONS = 8         # of a tree of lsh_within_class


def _splits(points: np.ndarray, leaves: int, at: int, dims: np.ndarray, cuts: np.ndarray) -> None:
    """Cut dimensions and values of a k-d tree, at the heap places of its inner nodes (1: the root)."""
    if leaves < 2 or len(points) < 2:
        return
    spread = points.max(axis=0) - points.min(axis=0)
    dim = int(spread.argmax())
    if not spread[dim] > 0:
        return
    x = points[:, dim]
    value = np.median(x)
    if value == x.max():
        value = x[x < value].max()
    dims[at], cuts[at] = dim, value
    low = x <= value
    _splits(points[low], leaves - leaves // 2, 2 * at, dims, cuts)
    _splits(points[~low], leaves // 2, 2 * at + 1, dims, cuts)


def leaves_of(points: DataFrame, by: str = "x") -> DataFrame:
    """``points`` (label, gid, ...) with ``leaf``: the path (a text of 0 and 1) to their leaf of the class's k-d tree over
    the array column ``by``. Leaves hold about BLOCK points at most, unless all their points are equal in ``by``."""
    kind = points.schema["label"].dataType.simpleString()
    levels = math.ceil(math.log2(FAN))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        dims, cuts = np.full(1 << levels, -1, np.int32), np.zeros(1 << levels)
        parts = min(FAN, -(-2 * int(pdf["n"].iloc[0]) // BLOCK))
        _splits(np.array(pdf[by].tolist(), np.float64), parts, 1, dims, cuts)
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "leaf": pdf["leaf"].iloc[:1],
                             "dims": [dims], "cuts": [cuts]})[:1 if dims[1] >= 0 else 0]

    # a place is doubled, and one is added above the cut, until there is no cut
    down = F.expr(f"""aggregate(sequence(1, {levels}), 1, (i, _) -> CASE
        WHEN i >= {1 << levels} OR get(dims, i) < 0 THEN i WHEN get({by}, get(dims, i)) <= get(cuts, i) THEN 2 * i
        ELSE 2 * i + 1 END)""")
    placed, turn = points.withColumn("leaf", F.lit("")), 0
    while True:
        big = placed.groupBy("label", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
        drawn = placed.select("label", "leaf", "gid", by).join(bounded_broadcast(cut(big)), ["label", "leaf"]).where(
            F.pmod(F.xxhash64("gid", F.lit(turn)), F.lit(1 << 30)) * F.col("n") < F.lit(CUT_SAMPLE << 30))
        trees = cut(drawn.groupBy("label", "leaf").applyInPandas(
            tree, f"label {kind}, leaf string, dims array<int>, cuts array<double>"))
        if trees.isEmpty():
            return placed
        placed = cut(placed.join(bounded_broadcast(trees, TREES_SENT), ["label", "leaf"], "left").withColumn(
            "leaf", F.when(F.col("dims").isNull(), F.col("leaf")).otherwise(
                F.concat("leaf", F.substring(F.bin(down), 2, 64)))).select(*points.columns, "leaf"))
        turn += 1


def distinct_points(points: DataFrame, label: str, pid: str, vec: str, k: int) -> DataFrame:
    """(label, gid, x, ids): one row per distinct vector of a class; ids are its k + 1 least row ids, gid the least.

    A vector's rows are thinned to k + 1 in salted parts before they meet.
    """
    part = F.pmod(F.xxhash64(pid), F.lit(64))
    rows = points.select(F.col(label).alias("label"), F.col(pid).cast("long").alias("pid"), F.col(vec).alias("x"),
                         part.alias("part"))
    for by in (["label", "x", "part"], ["label", "x"]):
        rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("pid"))).where(F.col("n") <= k + 1)
    return rows.groupBy("label", "x").agg(F.array_sort(F.collect_list("pid")).alias("ids")).withColumn("gid", F.col("ids")[0])


def blocks_of(points: DataFrame, by: str = "x") -> DataFrame:
    """(label, leaf, block, ids, n, xs, low, high): blocks of points with their bounding boxes; ids and xs are packed."""
    placed = leaves_of(points, by)
    per = placed.groupBy("label", "leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * BLOCK)).alias("parts"))
    placed = placed.join(per, ["label", "leaf"]).withColumn("part", F.pmod(F.xxhash64("gid"), F.col("parts")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("gid")
        x = np.array(pdf["x"].tolist(), np.float64)
        first = pdf.iloc[0]
        return pd.DataFrame({"label": [first["label"]], "leaf": [first["leaf"]],
                             "block": [f"{first['leaf']}.{first['part']}"], "n": [len(pdf)],
                             "ids": [pdf["gid"].to_numpy(np.int64).tobytes()], "xs": [x.tobytes()],
                             "low": [x.min(axis=0)], "high": [x.max(axis=0)]})

    kind = points.schema["label"].dataType.simpleString()
    return placed.groupBy("label", "leaf", "part").applyInPandas(
        pack, f"label {kind}, leaf string, block string, n long, ids binary, xs binary, low array<double>, high array<double>")


def _nearest(ids: np.ndarray, x: np.ndarray, other: np.ndarray, y: np.ndarray, k: int, limit: np.ndarray | None):
    """(row of x, id, distance) of up to k nearest points of y for each of x, equal distances by id; not itself, and
    none beyond ``limit``. ROWS points of x at once; only distances that may be among the k are put in order."""
    _, self_x, self_y = np.intersect1d(ids, other, return_indices=True)
    found = []
    for at in range(0, len(x), ROWS):
        part = x[at:at + ROWS]
        dist, step = np.zeros((len(part), len(y))), np.empty((len(part), len(y)))
        for j in range(x.shape[1]):
            np.subtract(part[:, j, None], y[None, :, j], out=step)
            np.multiply(step, step, out=step)
            dist += step
        np.sqrt(dist, out=dist)
        here = (self_x >= at) & (self_x < at + ROWS)
        dist[self_x[here] - at, self_y[here]] = np.inf
        near = np.isfinite(dist) if limit is None else dist <= limit[at:at + ROWS, None]
        many = np.flatnonzero(near.sum(axis=1) > k)
        if len(many):   # none beyond the k-th distance of its row; equals of it stay until they are put in order
            near[many] &= dist[many] <= np.partition(dist[many], k - 1, axis=1)[:, k - 1, None]
        row, col = np.nonzero(near)
        order = np.lexsort((col, dist[row, col], row))    # ids rise within a block, so ties are by id
        row, col = row[order], col[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, col = row[first], col[first]
        found.append((row + at, other[col], dist[row, col]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _arrays(ids: bytes, xs: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(xs, np.float64).reshape(len(i), -1)


def _within(blocks: DataFrame, k: int) -> DataFrame:
    """(label, block, gid, near, dist): up to k nearest points of every point in its own block."""
    kind = blocks.schema["label"].dataType.simpleString()

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                i, x = _arrays(r.ids, r.xs)
                row, near, dist = _nearest(i, x, i, x, k, None)
                yield pd.DataFrame({"label": r.label, "block": r.block, "gid": i[row], "near": near, "dist": dist})

    return blocks.select("label", "block", "ids", "xs").mapInPandas(
        own, f"label {kind}, block string, gid long, near long, dist double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """(label, gid, near) of (label, gid, near, dist): the k nearest, equal distances by id."""
    w = Window.partitionBy("label", "gid").orderBy("dist", "near")
    return (found.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).groupBy("label", "gid")
            .agg(F.array_sort(F.collect_list(F.struct("dist", F.col("near").alias("gid")))).alias("near")))


def meetings(boxes: DataFrame) -> DataFrame:
    """(label, block, other) of blocks of a class whose boxes are no further apart than the reach ``r`` of the first.

    ``boxes`` is (label, leaf, block, low, high, r). Both sides descend the tree of leaves STEP levels at once from the
    whole class; only pairs of nodes that are near enough, by the largest reach below the first, are opened.
    """
    about = boxes.agg(F.max(F.length("leaf")), F.max(F.size("low"))).first()
    if about[0] is None:
        return boxes.select("label", "block", F.col("block").alias("other"))
    depth, size = about
    gap = F.sqrt(F.aggregate(F.zip_with(
        F.zip_with("low", "ohigh", lambda a, b: F.greatest(a - b, F.lit(0.0))),
        F.zip_with("olow", "high", lambda a, b: F.greatest(a - b, F.lit(0.0))),
        lambda a, b: F.greatest(a, b)), F.lit(0.0), lambda s, g: s + g * g))
    # nodes by level, the blocks last; a leaf above a level stands for itself there
    at = {depth + 1: boxes.select("label", "leaf", F.col("block").alias("node"), "low", "high", "r")}
    tops = list(range(STEP, depth, STEP))
    for level in reversed(tops):
        below = at[min(x for x in at)]
        at[level] = cut(below.groupBy("label", F.substring("leaf", 1, level).alias("leaf")).agg(
            F.array(*[F.min(F.col("low")[j]) for j in range(size)]).alias("low"),
            F.array(*[F.max(F.col("high")[j]) for j in range(size)]).alias("high"), F.max("r").alias("r")
        ).withColumn("node", F.col("leaf")))
    pairs = boxes.select("label").distinct().select("label", F.lit("").alias("up"), F.lit("").alias("oup"))
    above = 0
    for level in sorted(at):
        nodes = at[level].withColumn("up", F.substring("leaf", 1, above))
        others = nodes.select("label", F.col("up").alias("oup"), F.col("node").alias("other"), F.col("leaf").alias("oleaf"),
                              F.col("low").alias("olow"), F.col("high").alias("ohigh"))
        near = pairs.join(nodes, ["label", "up"]).join(others, ["label", "oup"]).where(gap * F.lit(1 - 1e-12) <= F.col("r"))
        pairs = near.select("label", F.col("node").alias("up"), F.col("other").alias("oup"))
        above = level
    return pairs.select("label", F.col("up").alias("block"), F.col("oup").alias("other")).where("block != other")


def nearest_points(points: DataFrame, k: int) -> DataFrame:
    """(label, gid, near): the k nearest other distinct points of a class, as structs (dist, gid); fewer in a class of
    fewer points."""
    kind = points.schema["label"].dataType.simpleString()
    blocks = cut(blocks_of(points))

    inner = cut(_within(blocks, k))
    # the k-th distance of each point so far; without k points yet it is unbounded
    bound = inner.groupBy("label", "block", "gid").agg(F.max("dist").alias("d"), F.count(F.lit(1)).alias("m")).select(
        "label", "block", "gid", F.when(F.col("m") >= k, F.col("d")).otherwise(F.lit(float("inf"))).alias("d"))
    reach = (blocks.select("label", "block", "n").join(
        bound.groupBy("label", "block").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("seen"), F.collect_list(
            F.struct("gid", "d")).alias("bounds")), ["label", "block"], "left")
        # as two plain arrays, which reach Python as such and not as an object a point
        .select("*", F.col("bounds.gid").alias("bound_of"), F.col("bounds.d").alias("bound")).drop("bounds")
        .withColumn("r", F.when(F.col("seen") < F.col("n"), F.lit(float("inf"))).otherwise(
            F.coalesce("r", F.lit(float("inf"))))))
    met = meetings(cut(blocks.select("label", "leaf", "block", "low", "high").join(
        reach.select("label", "block", "r"), ["label", "block"])))
    work = (met.join(blocks.select("label", F.col("block").alias("other"), F.col("ids").alias("oids"), F.col("xs").alias("oxs")),
                     ["label", "other"])
            .join(blocks.select("label", "block", "ids", "xs").join(reach.select("label", "block", "bound_of", "bound"),
                                                                     ["label", "block"]), ["label", "block"]))

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                i, x = _arrays(r.ids, r.xs)
                j, y = _arrays(r.oids, r.oxs)
                limit = np.full(len(i), np.inf)
                if r.bound_of is not None:
                    limit[np.searchsorted(i, r.bound_of)] = r.bound
                row, near, dist = _nearest(i, x, j, y, k, limit)
                yield pd.DataFrame({"label": r.label, "gid": i[row], "near": near, "dist": dist})

    outer = work.mapInPandas(across, f"label {kind}, gid long, near long, dist double")
    both = inner.select("label", "gid", "near", "dist").unionByName(outer.where("dist < double('infinity')"))
    return _best(both, k)


def projected_points(points: DataFrame, k: int, trees: int, seed: int = 42) -> DataFrame:
    """(label, gid, near) as nearest_points gives them, among the points that share a leaf of one of ``trees`` k-d trees, each
    over PROJECTIONS Gaussian projections of its own of the vectors."""
    first = points.select(F.size("x").alias("d")).first()
    size, parts = 0 if first is None else first["d"], []
    for turn in range(trees):
        drawn = np.random.default_rng([seed, turn]).standard_normal((PROJECTIONS, size))
        lines = F.array(*[F.array(*[F.lit(float(v)) for v in line]) for line in drawn])
        z = F.transform(lines, lambda line: F.aggregate(F.zip_with("x", line, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
        parts.append(cut(_within(blocks_of(points.withColumn("z", z), "z"), k).select("label", "gid", "near", "dist")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return _best(found.distinct(), k)


def knn_within_class(points: DataFrame, label: str, k: int, pid: str = "pid", vec: str = "x") -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by id) of every row among the rows of its own class.

    ``points`` has ``label``, ``pid`` (a whole number, unique) and an array<double> ``vec``.  Returns
    ``(label, pid, nn_rank, nn_pid, dist)``; a class of m <= k rows gives each its m - 1 others.
    """
    groups = cut(distinct_points(points, label, pid, vec, k))
    return _rows_of(points, groups, nearest_points(groups.select("label", "gid", "x"), k), label, k, pid, vec)


def lsh_within_class(points: DataFrame, label: str, k: int, pid: str = "pid", vec: str = "x", trees: int = 8,
                     seed: int = 42) -> DataFrame:
    """As knn_within_class, from candidates only: rows that fall into one bucket of at least one of ``trees`` sets of
    random projections. A class of up to BLOCK distinct vectors is one bucket, hence exact. The work grows with the
    rows, not with the dimensions; more trees find more of the true neighbours (measure with neighbour_recall)."""
    groups = cut(distinct_points(points, label, pid, vec, k))
    near = projected_points(groups.select("label", "gid", "x"), k, trees, seed)
    return _rows_of(points, groups, near, label, k, pid, vec)


def neighbour_recall(found: DataFrame, exact: DataFrame, label: str, pid: str = "pid") -> DataFrame:
    """(label, n, hit, recall): neighbours of ``exact`` for each class and how many of them are as near in ``found``: those
    no further than the last true one count, so that ties do."""
    keys = [label, pid, "nn_rank"]
    both = exact.select(*keys, F.col("dist").alias("_true")).join(found.select(*keys, "dist"), keys, "left")
    last = both.groupBy(label, pid).agg(F.array_sort(F.collect_list("_true")).alias("t"),
                                        F.collect_list("dist").alias("f"))
    hit = F.size(F.filter("f", lambda d: d <= F.element_at("t", -1)))
    return last.groupBy(label).agg(F.sum(F.size("t")).alias("n"), F.sum(hit).cast("long").alias("hit")).withColumn(
        "n", F.col("n").cast("long")).withColumn("recall", F.col("hit") / F.col("n"))


def _rows_of(points: DataFrame, groups: DataFrame, near: DataFrame, label: str, k: int, pid: str, vec: str) -> DataFrame:
    """Neighbours of rows from those of distinct points."""
    # candidates of a point: its own rows, and those of its k nearest points
    other = (near.select("label", "gid", F.explode("near").alias("e"))
             .select("label", F.col("gid").alias("of"), F.col("e.dist").alias("dist"), F.col("e.gid").alias("gid"))
             .join(groups.select("label", "gid", "ids"), ["label", "gid"]))
    own = groups.select("label", F.col("gid").alias("of"), F.lit(0.0).alias("dist"), "ids")
    rows = own.unionByName(other.select("label", "of", "dist", "ids")).select(
        "label", "of", "dist", F.explode("ids").alias("nn_pid"))
    first = (rows.withColumn("n", F.row_number().over(Window.partitionBy("label", "of").orderBy("dist", "nn_pid")))
             .where(F.col("n") <= k + 1).groupBy("label", "of")
             .agg(F.array_sort(F.collect_list(F.struct("n", "nn_pid", "dist"))).alias("list")))
    lists = groups.select("label", "gid", "x").join(first.withColumnRenamed("of", "gid"), ["label", "gid"]).select(
        "label", "x", "list")
    mine = points.select(F.col(label).alias("label"), F.col(pid).alias("pid"), F.col(vec).alias("x"))
    best = F.slice(F.filter("list", lambda e: e["nn_pid"] != F.col("pid")), 1, k)
    return (mine.join(lists, ["label", "x"]).select("label", "pid", F.posexplode(best).alias("i", "e"))
            .select(F.col("label").alias(label), "pid", (F.col("i") + 1).cast("int").alias("nn_rank"),
                    F.col("e.nn_pid").alias("nn_pid"), F.col("e.dist").alias("dist")).withColumnRenamed("pid", pid))
