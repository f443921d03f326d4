import math
import random

import pytest
from pyspark.sql import functions as F

from flowguard.operators import balance as B
from flowguard.operators.distribution import class_counts


def _points(spark, n_per=(60, 25), dim=4, seed=1):
    rnd = random.Random(seed)
    rows, pid = [], 0
    for ci, n in enumerate(n_per):
        for _ in range(n):
            # heavy-tailed first coordinate, like flow byte rates
            x = [rnd.lognormvariate(0, 2)] + [rnd.gauss(ci, 1) for _ in range(dim - 1)]
            rows.append((f"c{ci}", pid, x))
            pid += 1
    return rows, spark.createDataFrame(rows, "y string, pid long, x array<double>")


def test_knn_matches_brute_force(spark):
    rows, df = _points(spark)
    k = 5
    got = {}
    for r in B.knn_within_class(df, "y", k).collect():
        got.setdefault(r.pid, []).append((r.nn_rank, r.nn_pid))
    for y, pid, x in rows:
        cands = sorted((math.dist(x, x2), p2) for y2, p2, x2 in rows if y2 == y and p2 != pid)
        want = [p for _, p in cands[:k]]
        assert [p for _, p in sorted(got[pid])] == want


def test_undersample_counts(spark):
    rows = [(i, 0) for i in range(900)] + [(1000 + i, 1) for i in range(100)]
    df = spark.createDataFrame(rows, "row_id long, y int")
    out = B.undersample(df, "y", 0.333)
    c = {r.y: r.n for r in class_counts(out, "y").collect()}
    assert c == {0: int(100 / 0.333), 1: 100}


def test_undersample_refuses_high_ratio(spark):
    rows = [(i, 0) for i in range(100)] + [(1000 + i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "row_id long, y int")
    with pytest.raises(ValueError):
        B.undersample(df, "y", 0.333)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r.y: r.weight for r in B.balanced_weights(df, "y").collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}


def test_smote_counts_and_range(spark):
    rows, pts = _points(spark, (40, 13, 9))
    from pyspark.ml.functions import array_to_vector
    df = pts.select("y", F.col("pid").alias("row_id"), array_to_vector("x").alias("features"))
    out = B.smote(df, "y", k=5)
    c = {r.y: r.n for r in class_counts(out, "y").collect()}
    assert c == {"c0": 40, "c1": 40, "c2": 40}
    # synthetic points lie inside the bounding box of their class
    from pyspark.ml.functions import vector_to_array
    arr = out.withColumn("a", vector_to_array("features")).collect()
    for y in ("c1", "c2"):
        orig = [x for yy, _, x in rows if yy == y]
        lo = [min(v[i] for v in orig) for i in range(4)]
        hi = [max(v[i] for v in orig) for i in range(4)]
        for r in arr:
            if r.y == y:
                assert all(lo[i] - 1e-9 <= r.a[i] <= hi[i] + 1e-9 for i in range(4))


def test_smote_refuses_small_class(spark):
    from pyspark.ml.functions import array_to_vector
    _, pts = _points(spark, (20, 5))
    df = pts.select("y", F.col("pid").alias("row_id"), array_to_vector("x").alias("features"))
    with pytest.raises(ValueError):
        B.smote(df, "y", k=5)


def _brute(rows, k):
    want = {}
    for y, pid, x in rows:
        near = sorted((math.dist(x, x2), p2) for y2, p2, x2 in rows if y2 == y and p2 != pid)
        want[pid] = [p for _, p in near[:k]]
    return want


def _found(df, k):
    got = {}
    for r in B.knn_within_class(df, "y", k).collect():
        got.setdefault(r.pid, []).append((r.nn_rank, r.nn_pid))
    return {p: [n for _, n in sorted(v)] for p, v in got.items()}


def test_knn_over_many_blocks_and_dimensions(spark, monkeypatch):
    from flowguard.operators import neighbours as N
    monkeypatch.setattr(N, "BLOCK", 32)
    for dim, n in ((3, (400, 90)), (77, (150, 40))):
        rows, df = _points(spark, n, dim)
        assert _found(df, 5) == _brute(rows, 5)


def test_knn_with_equal_rows_and_small_classes(spark, monkeypatch):
    from flowguard.operators import neighbours as N
    monkeypatch.setattr(N, "BLOCK", 8)
    rnd = random.Random(2)
    rows = [("a", i, [float(rnd.randint(0, 3)), float(rnd.randint(0, 3))]) for i in range(120)]
    rows += [("b", 200 + i, [float(i), 0.0]) for i in range(4)] + [("c", 300, [1.0, 1.0])]
    got = _found(spark.createDataFrame(rows, "y string, pid long, x array<double>"), 5)
    want = {p: n for p, n in _brute(rows, 5).items() if n}
    assert got == want and len(got[200]) == 3 and 300 not in got


def test_knn_of_very_many_equal_rows(spark):
    df = spark.range(100_000).selectExpr("'a' AS y", "id AS pid", "array(CAST(IF(id < 99990, 0, id) AS DOUBLE)) AS x")
    near = B.knn_within_class(df, "y", 5)
    assert near.count() == 500_000
    got = {r.pid: sorted(n.nn_pid for n in near.where(F.col("pid") == r.pid).collect()) for r in
           spark.createDataFrame([(2,), (50_000,)], "pid long").collect()}
    assert got == {2: [0, 1, 3, 4, 5], 50_000: [0, 1, 2, 3, 4]}


def test_smote_k_follows_the_smallest_class():
    assert B.smote_k({"a": 90, "b": 4}) == 3 and B.smote_k({"a": 90, "b": 1}) == 1
    assert B.smote_k({"a": 90, "b": 1}, floor_one=False) == 0 and B.smote_k({"a": 90, "b": 50}) == 5


def test_ranks_by_prefixes_equal_a_plain_window(spark, monkeypatch):
    from flowguard.operators import ranking as R
    monkeypatch.setattr(R, "EXACT_RANK_LIMIT", 3)
    monkeypatch.setattr(R, "STEP_BITS", 4)
    df = spark.range(500).selectExpr("id AS row_id", "IF(id % 5 = 0, 'a', IF(id = 7, NULL, 'b')) AS y")
    got = {(r["_g"], r["_id"]): r["_rank"] for r in R.ClassRanks(df, "y", 42).ranked().collect()}
    keys = {r["row_id"]: (r["y"], r["h"]) for r in df.withColumn("h", R.hash_key(42)).collect()}
    for y in "ab":
        mine = sorted((h, i) for i, (c, h) in keys.items() if c == y)
        assert [got[y, i] for _, i in mine] == list(range(1, len(mine) + 1))
    assert len(got) == 499


def test_draws_with_replacement(spark):
    from flowguard.operators.ranking import ClassRanks
    df = spark.range(120).selectExpr("id AS row_id", "IF(id < 100, 'a', 'b') AS y")
    rows = B.draws_with_replacement(ClassRanks(df, "y", 42), {"b": 25_000, "a": 0}).collect()
    assert sorted(r.draw for r in rows) == list(range(1, 25_001))
    drawn = [r.pid for r in rows]
    assert set(drawn) == set(range(100, 120))
    assert all(25_000 / 20 * 0.85 < drawn.count(i) < 25_000 / 20 * 1.15 for i in set(drawn))


def test_smote_with_replacement_keeps_class_totals(spark):
    from pyspark.ml.functions import array_to_vector
    _, pts = _points(spark, (60, 13, 9))
    df = pts.select("y", F.col("pid").alias("row_id"), array_to_vector("x").alias("features"))
    out = B.smote(df, "y", k=5, replacement=True)
    assert {r.y: r.n for r in class_counts(out, "y").collect()} == {"c0": 60, "c1": 60, "c2": 60}
    made = out.where("synthetic AND y = 'c2'").groupBy("base_id").count().collect()
    assert sum(r["count"] for r in made) == 51 and len({r["count"] for r in made}) > 2


def _boxes(spark, n, block):
    rnd = random.Random(n)
    rows = [("a", i, [rnd.random(), rnd.random()]) for i in range(n)]
    return spark.createDataFrame(rows, "label string, gid long, x array<double>")


def test_blocks_meet_by_descending_the_tree(spark, monkeypatch):
    from flowguard.operators import neighbours as N
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "FAN", 8)     # several rounds of cuts
    met = {}
    for n in (300, 1200, 4800):
        blocks = N.blocks_of(_boxes(spark, n, 16)).withColumn("r", F.lit(0.5 / n ** 0.5)).cache()
        rows = blocks.collect()
        assert sum(r.n for r in rows) == n and max(r.n for r in rows) <= 2 * 16
        want = {(a.block, b.block) for a in rows for b in rows if a.block != b.block and sum(
            max(x - v, y - u, 0.0) ** 2 for x, u, y, v in zip(a.low, a.high, b.low, b.high, strict=True)) ** 0.5 <= a.r}
        got = [(r.block, r.other) for r in N.meetings(blocks.select("label", "leaf", "block", "low", "high", "r")).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        met[n] = len(got)
    # sixteen times as many pairs of blocks a step, but hardly more than four times as many that meet
    assert met[1200] < 7 * met[300] and met[4800] < 6 * met[1200]


def test_meetings_of_no_blocks(spark):
    from flowguard.operators import neighbours as N
    none = spark.createDataFrame([], "label string, leaf string, block string, low array<double>, high array<double>, r double")
    assert N.meetings(none).count() == 0


def test_leaves_of_points_that_are_equal_where_they_are_cut(spark, monkeypatch):
    from flowguard.operators import neighbours as N
    monkeypatch.setattr(N, "BLOCK", 8)
    df = spark.range(100).selectExpr("'a' AS label", "id AS gid", "array(0.0D, 1.0D) AS z", "array(CAST(id AS DOUBLE)) AS x")
    assert N.leaves_of(df, "z").select("leaf").distinct().count() == 1
    blocks = N.blocks_of(df, "z").collect()
    assert sum(b.n for b in blocks) == 100 and len(blocks) > 3


def test_lsh_neighbours_reach_their_recall(spark, monkeypatch):
    from flowguard.operators import neighbours as N
    monkeypatch.setattr(N, "BLOCK", 64)
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 8) for _ in range(12)] for _ in range(20)]
    rows = [(c, 10_000 * j + i, [m + rnd.gauss(0, 1) for m in rnd.choice(centres)])
            for j, (c, n) in enumerate((("a", 1500), ("b", 40))) for i in range(n)]
    df = spark.createDataFrame(rows, "y string, pid long, x array<double>")
    exact, found = B.knn_within_class(df, "y", 5), N.lsh_within_class(df, "y", 5, trees=12)
    recall = {r.y: r for r in N.neighbour_recall(found, exact, "y").collect()}
    assert recall["a"].n == 7500 and recall["a"].recall >= 0.9
    assert recall["b"].hit == recall["b"].n == 200          # one bucket: exact
    assert N.lsh_within_class(df.limit(0), "y", 5).count() == 0


def test_a_meeting_of_blocks_holds_few_of_their_distances():
    """Neighbours of one block in another as by sorting all distances (ties by id), in a few MB."""
    import tracemalloc

    import numpy as np
    from flowguard.operators import neighbours as N
    rng = np.random.default_rng(3)
    x, y = (np.round(rng.normal(size=(n, 3)), 1) for n in (1500, 2000))
    ids, other, limit = np.arange(1500) * 2, np.arange(2000) * 2 + 1, rng.uniform(0, 1, 1500)
    dist = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    for bound in (limit, None):
        tracemalloc.start()
        row, near, d = N._nearest(ids, x, other, y, 4, bound)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        want = [(i, other[j]) for i in range(1500) for j in np.argsort(dist[i], kind="stable")[:4]
                if bound is None or dist[i, j] <= bound[i]]
        assert list(zip(row, near)) == want and np.allclose(d, dist[row, near // 2])
        assert peak < 32e6, peak
