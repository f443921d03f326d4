"""Saved bundles as the scorer's contract, fitted preparation, searches across families, and rule text as input."""
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators import cascade as C
from flowguard.operators import learn as L
from flowguard.operators import rules as R
from flowguard.operators import sampling as SM
from flowguard.operators.prepare import (ConstantColumnModel, ConstantColumnRemover, PopulationScaler)
from flowguard.plans import jobs as J
from flowguard.plans import queries as Q
from flowguard.plans import scoring as SC
from flowguard.sources.adapters import flows_csv_from_events

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_class_index():
    assert L.class_index([0, 1], 1, 2) == 1 and L.class_index([1, 0], 1, 2) == 0
    assert L.class_index(["1", "0"], 1, 2) == 0 and L.class_index(["0", "1"], 1, 2) == 1
    assert L.class_index(["a", "b"], 1, 2) == 1 and L.class_index(None, 1, 2) == 1
    assert L.class_index(["a"], 1, 1) == 0 and L.class_index([], 1, 3, fallback=7) == 2


def bundles(spark, order):
    """Stage-1 and stage-2 bundles of a few features; ``order`` lists the classes 0 and 1 as the labels number them."""
    flows = Q.flows_clean(spark, SF001)
    feats = ["Flow Duration", "Total Fwd Packets", "Unit Score"]

    def fitted(rows, stage, classes, threshold):
        stages = [VectorAssembler(inputCols=feats, outputCol="features"), DecisionTreeClassifier(maxDepth=4)]
        return J.Bundle(Pipeline(stages=stages).fit(rows), feats, classes, threshold, "dt", stage)

    place = F.create_map(*[F.lit(float(x)) for i, c in enumerate(order) for x in (c, i)])
    one = fitted(flows.withColumn("label", place[F.col(S.TARGET_BIN).cast("double")]), 1, order, 0.4)
    attacks = flows.where("target_bin = 1")
    names = sorted(r[0] for r in attacks.select(S.TARGET_FAMILY).distinct().collect())
    index = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.lit(float(i)))])
    return one, fitted(attacks.withColumn("label", index[F.col(S.TARGET_FAMILY)]), 2, names, 0.5)


@pytest.mark.parametrize("order", [[0, 1], [1, 0], ["1", "0"]])
def test_upload_scored_by_reloaded_bundles(spark, tmp_path, order):
    one, two = bundles(spark, order)
    for name, b in (("one", one), ("two", two)):
        J.save_bundle(spark, b, str(tmp_path / name))
    again = [SC.first_bundle(spark, str(tmp_path), ["absent", name]) for name in ("one", "two")]
    assert [b.contract() for b in again] == [one.contract(), two.contract()]
    with pytest.raises(FileNotFoundError, match="absent"):
        SC.first_bundle(spark, str(tmp_path), ["absent", "gone"])
    raw = flows_csv_from_events(spark, SF001)
    got = {r[S.ROW_ID]: r for r in SC.score_upload(raw, *again, keep=[S.ROW_ID]).collect()}
    x = J.conform_lenient(J.strip_column_names(raw), one.columns, keep=[S.ROW_ID])
    want = C.score_models(x, one, two, C.DASHBOARD).collect()
    # whatever the order of the classes, the attack's probability is that of label 1
    at = [str(c) for c in order].index("1")
    p = {r[S.ROW_ID]: r["p"] for r in one.model.transform(x).select(
        S.ROW_ID, vector_to_array("probability")[at].alias("p")).collect()}
    assert len(got) == len(want) == raw.count()
    for r in want:
        g = got[r[S.ROW_ID]]
        assert [g[c] for c in C.RESULT_COLUMNS] == [r[c] for c in C.RESULT_COLUMNS]
        assert (g[C.ALERT] == S.ALERT_ATTACK) == (p[r[S.ROW_ID]] >= 0.4)
        assert (g[C.ATTACK_TYPE] == S.TYPE_NOT_APPLICABLE) == (g[C.ALERT] == S.ALERT_NORMAL) == (g[C.TYPE_CONFIDENCE] is None)
    assert {S.ALERT_ATTACK, S.ALERT_NORMAL} == {g[C.ALERT] for g in got.values()}
    assert list(SC.score_upload(raw, *again).columns)[:2] == ["Source IP", "Protocolo"]


def test_an_upload_whose_context_is_a_feature(spark):
    one, two = bundles(spark, [0, 1])
    both = [J.Bundle(PipelineModel(b.model.stages), b.columns, b.classes, b.threshold) for b in (one, two)]
    raw = spark.createDataFrame([("10", "x", "abc"), ("20", None, "2.5")], ["Destination Port", "Protocol", " Flow Duration"])
    both[0].columns = [*one.columns, "Destination Port"]
    rows = SC.score_upload(raw, *both).collect()
    assert [r["Destination Port"] for r in rows] == ["10", "20"]
    assert SC.score_upload(raw.limit(0), *both).columns == list(rows[0].asDict())
    assert SC.score_upload(raw.limit(0), *both).count() == 0


def test_constant_columns_leave_all_parts(spark, tmp_path):
    frame = lambda **cols: spark.createDataFrame(list(zip(*cols.values())), list(cols))
    train = frame(Const=[1, 1, 1], Var=[1, 2, 3])
    model = ConstantColumnRemover().fit(train)
    model.write().save(str(tmp_path / "m"))
    model = ConstantColumnModel.load(str(tmp_path / "m"))
    for part in (train, frame(Const=[1, 2, 3], Var=[4, 5, 6]), frame(Const=[9, 9, 9], Var=[7, 8, 9])):
        assert model.transform(part).columns == ["Var"]
    assert model.kept() == ["Var"]
    odd = spark.createDataFrame([(1.0, float("inf"), None, 2.0), (None, float("inf"), None, 2.0)],
                                "once double, infinite double, none double, twice double")
    assert ConstantColumnRemover().fit(odd).getOrDefault("dropped") == ["twice"]
    assert ConstantColumnRemover().fit(odd.limit(0)).kept() == odd.columns


def test_population_scaler(spark, tmp_path):
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(
        spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], ["a", "b"]))
    fitted = Pipeline(stages=[PopulationScaler(inputCol="x", outputCol="y")]).fit(rows)
    fitted.write().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    assert [list(r["y"]) for r in again.transform(rows).orderBy("a").collect()] == [[-1.0, 0.0], [1.0, 0.0]]
    with pytest.raises(ValueError):
        PopulationScaler(inputCol="x", outputCol="y").fit(rows.limit(0))


def test_a_bundle_keeps_its_remover_and_scaler(spark, tmp_path):
    rest = SM.outside_holdout(Q.flows_clean(spark, SF001)).checkpoint()
    bundle, report = J.train_stage1(rest, family="lr", folds=2, drop_constant=True)
    assert "Bwd PSH Flags" not in bundle.columns and bundle.remover.getOrDefault("dropped") == ["Bwd PSH Flags"]
    J.save_bundle(spark, bundle, str(tmp_path / "b"))
    again = J.load_bundle(spark, str(tmp_path / "b"))
    p = [[r["p_attack"] for r in J.stage1_probability(b, rest).orderBy(S.ROW_ID).collect()] for b in (bundle, again)]
    assert p[0] == p[1] and max(p[0]) > 0.5 > min(p[0])


def test_one_search_prepares_a_fold_once_for_families_prepared_alike(spark, monkeypatch):
    rest = SM.outside_holdout(Q.flows_clean(spark, SF001)).checkpoint()
    df = SM.stratified_folds(rest.withColumn(L.LABEL, F.col(S.TARGET_BIN).cast("double")), S.TARGET_BIN, 2).checkpoint()
    made = []
    prepared = L.Rebalanced.prepared
    monkeypatch.setattr(L.Rebalanced, "prepared", lambda self, d: made.append(1) or prepared(self, d))
    feats = J.split_features(rest)
    cands = [(n, st, pts[:2]) for n, st, pts in L.candidates(feats, 1, "all")]
    cands[0][1][-1].inner.setNumTrees(3)
    cands = [(n, st, pts if n != "rf" else [{st[-1].inner.maxDepth: d} for d in (2, 3)]) for n, st, pts in cands]
    (name, score, _, model), table = J._cross_validate(df, cands, L.BinaryF1Evaluator(), 2, 2)
    assert len(made) == 2 * 2 + 1            # two fronts on two folds, and the winner on all rows
    assert [n for n, _, _ in table] == ["rf", "rf", "dt", "dt", "lr", "lr"]
    assert score == max(m for *_, m in table) and name == next(n for n, _, m in table if m == score)
    assert "prediction" in model.transform(df).columns


# --- rule text ----------------------------------------------------------------------

def random_tree(leaves, classes, seed):
    rng = random.Random(seed)
    nodes = [{"id": 0, "left": -1, "right": -1}]
    while sum(n["left"] < 0 for n in nodes) < leaves:
        n = rng.choice([n for n in nodes if n["left"] < 0])
        n["left"], n["right"] = len(nodes), len(nodes) + 1
        nodes += [{"id": len(nodes) + i, "left": -1, "right": -1} for i in (0, 1)]
    for n in nodes:
        leaf = n["left"] < 0
        n |= {"feature": None if leaf else rng.choice(["Flow Bytes/s", "Idle Mean", "a <= b", "x >  1"]),
              "threshold": None if leaf else round(rng.uniform(-50, 1e6), 2), "probs": [], "count": 0,
              "value": float(rng.randrange(len(classes))) if leaf else 0.0}
    return R.RuleTree(R.CLASS, ["Flow Bytes/s", "Idle Mean", "a <= b", "x >  1"], list(classes), nodes)


@pytest.mark.parametrize("leaves, classes", [(49, ["0", "1"]), (41, ["Botnet", "DDoS", "DoS", "PortScan"]), (1, ["A"])])
def test_rule_text_loads_scores_and_is_stable(spark, tmp_path, leaves, classes):
    tree = random_tree(leaves, classes, leaves)
    R.write_rules_text(spark, tree, str(tmp_path / "t"))
    again = R.tree_from_text(spark, str(tmp_path / "t"))
    assert R.to_text(again) == R.to_text(tree) and len(again.leaves()) == leaves and again.depth() == tree.depth()
    rng = random.Random(0)
    rows = spark.createDataFrame([tuple(rng.uniform(-100, 1.1e6) for _ in tree.features) for _ in range(300)], tree.features)
    got = rows.select(R.score_columns(tree)["label"].alias("a"), R.score_columns(again)["label"].alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


def test_rule_files_are_parsed_side_by_side(spark, tmp_path):
    for i, leaves in enumerate((5, 9)):
        (tmp_path / f"{i}.txt").write_text(R.to_text(random_tree(leaves, ["a", "b"], i)))
    nodes = R.parse_rules(R.read_rules_text(spark, str(tmp_path)))
    assert sorted(r["count"] for r in nodes.where("is_leaf").groupBy("file").count().collect()) == [5, 9]


@pytest.mark.parametrize("text", ["|--- f <= 1.00\n|   |--- class: a\n", "|--- f <= x\n|   |--- class: a\n|--- f >  x\n|   |--- class: b\n",
                                  "no rule\n", "|--- class: a\n|--- class: b\n"])
def test_broken_rule_text_is_refused(spark, tmp_path, text):
    (tmp_path / "t.txt").write_text(text)
    with pytest.raises(ValueError):
        R.tree_from_text(spark, str(tmp_path / "t.txt"))


def test_probability_rules(spark, tmp_path):
    (tmp_path / "t.txt").write_text("|--- f <= 1.50\n|   |--- class: 0\n|--- f >  1.50\n|   |--- class: 1\n")
    tree = R.tree_from_text(spark, str(tmp_path / "t.txt"), R.PROBABILITY)
    rows = spark.createDataFrame([(1.0,), (2.0,)], ["f"]).select(R.score_columns(tree)["p"].alias("p")).collect()
    assert [r["p"] for r in rows] == [0.0, 1.0]


def test_compiled_trees_equal_their_models(spark):
    out = {r["stage"]: r for r in Q.q_compiled_tree_check(spark, SF01).collect()}
    assert set(out) == {1, 2} and all(r["differing"] == 0 and r["n"] > 0 for r in out.values())


# --- searches at scale ----------------------------------------------------------------

def test_folds_of_a_search_are_prepared_side_by_side(spark, monkeypatch):
    """Every fold's preparation, and that of all rows, waits here until the others have begun."""
    import threading
    rest = SM.outside_holdout(Q.flows_clean(spark, SF001)).checkpoint()
    df = SM.stratified_folds(rest.withColumn(L.LABEL, F.col(S.TARGET_BIN).cast("double")), S.TARGET_BIN, 2).checkpoint()
    all_here, prepared = threading.Barrier(3), L.Rebalanced.prepared

    def waiting(self, rows):
        all_here.wait(60)
        return prepared(self, rows)

    monkeypatch.setattr(L.Rebalanced, "prepared", waiting)
    cands = [(n, st, pts[:1]) for n, st, pts in L.candidates(J.split_features(rest), 1, "dt")]
    (_, score, _, model), table = J._cross_validate(df, cands, L.BinaryF1Evaluator(), 2, 2)
    assert len(table) == 1 and score == table[0][2] and "prediction" in model.transform(df).columns


def test_forests_keep_the_nodes_of_their_rows_and_grow_the_same_trees(spark):
    rows = [(float(i % 3 == 0), 1.0, i) for i in range(300)]
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(
        spark.createDataFrame(rows, "label double, weight double, i int").selectExpr(
            "*", "i % 7 a", "i % 11 b", "i % 13 c", "(i * 37) % 101 d")).checkpoint()
    for stage in (1, 2):
        (_, stages, _), = L.candidates(["a"], stage, "rf")
        forest = stages[-1].inner.copy({stages[-1].inner.numTrees: 4, stages[-1].inner.maxDepth: 6})
        assert forest.getCacheNodeIds()
        plain = forest.copy({forest.cacheNodeIds: False})
        assert forest.fit(df).toDebugString.split("\n", 1)[1] == plain.fit(df).toDebugString.split("\n", 1)[1]
