import os
import tempfile

import pytest
from pyspark.sql import functions as F

from flowguard.functions.expressions import protocol_label
from flowguard.operators import cascade as C
from flowguard.operators import metrics as M
from flowguard.operators.features import conform_lenient, conform_strict
from flowguard.plans.queries import flows_scored_raw
from tests.conftest import SF01


def test_threshold_rule_fixture(spark):
    sweep = M.threshold_sweep(flows_scored_raw(spark, SF01), "target_bin", "Unit Score")
    best = M.best_threshold(sweep).first()
    assert best.reached and abs(best.threshold - 0.66) < 1e-12
    assert sweep.where("recall >= 0.98").count() == 66
    # without the recall target another threshold would win
    assert sweep.orderBy(F.desc("f1")).first().threshold > best.threshold


def test_threshold_fallback_and_ties(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.3), (0, 0.9)], "y int, s double")
    best = M.best_threshold(M.threshold_sweep(df, "y", "s"), 0.99).first()
    # recall 1.0 holds up to 0.30 with F1 0.8 everywhere there: lowest threshold wins
    assert best.threshold == M.thresholds()[0]
    df2 = spark.createDataFrame([(1, 0.005), (0, 0.9)], "y int, s double")
    b2 = M.best_threshold(M.threshold_sweep(df2, "y", "s")).first()
    assert not b2.reached and b2.threshold == M.thresholds()[0]


def test_linspace_bits():
    import numpy as np  # noqa: F401  (only to compare with the published rule)
    assert M.thresholds() == list(np.linspace(0.01, 0.99, 99))


def test_confusion_with_predicted_only_class(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "C"), ("B", "B")], "y string, p string")
    cm = {(r.actual, r.predicted): r.n for r in M.confusion_matrix(df, "y", "p").collect()}
    assert len(cm) == 9 and cm[("A", "C")] == 1 and cm[("C", "C")] == 0
    rep = {r.label: r for r in M.classification_report(M.confusion_matrix(df, "y", "p")).collect()}
    assert rep["C"].precision == 0.0 and rep["C"].support == 0
    assert rep["accuracy"].f1 == round(2 / 3, 6)


def test_protocol_names(spark):
    vals = ["6", "17", "1", "6.0", "abc", None, "200", "6.9", "inf"]
    df = spark.createDataFrame([(v,) for v in vals], "p string")
    got = [r[0] for r in df.select(protocol_label(F.col("p"))).collect()]
    assert got == ["TCP (6)", "UDP (17)", "ICMP (1)", "TCP (6)", "abc", None, "Outro (200)", "TCP (6)", "inf"]


def test_conform(spark):
    df = spark.createDataFrame([("1.5", "abc", "x"), ("inf", "1d", "y"), (None, " 2 ", "z")],
                               "a string, b string, extra string")
    out = conform_lenient(df, ["b", "a", "missing"]).collect()
    assert [tuple(r) for r in out] == [(0.0, 1.5, 0.0), (0.0, 0.0, 0.0), (2.0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        conform_strict(df, ["a", "missing"])


def test_paging(spark):
    t = spark.range(120).withColumnRenamed("id", "row_id")
    assert [r.row_id for r in C.result_page(t, 3, 50).collect()] == list(range(100, 120))
    assert C.result_page(t, 4, 50).count() == 0
    assert C.page_count(120, 50) == 3 and C.page_count(0, 50) == 1
    assert C.page_caption(120, 3, 50) == "Exibindo 101-120 de 120 fluxos"
    with pytest.raises(ValueError):
        C.result_page(t, 1, 30)


def test_bundle_roundtrip(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from flowguard.plans.jobs import Bundle, load_bundle, save_bundle
    df = spark.createDataFrame([(1.0, 2.0)], "F1 double, F2 double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["F1", "F2"], outputCol="v")]).fit(df)
    b = Bundle(model, ["F1", "F2"], ["A", "B"], 0.4, "dt", 2)
    path = os.path.join(tempfile.mkdtemp(), "bundle")
    save_bundle(spark, b, path)
    back = load_bundle(spark, path)
    assert (back.columns, back.classes, back.threshold, back.scaler) == (["F1", "F2"], ["A", "B"], 0.4, None)
    assert back.model.transform(df).first().v.toArray().tolist() == [1.0, 2.0]


def test_holdout_missing(spark):
    from flowguard.plans.jobs import load_holdout
    with pytest.raises(FileNotFoundError):
        load_holdout(spark, os.path.join(tempfile.mkdtemp(), "nope"))


def test_kpis_and_missed(spark):
    df = spark.createDataFrame([("Ataque", "DoS", "DoS"), ("Normal", "Benign", "DoS"), ("Normal", "Benign", "Benign")],
                               "alert string, attack_type string, target_tipo string")
    k = C.alert_kpis(df).first()
    assert (k.normal, k.attacks, k.anomaly_rate_pct) == (2, 1, 33.3)
    miss = {r.family: (r.missed, r.total) for r in C.missed_attacks(df).collect()}
    assert miss == {"DoS": (1, 2), "ALL": (1, 2)}
