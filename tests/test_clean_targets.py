import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowguard.operators.clean import clean_flows, strip_column_names
from flowguard.operators.features import split_features
from flowguard.operators.targets import add_targets, unmapped_labels
from flowguard.plans.queries import flows_clean


def test_family_map(spark):
    df = spark.createDataFrame([("BENIGN",), ("DOS HULK",), ("WEB ATTACK � BRUTE FORCE",), (" SSH-PATATOR ",)],
                               "Label string")
    got = [r.target_tipo for r in add_targets(df).collect()]
    assert got == ["Benign", "DoS", "WebAttacks", "Bruteforce"]


def test_web_attack_prefix_and_tab(spark):
    df = spark.createDataFrame([("Web Attack - New",), ("\tbenign\t",)], "Label string")
    rows = add_targets(df).collect()
    assert rows[0].target_tipo == "WebAttacks"
    assert (rows[1].target_bin, rows[1].target_tipo) == (0, "Benign")


def test_unknown_label_raises(spark):
    df = spark.createDataFrame([("UNKNOWN_LABEL",)], "Label string")
    with pytest.raises(PySparkException, match="UNKNOWN_LABEL"):
        add_targets(df).collect()
    audit = unmapped_labels(df).collect()
    assert [(r.label, r.n) for r in audit] == [("UNKNOWN_LABEL", 1)]


def test_clean(spark):
    df = spark.createDataFrame([(1.0, 3.0, 5.0), (math.inf, 4.0, 6.0), (2.0, math.nan, 7.0)],
                               "` Col1 ` double, `Col2  ` double, Col3 double")
    out = clean_flows(df)
    assert out.columns == ["Col1", "Col2", "Col3"]
    rows = out.collect()
    assert len(rows) == 1 and rows[0].Col1 == 1.0


def test_name_collision(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "` a` double, `a ` double")
    with pytest.raises(ValueError):
        strip_column_names(df)


def test_targets(spark):
    df = spark.createDataFrame([("BENIGN",), ("DOS HULK",), ("PORTSCAN",)], "Label string")
    rows = add_targets(df).collect()
    assert [r.target_bin for r in rows] == [0, 1, 1]
    assert [r.target_tipo for r in rows] == ["Benign", "DoS", "PortScan"]


def test_split_features(spark):
    df = spark.createDataFrame([(1, "BENIGN", 0, "Benign", 10.0, 0.1), (2, "DOS HULK", 1, "DoS", 20.0, 0.2)],
                               "`Source IP` int, Label string, target_bin int, target_tipo string, "
                               "Feature1 double, Feature2 double")
    feats = split_features(df)
    assert feats == ["Feature1", "Feature2"]


def test_fixture_counts(spark):
    from tests.conftest import SF001, SF01
    for sf, total, benign in [(SF001, 967, 836), (SF01, 9655, 8406)]:
        df = flows_clean(spark, sf)
        assert df.count() == total
        assert df.where(F.col("target_tipo") == "Benign").count() == benign
