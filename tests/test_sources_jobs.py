"""Files, profile report, scoring job, grids, and the cascade's branches on the given tables."""
import json

import pytest
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators import cascade as C
from flowguard.operators import learn as L
from flowguard.operators import metrics as M
from flowguard.operators import sampling as SM
from flowguard.plans import jobs as J
from flowguard.plans import queries as Q
from flowguard.sources.adapters import flows_csv_from_events, flows_from_events
from flowguard.sources.files import load_flows, load_flows_reported, read_csv

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("flows")
    flows = flows_from_events(spark, SF001)
    one, two, three = (str(base / n) for n in ("one.parquet", "two.parquet", "three.csv"))
    flows.where("row_id % 2 = 0").drop("Unit Score").write.parquet(one)
    flows.where("row_id % 2 = 1").select(*reversed(flows.columns)).write.parquet(two)
    flows_csv_from_events(spark, SF001).write.option("header", True).csv(three)
    return one, two, three, str(base / "absent.parquet")


def test_files_are_stacked_by_name(spark, paths):
    flows = flows_from_events(spark, SF001)
    got = load_flows(spark, list(paths[:2]))
    assert set(got.columns) == set(flows.columns)
    assert got.where("`Unit Score` IS NULL").count() == flows.where("row_id % 2 = 0").count()
    assert got.select("row_id", "Label").exceptAll(flows.select("row_id", "Label")).count() == 0
    few = load_flows(spark, list(paths[:2]), ["Label", "Flow Duration", "Nowhere"])
    assert few.columns == ["Label", "Flow Duration", "Nowhere"] and few.where("Nowhere IS NOT NULL").count() == 0
    assert few.where("`Flow Duration` IS NULL").count() == 0


def test_unreadable_files_are_reported(spark, paths):
    df, errors = load_flows_reported(spark, [paths[0], paths[3]])
    assert df.count() > 0 and [e[0] for e in errors] == [paths[3]]
    with pytest.raises(FileNotFoundError):
        load_flows(spark, [paths[3]])


def test_many_files_of_few_schemas_are_few_scans(spark, tmp_path):
    import pandas as pd
    names = []
    for i in range(300):
        pdf = pd.DataFrame({"Label": [f"l{i}"], " Flow Duration": [float(i)]} if i % 2 else {"Label": [f"l{i}", "x"]})
        names.append(str(tmp_path / f"part {i}+a%20b.parquet"))
        pdf.to_parquet(names[-1])
    (tmp_path / "broken.parquet").write_bytes(b"no parquet")
    bad = [str(tmp_path / "broken.parquet"), str(tmp_path / "none.csv")]
    df, errors = load_flows_reported(spark, [*names, *bad], with_file=True)
    assert [p for p, _ in errors] == bad
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 4    # two scans, two tables of names
    got = {(r["file"], r["Label"], r[" Flow Duration"]) for r in df.collect()}
    assert got == ({(n, f"l{i}", float(i) if i % 2 else None) for i, n in enumerate(names)}
                   | {(n, "x", None) for n in names[::2]})
    few, _ = load_flows_reported(spark, names, ["Flow Duration"])
    assert few.columns == ["Flow Duration"] and few.count() == 450
    assert few.agg(F.sum("Flow Duration")).first()[0] == sum(range(1, 300, 2))
    twice = load_flows(spark, [names[1], names[1], names[3]], with_file=True)
    assert sorted(r["file"] for r in twice.collect()) == sorted([names[1], names[1], names[3]])


def test_csv_files_of_one_header_are_one_scan(spark, tmp_path):
    names = [str(tmp_path / f"{i}.csv") for i in range(3)]
    for i, n in enumerate(names):
        open(n, "w").write(f"Label, a\nl{i},{i}\n")
    df = load_flows(spark, names, ["Label", "a"], with_file=True)
    assert sorted(map(tuple, df.collect())) == [(f"l{i}", str(i), n) for i, n in enumerate(names)]


def test_csv_columns_are_text(spark, paths):
    assert {t for _, t in read_csv(spark, paths[2]).dtypes} == {"string"}


def test_profile_report(spark, paths, tmp_path):
    report = J.profile_files(spark, [paths[0], paths[1], paths[3]], str(tmp_path / "report"))
    rows = {(r["section"], r["column"], r["metric"]): r["value"] for r in report.collect()}
    n = flows_from_events(spark, SF001).count()
    assert rows["totals", None, "rows"] == str(n)
    assert int(rows["files", paths[0], "rows"]) + int(rows["files", paths[1], "rows"]) == n
    assert rows["errors", paths[3], "error"] == "PATH_NOT_FOUND"
    assert rows["normalisation", None, "normalised"] == "false"
    assert ("constant", "Bwd PSH Flags", "constant") in rows and int(rows["missing", None, "infs"]) > 0
    assert ("normalisation", "Total Fwd Packets", "max") in rows
    assert spark.read.json(str(tmp_path / "report")).count() == report.count()
    only = J.profile_files(spark, [paths[3]])
    assert [r["section"] for r in only.collect()] == ["errors"]


def test_scoring_job(spark, paths, tmp_path):
    t1, thr, t2 = Q.rule_trees()
    out = J.score_flows(spark, paths[2], t1, thr, t2)
    want = Q.q_alert_context(spark, SF001)
    text = lambda df: sorted(map(str, df.withColumn("row_id", F.col("row_id").cast("long")).select(want.columns).collect()))
    assert text(out) == text(want)
    read_csv(spark, paths[2]).limit(0).write.option("header", True).csv(str(tmp_path / "none.csv"))
    empty = J.score_flows(spark, str(tmp_path / "none.csv"), t1, thr, t2)
    assert empty.count() == 0


def test_sample_or_all_flows(spark, paths, tmp_path):
    sample = str(tmp_path / "sample")
    with pytest.raises(FileNotFoundError):
        J.load_sample(spark, sample)
    both = J.load_base(spark, sample, [paths[1]])
    assert {S.TARGET_BIN, S.TARGET_FAMILY} <= set(both.columns)
    audit = None
    with pytest.raises(ValueError):
        audit = J.build_sample(both, sample, 500)
    assert audit is None
    SM.stratified_sample(both.withColumn(S.ROW_ID, F.col(S.ROW_ID)), S.TARGET_BIN, 100, size_range=None).write.parquet(sample)
    assert J.load_base(spark, sample, []).count() == 100


def test_a_saved_holdout_is_used_again(spark, tmp_path):
    df = Q.flows_clean(spark, SF001)
    J.save_holdout(SM.canonical_holdout(df), str(tmp_path / "keys"))
    keys = J.load_holdout(spark, str(tmp_path / "keys"))
    assert SM.exclude_holdout(df, keys).count() + SM.holdout_rows(df, keys).count() == df.count()
    assert SM.exclude_holdout(df, keys).select(S.ROW_ID).exceptAll(SM.outside_holdout(df).select(S.ROW_ID)).count() == 0


@pytest.mark.parametrize("sf", [SF01, "/root/testdata/sf0.1"])
def test_every_branch_of_the_cascade_occurs(spark, sf):
    scored = Q.cascade_eval(spark, sf).select(S.TARGET_FAMILY, C.ALERT, C.ATTACK_TYPE).cache()
    assert {r[0] for r in scored.select(C.ALERT).distinct().collect()} == {S.ALERT_ATTACK, S.ALERT_NORMAL}
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(
        scored, S.TARGET_FAMILY, C.ATTACK_TYPE).collect()}
    assert cells["Benign", "Benign"] > 0 and cells["DDoS", "DDoS"] > 0
    missed = {r["family"]: r["missed"] for r in C.missed_attacks(scored).collect()}
    assert missed["ALL"] == sum(n for f, n in missed.items() if f != "ALL") > 0


def test_grids_are_the_published_ones():
    size = lambda stage, family: {n: len(p) for n, _, p in L.candidates(["a"], stage, family)}
    for stage in (1, 2):
        assert size(stage, "all") == {"rf": 4, "dt": 2, "lr": 3}
        assert size(stage, "interpretable") == {"dt": 9} and size(stage, "lr") == {"lr": 4}


def test_training_scores_every_point(spark):
    rest = SM.outside_holdout(Q.flows_clean(spark, SF01)).checkpoint()
    bundle, report = J.train_stage1(rest, family="dt")
    assert [json.loads(p) for _, p, _ in report["cv"]] == [{"maxDepth": 8}, {"maxDepth": 12}]
    assert all(0.8 < f1 <= 1 for *_, f1 in report["cv"]) and bundle.info["cv_f1"] == max(f for *_, f in report["cv"])
    second, more = J.train_stage2(rest, family="dt")
    assert len(more["cv"]) == 2 and second.classes == sorted(second.classes)
    scored = C.score_models(Q.holdout_eval(spark, SF01), bundle, second, C.EVALUATION)
    report = {r["label"]: r["f1"] for r in M.classification_report(
        M.confusion_matrix(scored, S.TARGET_FAMILY, C.ATTACK_TYPE)).collect()}
    assert report["Benign"] > 0.95 and report["macro avg"] > 0.7


def test_ties_of_probability_count_as_normal(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (1.0, 0.51)], "label double, prediction double")
    assert L.BinaryF1Evaluator().evaluate(df) == pytest.approx(2 / 3)


def test_pages_by_key(spark):
    table = spark.range(120).withColumnRenamed("id", "row_id")
    first = C.page_after(table, None, 50).collect()
    second = C.page_after(table, first[-1]["row_id"], 50).collect()
    assert [r["row_id"] for r in second] == [r["row_id"] for r in C.result_page(table, 2, 50).collect()]


def test_sweep_levels_are_exact_at_the_thresholds(spark):
    grid = M.thresholds()
    import math
    values = [v for t in grid for v in (t, math.nextafter(t, 0), math.nextafter(t, 1))] + [0.0, 1.0, -1.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "s double").withColumn("n", M.cleared(F.col("s"), None))
    assert all(r["n"] == sum(t <= r["s"] for t in grid) for r in df.collect())


def test_stacked_files_are_reconciled(spark, tmp_path, monkeypatch):
    from flowguard.sources import stacking
    monkeypatch.setattr(stacking, "COUNTED_AT_ONCE", 2)
    paths = []
    for i, n in enumerate((3, 5, 0, 7)):
        paths.append(str(tmp_path / f"p{i}.parquet"))
        spark.range(n).selectExpr("id AS a").coalesce(1).write.parquet(paths[-1])
    paths.append(str(tmp_path / "c.csv"))
    (tmp_path / "c.csv").write_text("a,b\n1,x\n2,y\n")
    gone, out = str(tmp_path / "gone.parquet"), str(tmp_path / "out")
    report = {r.file: r for r in stacking.stack_files(spark, [*paths, gone, paths[0]], out).collect()}
    assert [(report[p].read_rows, report[p].written_rows, report[p].matches) for p in paths] == [
        (n, n, True) for n in (3, 5, 0, 7, 2)]
    assert report[gone].matches is None and report[gone].error == "PATH_NOT_FOUND" and len(report) == 6
    # a stack that lost rows of one file and has some of a file that was never read
    written = spark.read.parquet(out).where(f"NOT (file = '{paths[3]}' AND a = '4')").unionByName(
        spark.sql("SELECT 'other' AS file"), allowMissingColumns=True)
    read = {p: report[p].read_rows for p in paths}
    again = {r.file: r for r in stacking.reconciled(spark, read, written).collect()}
    assert {p for p, r in again.items() if not r.matches} == {paths[3], "other"}
    assert again[paths[3]].written_rows == 6 and again["other"].read_rows == 0


def test_no_readable_file_is_a_report_without_a_stack(spark, tmp_path):
    from flowguard.sources.stacking import stack_files
    report = stack_files(spark, [str(tmp_path / "no.parquet")], str(tmp_path / "out")).collect()
    assert [(r.read_rows, r.written_rows, r.matches, r.error) for r in report] == [(None, None, None, "PATH_NOT_FOUND")]
    assert not (tmp_path / "out").exists()
