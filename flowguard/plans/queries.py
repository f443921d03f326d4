"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They read the driver tables through the flow adapters and run the library's
operators over the whole input.  Column names match ``plans/oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowguard import schema as S
from flowguard.operators.clean import clean_flows
from flowguard.operators.distribution import class_distribution
from flowguard.operators.targets import add_targets, unmapped_labels
from flowguard.session import checkpoint_dir, cut
from flowguard.sources.adapters import flows_from_events
from flowguard.sources.stacking import stack_files

STACKED = ("events", "orders", "lineitem", "customer")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def flows_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned flows with both targets."""
    return add_targets(clean_flows(flows_from_events(spark, sf_dir)))


@register("class_distribution")
def q_class_distribution(spark, sf_dir):
    return class_distribution(flows_clean(spark, sf_dir), S.TARGET_FAMILY)


@register("unmapped_labels")
def q_unmapped_labels(spark, sf_dir):
    return unmapped_labels(flows_from_events(spark, sf_dir))


# --- sampling -----------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from flowguard.operators import sampling as SM  # noqa: E402


def holdout_keys(spark, sf_dir):
    return SM.canonical_holdout(flows_clean(spark, sf_dir))


def stage1_parts(spark, sf_dir):
    """Rows outside the holdout, split 70/15/15 by the binary target."""
    return SM.three_way_split(SM.outside_holdout(flows_clean(spark, sf_dir)), S.TARGET_BIN)


@register("stratified_split_rows")
def q_split_rows(spark, sf_dir):
    return SM.three_way_split(flows_clean(spark, sf_dir), S.TARGET_FAMILY).select(S.ROW_ID, S.TARGET_FAMILY, SM.PART)


@register("stratified_split_counts")
def q_split_counts(spark, sf_dir):
    parts = SM.three_way_split(flows_clean(spark, sf_dir), S.TARGET_FAMILY)
    return parts.groupBy(SM.PART, S.TARGET_FAMILY).agg(F.count(F.lit(1)).alias("n"))


@register("sample_audit")
def q_sample_audit(spark, sf_dir):
    """A 10 % exact stratified sample of the cleaned flows, audited per class."""
    df = flows_clean(spark, sf_dir)
    sample = SM.stratified_sample(df, S.TARGET_FAMILY, 0.10)
    return SM.sample_audit(df, sample, S.TARGET_FAMILY)


@register("canonical_holdout_rows")
def q_holdout_rows(spark, sf_dir):
    return holdout_keys(spark, sf_dir)


@register("train_without_holdout")
def q_train_without_holdout(spark, sf_dir):
    return SM.outside_holdout(flows_clean(spark, sf_dir)).select(S.ROW_ID, S.TARGET_FAMILY)


@register("holdout_class_counts")
def q_holdout_class_counts(spark, sf_dir):
    """The holdout as its keys, persisted, joined back to the table that another job reads."""
    df = flows_clean(spark, sf_dir)
    keys = cut(SM.canonical_holdout(df))
    return SM.holdout_rows(df, keys).groupBy(S.TARGET_FAMILY).agg(F.count(F.lit(1)).alias("n"))


@register("stratified_folds")
def q_folds(spark, sf_dir):
    """5 stratified folds over the stage-1 training part."""
    train = stage1_parts(spark, sf_dir).where(F.col(SM.PART) == "train")
    return SM.stratified_folds(train, S.TARGET_BIN).select(S.ROW_ID, S.TARGET_BIN, "fold")


@register("rare_class_filter")
def q_rare_class_filter(spark, sf_dir):
    """Attack rows outside the holdout whose family has >= 10 rows."""
    attacks = SM.outside_holdout(flows_clean(spark, sf_dir)).where(F.col(S.TARGET_BIN) == 1)
    return SM.drop_rare_classes(attacks, S.TARGET_FAMILY, S.MIN_CLASS_SIZE).groupBy(
        S.TARGET_FAMILY).agg(F.count(F.lit(1)).alias("n"))


# --- rule trees, cascade, reports ------------------------------------------------

import os  # noqa: E402

from flowguard.operators import cascade as C  # noqa: E402
from flowguard.operators import metrics as M  # noqa: E402
from flowguard.operators import rules as R  # noqa: E402
from flowguard.operators.clean import strip_column_names  # noqa: E402
from flowguard.operators.features import conform_lenient  # noqa: E402
from flowguard.sources.adapters import flows_csv_from_events  # noqa: E402

RESOURCES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "resources")


def rule_trees() -> tuple[R.RuleTree, float, R.RuleTree]:
    """The exported interpretable trees (stage 1 with its threshold, stage 2)."""
    t1 = R.RuleTree.load(os.path.join(RESOURCES, "rules_stage1.json"))
    t2 = R.RuleTree.load(os.path.join(RESOURCES, "rules_stage2.json"))
    with open(os.path.join(RESOURCES, "rules_stage1.threshold")) as f:
        thr = float(f.read().strip())
    return t1, thr, t2


def model_columns(t1: R.RuleTree, t2: R.RuleTree) -> list[str]:
    cols = list(t1.features)
    return cols + [c for c in t2.features if c not in cols]


def holdout_eval(spark, sf_dir):
    """Holdout rows of the cleaned flows, singleton classes removed."""
    return C.drop_singleton_classes(SM.inside_holdout(flows_clean(spark, sf_dir)))


def cascade_eval(spark, sf_dir):
    t1, thr, t2 = rule_trees()
    return C.score_rules(holdout_eval(spark, sf_dir), t1, thr, t2, C.EVALUATION)


def csv_scored(spark, sf_dir):
    """Uploaded-CSV scoring: names stripped, lenient conform, dashboard cascade."""
    t1, thr, t2 = rule_trees()
    raw = strip_column_names(flows_csv_from_events(spark, sf_dir))
    keep = [c for c in [S.ROW_ID] + S.CONTEXT_COLUMNS if c in raw.columns]
    x = conform_lenient(raw, model_columns(t1, t2), keep=keep)
    return C.score_rules(x, t1, thr, t2, C.DASHBOARD)


@register("rule_tree_score")
def q_rule_tree_score(spark, sf_dir):
    t1, _, _ = rule_trees()
    df = flows_clean(spark, sf_dir)
    return df.select(S.ROW_ID, R.leaf_expr(t1).alias("leaf"), R.score_columns(t1)["p"].alias("p_attack"))


@register("cascade_score")
def q_cascade_score(spark, sf_dir):
    return cascade_eval(spark, sf_dir).select(S.ROW_ID, S.TARGET_FAMILY, *C.RESULT_COLUMNS, C.P_ATTACK)


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(cascade_eval(spark, sf_dir), S.TARGET_FAMILY, C.ATTACK_TYPE)


@register("classification_report")
def q_classification_report(spark, sf_dir):
    cm = M.confusion_matrix(cascade_eval(spark, sf_dir), S.TARGET_FAMILY, C.ATTACK_TYPE)
    return M.classification_report(cm)


@register("missed_attacks")
def q_missed_attacks(spark, sf_dir):
    return C.missed_attacks(cascade_eval(spark, sf_dir))


@register("alert_kpis")
def q_alert_kpis(spark, sf_dir):
    return C.alert_kpis(csv_scored(spark, sf_dir))


@register("alert_distribution")
def q_alert_distribution(spark, sf_dir):
    return C.alert_distribution(csv_scored(spark, sf_dir))


@register("attack_types")
def q_attack_types(spark, sf_dir):
    return C.attack_types(csv_scored(spark, sf_dir))


@register("alert_context")
def q_alert_context(spark, sf_dir):
    return C.result_table(csv_scored(spark, sf_dir), keep=[S.ROW_ID])


@register("result_page")
def q_result_page(spark, sf_dir):
    """Second page of 50 rows of the scored upload, in row order."""
    return C.result_page(C.result_table(csv_scored(spark, sf_dir), keep=[S.ROW_ID]), page=2, size=50)


@register("protocol_names")
def q_protocol_names(spark, sf_dir):
    from flowguard.functions.expressions import protocol_label
    raw = flows_csv_from_events(spark, sf_dir)
    return raw.select(S.ROW_ID, "Protocol", protocol_label(F.col("Protocol")).alias("Protocolo"))


@register("conform_features")
def q_conform_features(spark, sf_dir):
    t1, _, t2 = rule_trees()
    raw = strip_column_names(flows_csv_from_events(spark, sf_dir))
    return conform_lenient(raw, model_columns(t1, t2), keep=[S.ROW_ID])


def flows_scored_raw(spark, sf_dir):
    """Uncleaned flows with targets; ``Unit Score`` serves as the score."""
    return add_targets(strip_column_names(flows_from_events(spark, sf_dir)))


@register("threshold_sweep")
def q_threshold_sweep(spark, sf_dir):
    return M.threshold_sweep(flows_scored_raw(spark, sf_dir), S.TARGET_BIN, "Unit Score")


@register("best_threshold")
def q_best_threshold(spark, sf_dir):
    return M.best_threshold(M.threshold_sweep(flows_scored_raw(spark, sf_dir), S.TARGET_BIN, "Unit Score"))


@register("threshold_report")
def q_threshold_report(spark, sf_dir):
    """Binary report of ``Unit Score >= best threshold`` (threshold found by a job)."""
    df = flows_scored_raw(spark, sf_dir)
    thr = M.best_threshold_value(M.threshold_sweep(df, S.TARGET_BIN, "Unit Score"))
    pred = df.withColumn("predicted_bin", (F.col("Unit Score") >= F.lit(thr)).cast("int"))
    return M.classification_report(M.confusion_matrix(pred, S.TARGET_BIN, "predicted_bin", labels=[0, 1]))


# --- profile, balancing -------------------------------------------------------------

from flowguard.operators import balance as B  # noqa: E402
from flowguard.operators import neighbours as N  # noqa: E402
from flowguard.operators import profile as P  # noqa: E402
from flowguard.operators.features import split_features  # noqa: E402


@register("column_profile")
def q_column_profile(spark, sf_dir):
    return P.column_profile(flows_from_events(spark, sf_dir), exclude=[S.ROW_ID])


@register("profile_summary")
def q_profile_summary(spark, sf_dir):
    raw = flows_from_events(spark, sf_dir).drop(S.ROW_ID)
    return P.profile_summary(raw, P.column_profile(raw))


@register("label_counts_by_source")
def q_label_counts_by_source(spark, sf_dir):
    """Label counts per source (nulls kept) with a per-source and grand total (rollup)."""
    raw = flows_from_events(spark, sf_dir, with_source=True)
    return (raw.rollup("source", "Label").agg(F.count(F.lit(1)).alias("n"), F.grouping("Label").alias("_total"))
            .select("source", F.when(F.col("_total") == 1, F.lit("*")).otherwise(F.col("Label")).alias("Label"), "n"))


def stage1_train(spark, sf_dir):
    return stage1_parts(spark, sf_dir).where(F.col(SM.PART) == "train")


@register("undersample_rows")
def q_undersample_rows(spark, sf_dir):
    return B.undersample(stage1_train(spark, sf_dir), S.TARGET_BIN).select(S.ROW_ID, S.TARGET_BIN)


@register("undersample_counts")
def q_undersample_counts(spark, sf_dir):
    kept = B.undersample(stage1_train(spark, sf_dir), S.TARGET_BIN)
    return kept.groupBy(S.TARGET_BIN).agg(F.count(F.lit(1)).alias("n"))


@register("class_weights")
def q_class_weights(spark, sf_dir):
    return B.balanced_weights(B.undersample(stage1_train(spark, sf_dir), S.TARGET_BIN), S.TARGET_BIN)


def stage2_train(spark, sf_dir):
    att = SM.outside_holdout(flows_clean(spark, sf_dir)).where(F.col(S.TARGET_BIN) == 1)
    att = SM.drop_rare_classes(att, S.TARGET_FAMILY, S.MIN_CLASS_SIZE)
    return SM.stratified_split(att, S.TARGET_FAMILY, S.STAGE2_TEST_FRACTION).where(F.col(SM.PART) == "train")


@register("smote_neighbours")
def q_smote_neighbours(spark, sf_dir):
    """Exact 5 nearest same-family neighbours of every stage-2 training row."""
    return B.knn_within_class(stage2_points(spark, sf_dir), S.TARGET_FAMILY, S.SMOTE_K).select(
        S.TARGET_FAMILY, "pid", "nn_rank", "nn_pid")


@register("lsh_neighbour_recall")
def q_lsh_neighbour_recall(spark, sf_dir):
    """How many of the exact neighbours of stage-2 training rows the random projections find, by family."""
    pts = cut(stage2_points(spark, sf_dir))
    found = N.lsh_within_class(pts, S.TARGET_FAMILY, S.SMOTE_K)
    return N.neighbour_recall(found, B.knn_within_class(pts, S.TARGET_FAMILY, S.SMOTE_K), S.TARGET_FAMILY)


def stage2_points(spark, sf_dir):
    tr = stage2_train(spark, sf_dir)
    feats = split_features(tr, extra_exclude=[SM.PART])
    return tr.select(S.TARGET_FAMILY, F.col(S.ROW_ID).alias("pid"),
                     F.array(*[F.col(f"`{c}`") for c in feats]).alias("x"))


def smoted(spark, sf_dir, replacement=False):
    """Stage-2 training rows raised to the majority by SMOTE, and their feature names."""
    from pyspark.ml.feature import VectorAssembler
    tr = stage2_train(spark, sf_dir)
    feats = split_features(tr, extra_exclude=[SM.PART])
    vec = VectorAssembler(inputCols=feats, outputCol="features").transform(tr)
    return B.smote(vec.select(S.TARGET_FAMILY, S.ROW_ID, "features"), S.TARGET_FAMILY, "features", S.SMOTE_K,
                   replacement=replacement), feats


@register("smote_class_counts")
def q_smote_class_counts(spark, sf_dir):
    return smoted(spark, sf_dir)[0].groupBy(S.TARGET_FAMILY).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("synthetic").cast("long")).alias("synthetic"))


@register("smote_rows")
def q_smote_rows(spark, sf_dir):
    """Every synthetic row: its base row, the neighbour drawn, and two of its interpolated features."""
    return synthetic_rows(*smoted(spark, sf_dir))


@register("smote_drawn_rows")
def q_smote_drawn_rows(spark, sf_dir):
    """The same with base rows drawn with replacement."""
    return synthetic_rows(*smoted(spark, sf_dir, replacement=True))


def synthetic_rows(out, feats):
    from pyspark.ml.functions import vector_to_array
    x = vector_to_array(F.col("features"))
    return out.where("synthetic").select(
        S.TARGET_FAMILY, "base_id", "draw", "nn_pid",
        F.round(x[feats.index("Flow Duration")], 6).alias("flow_duration"),
        F.round(x[feats.index("Unit Score")], 6).alias("unit_score"))


# --- learners (rows-only checks: model quality, not SQL) ---------------------------

# Bundles of one application, by input, stage and family: the reports of a family share its training.
_BUNDLES: dict = {}


def trained(spark, sf_dir, stage: int, family: str):
    """A stage trained, over its whole grid, on the flows outside the holdout."""
    from flowguard.plans import jobs as J
    app = spark.sparkContext.applicationId
    for key in [k for k in _BUNDLES if k[0] != app]:
        del _BUNDLES[key]
    key = (app, sf_dir, stage, family)
    if key not in _BUNDLES:
        rest = cut(SM.outside_holdout(flows_clean(spark, sf_dir)))
        fn = J.train_stage1 if stage == 1 else J.train_stage2
        _BUNDLES[key] = fn(rest, family=family)
    return _BUNDLES[key]


def _stage_report(spark, sf_dir, stage, family):
    bundle, rep = trained(spark, sf_dir, stage, family)
    table = rep["test"] if stage == 1 else rep["test_report"]
    grid = spark.createDataFrame([(f"cv {name} {params}" if family == "all" else f"cv {params}", score)
                                  for name, params, score in rep["cv"]], "label string, f1 double")
    rows = table.unionByName(grid, allowMissingColumns=True)
    return rows.withColumns({"family": F.lit(bundle.family), "threshold": F.lit(float(bundle.threshold))})


for _stage in (1, 2):
    for _fam in ("rf", "dt", "lr", "all"):
        def _q(spark, sf_dir, _s=_stage, _f=_fam):
            return _stage_report(spark, sf_dir, _s, _f)
        _q.__doc__ = (f"Stage {_stage} {_fam} (all: the best of one search over all three): report on the test part, and a row with the cross-validated F1 of every "
                      "point of the grid.")
        register(f"stage{_stage}_{_fam}")(_q)


def _cascade(spark, sf_dir, family):
    """Both trained stages over the holdout: report rows of the cascade, then its missed attacks."""
    b1, b2 = trained(spark, sf_dir, 1, family)[0], trained(spark, sf_dir, 2, family)[0]
    scored = cut(C.score_models(holdout_eval(spark, sf_dir), b1, b2, C.EVALUATION).select(S.TARGET_FAMILY, C.ATTACK_TYPE))
    report = M.classification_report(M.confusion_matrix(scored, S.TARGET_FAMILY, C.ATTACK_TYPE))
    missed = C.missed_attacks(scored).select(
        F.concat(F.lit("missed "), "family").alias("label"), F.col("missed").alias("support"), (
            F.lit(1.0) - F.col("pct") / 100).alias("recall"))
    return report.unionByName(missed, allowMissingColumns=True).withColumn("threshold", F.lit(float(b1.threshold)))


for _fam in ("rf", "dt", "lr", "interpretable"):
    def _q(spark, sf_dir, _f=_fam):
        return _cascade(spark, sf_dir, _f)
    _q.__doc__ = f"The trained {_fam} cascade on the holdout: classification report and missed attacks."
    register(f"cascade_{_fam}")(_q)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    from flowguard.plans import jobs as J
    bundle, _ = trained(spark, sf_dir, 1, "rf")
    return J.feature_importance(spark, bundle)


@register("lr_coefficients")
def q_lr_coefficients(spark, sf_dir):
    from flowguard.plans import jobs as J
    bundle, _ = trained(spark, sf_dir, 2, "lr")
    return J.feature_importance(spark, bundle)


def _interpretable_tree(spark, sf_dir, stage):
    from flowguard.plans import jobs as J
    bundle, _ = trained(spark, sf_dir, stage, "interpretable")
    kind = R.PROBABILITY if stage == 1 else R.CLASS
    return R.tree_from_model(spark, bundle.model.stages[-1], J.kept_features(bundle), kind, bundle.classes
                             if stage == 2 else None)


@register("tree_rules")
def q_tree_rules(spark, sf_dir):
    """Leaf rules of the interpretable stage-1 tree trained on the tables."""
    return R.rules_table(spark, _interpretable_tree(spark, sf_dir, 1))


@register("tree_nodes")
def q_tree_nodes(spark, sf_dir):
    """Nodes of the interpretable stage-2 tree down to depth 5 (the drawn part)."""
    return R.structure_to_depth(spark, _interpretable_tree(spark, sf_dir, 2), 5)


@register("constant_columns_train")
def q_constant_columns_train(spark, sf_dir):
    """Features constant on the training part of a 70/15/15 split (removed from all parts)."""
    parts = SM.three_way_split(flows_clean(spark, sf_dir), S.TARGET_FAMILY)
    train = parts.where(F.col(SM.PART) == "train")
    prof = P.column_profile(train.select(*[F.col(f"`{c}`") for c in split_features(train, [SM.PART])]))
    return prof.where("constant").select("column")


@register("scaler_stats")
def q_scaler_stats(spark, sf_dir):
    """Mean and population standard deviation of every feature that varies, on the stage-1 training part: what the
    logistic model's rows are standardised by, ahead of its undersampling."""
    tr = stage1_train(spark, sf_dir)
    feats = split_features(tr, [SM.PART])
    v = F.col("s.v")
    return tr.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("v")) for c in feats])).alias("s")) \
        .groupBy(F.col("s.feature").alias("feature")).agg(
            F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"),
            (F.min(v) != F.max(v)).alias("_varies")).where("_varies").drop("_varies")


@register("profile")
def q_profile(spark, sf_dir):
    """The profile job's report in long form."""
    return P.profile_report(flows_from_events(spark, sf_dir, with_source=True).drop(S.ROW_ID), [], "source")


# --- saved bundles, rule text, fitted preparation ----------------------------------

import uuid  # noqa: E402

from flowguard.session import checkpoint_dir  # noqa: E402


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), name, uuid.uuid4().hex)


def bundle_scored(spark, sf_dir, family: str = "dt"):
    """The upload scored by both stages of a family, saved and loaded again."""
    from flowguard.plans import jobs as J
    from flowguard.plans import scoring as SC
    folder = _scratch(spark, "bundles")
    for stage in (1, 2):
        J.save_bundle(spark, trained(spark, sf_dir, stage, family)[0], f"{folder}/{family}_stage{stage}")
    one, two = (SC.first_bundle(spark, folder, [f"{family}_stage{stage}", f"stage{stage}"]) for stage in (1, 2))
    return SC.score_upload(flows_csv_from_events(spark, sf_dir), one, two, keep=[S.ROW_ID])


@register("bundle_alerts")
def q_bundle_alerts(spark, sf_dir):
    """The uploaded table scored by the saved and reloaded decision-tree bundles."""
    return bundle_scored(spark, sf_dir)


@register("bundle_row_check")
def q_bundle_row_check(spark, sf_dir):
    """Of the upload scored by saved bundles: its rows, and those whose results break the rules of a report."""
    hit = F.col(C.ALERT) == S.ALERT_ATTACK
    broken = (F.when(hit, F.col(C.TYPE_CONFIDENCE).isNull() | (F.col(C.ATTACK_TYPE) == S.TYPE_NOT_APPLICABLE))
              .otherwise(F.col(C.TYPE_CONFIDENCE).isNotNull() | (F.col(C.ATTACK_TYPE) != S.TYPE_NOT_APPLICABLE)))
    return bundle_scored(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(S.ROW_ID).alias("ids"),
                                            F.sum(broken.cast("long")).alias("broken"))


@register("compiled_tree_check")
def q_compiled_tree_check(spark, sf_dir):
    """Both interpretable stages on the holdout, as models and compiled to columns: rows, and rows that differ."""
    from flowguard.plans import jobs as J
    rows = holdout_eval(spark, sf_dir)
    out = None
    for stage in (1, 2):
        bundle, tree = trained(spark, sf_dir, stage, "interpretable")[0], _interpretable_tree(spark, sf_dir, stage)
        if stage == 1:
            both = J.stage1_probability(bundle, rows)
            differs = F.abs(R.score_columns(tree)["p"] - F.col(C.P_ATTACK)) > 1e-12
        else:
            both = J.stage2_predict(bundle, rows)
            own = R.score_columns(tree)
            differs = (own["label"] != F.col("predicted_tipo")) | (
                F.abs(own["confidence"] - F.col("type_confidence")) > 1e-12)
        one = both.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("n"), F.sum(differs.cast("long")).alias("differing"))
        out = one if out is None else out.unionByName(one)
    return out


@register("rule_leaf_support")
def q_rule_leaf_support(spark, sf_dir):
    """Every leaf of the exported trees as a rule, with the rows of the holdout that reach it."""
    t1, _, t2 = rule_trees()
    rows = cut(holdout_eval(spark, sf_dir).select(R.leaf_expr(t1).alias("s1"), R.leaf_expr(t2).alias("s2")))
    out = None
    for stage, tree in ((1, t1), (2, t2)):
        n = rows.groupBy(F.col(f"s{stage}").alias("leaf")).agg(F.count(F.lit(1)).alias("n"))
        one = R.rules_table(spark, tree).join(n, "leaf", "left").select(
            F.lit(stage).alias("stage"), "leaf", "depth", "rule", "label", "confidence", F.coalesce("n", F.lit(0)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@register("rule_text_score")
def q_rule_text_score(spark, sf_dir):
    """The exported stage-2 tree written as text (two decimals), read and parsed again, over all clean flows."""
    path = _scratch(spark, "rules")
    R.write_rules_text(spark, rule_trees()[2], path)
    tree = R.tree_from_text(spark, path)
    return flows_clean(spark, sf_dir).select(S.ROW_ID, R.score_columns(tree)["label"].alias("label"))


@register("parts_without_constants")
def q_parts_without_constants(spark, sf_dir):
    """The feature columns that each part keeps once those constant on the training part are removed from all, and how
    many values they have there."""
    from flowguard.operators.prepare import ConstantColumnRemover
    parts = SM.three_way_split(flows_clean(spark, sf_dir), S.TARGET_FAMILY)
    feats = split_features(parts, [SM.PART])
    parts = cut(parts.select(SM.PART, *[F.col(f"`{c}`") for c in feats]))
    kept = ConstantColumnRemover(inputCols=feats).fit(parts.where(F.col(SM.PART) == "train"))
    rest = kept.transform(parts)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in kept.kept()]))
    return rest.select(SM.PART, cells.alias("c")).groupBy(SM.PART, F.col("c.column").alias("column")).agg(
        F.count("c.v").alias("n"))


@register("population_scaler")
def q_population_scaler(spark, sf_dir):
    """Means and population deviations of the scaler fitted on the stage-1 training part, saved and loaded again."""
    from pyspark.ml.feature import VectorAssembler
    from flowguard.operators.prepare import ConstantColumnRemover, PopulationScaler, PopulationScalerModel
    train = stage1_train(spark, sf_dir)
    feats = split_features(train, [SM.PART])
    train = cut(train.select(*[F.col(f"`{c}`") for c in feats]))
    feats = ConstantColumnRemover(inputCols=feats).fit(train).kept()
    rows = VectorAssembler(inputCols=feats, outputCol="raw").transform(train)
    path = _scratch(spark, "scalers")
    PopulationScaler(inputCol="raw", outputCol="scaled").fit(rows).write().save(path)
    scaler = PopulationScalerModel.load(path)
    found = zip(feats, scaler.getOrDefault(scaler.mean), scaler.getOrDefault(scaler.std), strict=True)
    return spark.createDataFrame(list(found), "feature string, mean double, std double").select(
        "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@register("stacked_file_counts")
def q_stacked_file_counts(spark, sf_dir):
    """Tables stacked as files: rows read while stacking and rows that the stack holds, file by file."""
    out = f"{checkpoint_dir(spark)}/stack-{uuid.uuid4().hex}"
    report = stack_files(spark, [f"{sf_dir}/{t}.parquet" for t in STACKED], out, ["event_id", "o_orderkey", "l_orderkey"])
    return report.select(F.regexp_extract("file", "([^/]+)$", 1).alias("file"), "read_rows", "written_rows", "matches")
