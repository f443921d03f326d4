"""End-to-end jobs: sample, holdout, stage-1 / stage-2 training, bundles.

Training runs on the persisted sample (10 000 - 50 000 rows by default), so
the learners see bounded data; the scans, splits and scoring around them run
over whole tables.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators import balance as B
from flowguard.operators import cascade as C
from flowguard.operators import learn as L
from flowguard.operators import metrics as M
from flowguard.operators import profile as P
from flowguard.operators import sampling as SM
from flowguard.operators.clean import clean_flows, strip_column_names
from flowguard.operators.distribution import class_counts
from flowguard.operators.forest import growable
from flowguard.operators.features import conform_lenient, conform_strict, split_features
from flowguard.operators.prepare import ConstantColumnModel, ConstantColumnRemover, PopulationScaler
from flowguard.operators.rules import RuleTree
from flowguard.operators.targets import add_targets, attacks_only
from flowguard.session import cut
from flowguard.sources.files import FILE, load_flows, load_flows_reported, read_flows


@dataclass
class Bundle:
    """A trained stage: the fitted pipeline plus its scoring contract."""
    model: PipelineModel
    columns: list[str]
    classes: list
    threshold: float = S.DEFAULT_THRESHOLD
    family: str = ""
    stage: int = 1
    scaler: str | None = None          # always folded into the pipeline
    info: dict = field(default_factory=dict)
    remover: ConstantColumnModel | None = None   # of columns that were constant on the training part

    def contract(self) -> dict:
        return {"columns": self.columns, "classes": self.classes, "threshold": self.threshold,
                "family": self.family, "stage": self.stage, "scaler": self.scaler, "info": self.info}


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    """Pipeline under ``path/model``; the contract as a one-row JSON table."""
    bundle.model.write().overwrite().save(os.path.join(path, "model"))
    if bundle.remover is not None:
        bundle.remover.write().overwrite().save(os.path.join(path, "remover"))
    spark.createDataFrame([(json.dumps({**bundle.contract(), "remover": bundle.remover is not None}),)],
                          "contract string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "contract"))


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    c = json.loads(spark.read.text(os.path.join(path, "contract")).first()[0])
    model = PipelineModel.load(os.path.join(path, "model"))
    remover = ConstantColumnModel.load(os.path.join(path, "remover")) if c.get("remover") else None
    return Bundle(model, c["columns"], c["classes"], c["threshold"], c["family"], c["stage"],
                  c.get("scaler"), c.get("info", {}), remover)


def bundle_exists(spark: SparkSession, path: str) -> bool:
    """Whether a bundle's contract is there; errors other than a missing path are raised."""
    try:
        spark.read.text(os.path.join(path, "contract"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can open a table there; errors other than a missing path are raised."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def save_holdout(holdout: DataFrame, path: str) -> None:
    holdout.write.mode("overwrite").parquet(path)


def load_holdout(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        raise FileNotFoundError(f"holdout keys not found at {path}; build the holdout first")
    return spark.read.parquet(path)


def load_sample(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        raise FileNotFoundError(f"sample not found at {path}; build it with build_sample()")
    return spark.read.parquet(path)


def load_base(spark: SparkSession, path: str, flow_paths: list[str]) -> DataFrame:
    """The persisted sample if there is one, else all flows, cleaned and with targets."""
    if table_exists(spark, path):
        return spark.read.parquet(path)
    return add_targets(clean_flows(load_flows(spark, flow_paths)))


def build_sample(df_clean: DataFrame, path: str, size: int = S.SAMPLE_SIZE, seed: int = S.SEED):
    """Exact stratified sample by family, audited, written as parquet with its
    ``row_id``.  Returns the audit table (it warns, never fails)."""
    sample = SM.stratified_sample(df_clean, S.TARGET_FAMILY, size, seed)
    sample.write.mode("overwrite").parquet(path)
    written = df_clean.sparkSession.read.parquet(path)
    return SM.sample_audit(df_clean, written, S.TARGET_FAMILY)


def profile_files(spark: SparkSession, paths: list[str], path: str | None = None) -> DataFrame:
    """Profile report of flow files; an unreadable one is a row of the report
    and the job goes on.  ``path`` also writes it as JSON lines."""
    df, errors = load_flows_reported(spark, paths, with_file=True)
    if df is None:
        report = spark.createDataFrame([("errors", f, "error", e) for f, e in errors],
                                       "section string, column string, metric string, value string")
    else:
        report = P.profile_report(df, errors, FILE)
    if path:
        P.write_report(report, path)
    return report


def score_flows(spark: SparkSession, path: str, stage1: RuleTree, threshold: float, stage2: RuleTree) -> DataFrame:
    """Scoring job for an uploaded table (CSV or parquet): names stripped,
    features conformed leniently, cascade in dashboard mode, context columns
    first.  An input without rows gives an empty result of the same columns."""
    raw = strip_column_names(read_flows(spark, path))
    columns = list(dict.fromkeys([*stage1.features, *stage2.features]))
    keep = [c for c in [S.ROW_ID, *S.CONTEXT_COLUMNS] if c in raw.columns]
    scored = C.score_rules(conform_lenient(raw, columns, keep=keep), stage1, threshold, stage2, C.DASHBOARD)
    table = C.result_table(scored, keep=[c for c in (S.ROW_ID,) if c in raw.columns])
    return table.limit(0) if raw.isEmpty() else table


# --- training -------------------------------------------------------------------

def _fitted_front(stages: list, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages[:-1]).fit(df)


def _preparation(stages: list) -> tuple:
    """What a fold's prepared rows depend on: the front stages (shared objects) and the resampling."""
    wrap = stages[-1]
    return (*map(id, stages[:-1]), *(wrap.getOrDefault(p) for p in (wrap.strategy, wrap.ratio, wrap.k)), wrap.seed)


def _fold_neighbours(df: DataFrame, stages: list, folds: int):
    """One search of neighbours for all folds, where SMOTE asks for them and a row has an id of its own: a function of a
    fold and its fitted front stages. A feature that is constant without a fold adds nothing to a distance there."""
    wrap = stages[-1]
    if wrap.getOrDefault(wrap.strategy) != "smote" or folds < 2:
        return None
    ids = df.groupBy(S.ROW_ID).agg(F.count(F.lit(1)).alias("n")).where(F.col(S.ROW_ID).isNull() | (F.col("n") > 1))
    if not ids.isEmpty():
        return None
    whole = _fitted_front(stages, df)
    scaled = isinstance(stages[-2], PopulationScaler)
    shared = B.FoldNeighbours(whole.transform(df), L.LABEL, L.FEATURES, wrap.getOrDefault(wrap.k),
                              plain=stages[-2].getInputCol() if scaled else None)

    def divisors(front: PipelineModel) -> dict:
        model = front.stages[-1]
        return dict(zip(front.stages[-2].getIndices(), [s if s > 0 else 1.0 for s in model.getOrDefault(model.std)], strict=True))

    def without(fold: int | None, front: PipelineModel) -> DataFrame:
        if not scaled:
            return shared.without(fold)
        before, now, model = divisors(whole), divisors(front), front.stages[-1]
        places = list(before)
        return shared.without(fold, ([places.index(j) for j in now], model.getOrDefault(model.mean), list(now.values()),
                                     min(before[j] / s for j, s in now.items())))
    return without


def _cross_validate(df: DataFrame, cands, evaluator, folds: int, parallelism: int):
    """One search over all points of all candidates.

    On a fold, features are fitted and rows resampled once for all candidates that are prepared alike, whatever their
    learners. Folds are prepared side by side, as are all rows where there is one way to prepare them, and then the points
    of all folds are fitted side by side (``parallelism``): each is a row of small jobs that leaves most of a cluster idle.
    The points of a kind of tree are fitted together on a fold, as they share their trees. The best point of all (the first
    of equals) is fitted again on all rows.
    """
    points = [(name, stages, point) for name, stages, grid in cands for point in grid]
    kinds = {_preparation(stages): stages for _, stages, _ in points}

    near = {kind: _fold_neighbours(df, stages, folds) for kind, stages in kinds.items()}

    def prepare(task):
        fold, kind = task
        stages, train = kinds[kind], df if fold is None else df.where(F.col("fold") != fold)
        front = _fitted_front(stages, train)
        rows = stages[-1].prepared(front.transform(train), *([near[kind](fold, front)] if near[kind] else []))
        return (front, rows) if fold is None else (rows, cut(front.transform(df.where(F.col("fold") == fold))))

    tasks = [(fold, kind) for fold in range(folds) for kind in kinds] + [(None, kind) for kind in kinds if len(kinds) == 1]
    with ThreadPoolExecutor(len(tasks)) as pool:
        prepared = dict(zip(tasks, pool.map(prepare, tasks)))

    # points that are fitted together, by their places: all of a candidate of trees, each by itself of others
    units, at = [], 0
    for _, stages, grid in cands:
        places = list(range(at, at + len(grid)))
        units += [places] if growable(stages[-1].inner) else [[i] for i in places]
        at += len(grid)

    def score(task):
        fold, places = task
        stages = points[places[0]][1]
        rows, held = prepared[(fold, _preparation(stages))]
        models = stages[-1].fit_points(rows, [points[i][2] for i in places])
        return [evaluator.evaluate(model.transform(held)) for model in models]

    work = [(fold, places) for fold in range(folds) for places in units]
    scores = [[] for _ in points]
    with ThreadPoolExecutor(parallelism) as pool:
        for (_, places), values in zip(work, pool.map(score, work)):
            for i, value in zip(places, values, strict=True):
                scores[i].append(value)
    means = [sum(s) / len(s) for s in scores]
    table = [(name, json.dumps({p.name: v for p, v in point.items()}), float(m))
             for (name, _, point), m in zip(points, means)]
    best = max(range(len(points)), key=lambda i: means[i])
    name, stages, point = points[best]
    whole = (None, _preparation(stages))
    front, rows = prepared[whole] if whole in prepared else prepare(whole)
    model = PipelineModel([*front.stages, *stages[-1].fit_points(rows, [point])])
    return (name, means[best], point, model), table


def train_stage1(df: DataFrame, family: str = "all", seed: int = S.SEED,
                 folds: int = S.CV_FOLDS, parallelism: int = 8,
                 recall_target: float = S.RECALL_TARGET, drop_constant: bool = False) -> tuple[Bundle, dict]:
    """Binary detector on rows outside the holdout: 70/15/15 split, CV over
    the model families (undersampling inside each fold), threshold for the
    recall target on validation, report on test. With ``drop_constant`` the
    columns that are constant on the training part leave all parts, and the
    bundle's remover takes them out of later inputs."""
    features = split_features(df)
    parts = cut(SM.three_way_split(df, S.TARGET_BIN, seed=seed).withColumn(
        L.LABEL, F.col(S.TARGET_BIN).cast("double")))
    remover = None
    if drop_constant:
        remover = ConstantColumnRemover(inputCols=features).fit(parts.where(F.col(SM.PART) == "train"))
        parts, features = remover.transform(parts), remover.kept()
    train = cut(SM.stratified_folds(parts.where(F.col(SM.PART) == "train"), S.TARGET_BIN, folds, seed))
    cands = L.candidates(features, 1, family, seed)
    (name, score, pm, model), table = _cross_validate(train, cands, L.BinaryF1Evaluator(), folds, parallelism)
    val = model.transform(parts.where(F.col(SM.PART) == "val"))
    val = val.withColumn(L.P_ATTACK, L.attack_probability(val))
    sweep = M.threshold_sweep(val, L.LABEL, L.P_ATTACK)
    thr = M.best_threshold_value(sweep, recall_target)
    bundle = Bundle(model, features, [0, 1], thr, name, 1,
                    info={"cv_f1": score, "params": {p.name: v for p, v in pm.items()}, "grid": table}, remover=remover)
    test = score_stage1(bundle, parts.where(F.col(SM.PART) == "test"))
    report = {"test": test, "sweep": sweep, "cv": table}
    return bundle, report


def train_stage2(df: DataFrame, family: str = "all", seed: int = S.SEED,
                 folds: int = S.CV_FOLDS, parallelism: int = 8,
                 min_class: int = S.MIN_CLASS_SIZE, k: int | None = None) -> tuple[Bundle, dict]:
    """Attack-family classifier on attack rows outside the holdout: rare
    classes removed, 85/15 split, CV with SMOTE inside each fold."""
    attacks = SM.drop_rare_classes(attacks_only(df), S.TARGET_FAMILY, min_class)
    classes = sorted(r[0] for r in class_counts(attacks, S.TARGET_FAMILY).select(S.TARGET_FAMILY).collect())
    index = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))])
    features = split_features(df)
    parts = (SM.stratified_split(attacks, S.TARGET_FAMILY, S.STAGE2_TEST_FRACTION, seed)
             .withColumn(L.LABEL, F.element_at(index, F.col(S.TARGET_FAMILY))))
    parts = cut(parts)
    train = cut(SM.stratified_folds(parts.where(F.col(SM.PART) == "train"), S.TARGET_FAMILY, folds, seed))
    cands = L.candidates(features, 2, family, seed)
    # neighbours of SMOTE: fixed for the forests and trees, from the smallest class for the others
    if k is None and family in ("lr", "interpretable"):
        k = B.smote_k(SM.collect_counts(train, S.TARGET_FAMILY), floor_one=family == "lr")
    for _, stages, _ in cands:
        stages[-1]._set(k=S.SMOTE_K if k is None else k)
    (name, score, pm, model), table = _cross_validate(train, cands, L.MacroF1Evaluator(), folds, parallelism)
    bundle = Bundle(model, features, classes, S.DEFAULT_THRESHOLD, name, 2,
                    info={"cv_macro_f1": score, "params": {p.name: v for p, v in pm.items()}, "grid": table})
    test = stage2_predict(bundle, parts.where(F.col(SM.PART) == "test"))
    cm = M.confusion_matrix(test, S.TARGET_FAMILY, "predicted_tipo", labels=classes)
    return bundle, {"test_report": M.classification_report(cm), "confusion": cm, "cv": table}


# --- scoring with a bundle --------------------------------------------------------

def stage1_probability(bundle: Bundle, df: DataFrame, strict: bool = True) -> DataFrame:
    """Adds ``p_attack`` (model output columns are dropped again)."""
    df = bundle.remover.transform(df) if bundle.remover else df
    x = conform_strict(df, bundle.columns, keep=[c for c in df.columns if c not in bundle.columns]) \
        if strict else df
    out = bundle.model.transform(x)
    width = getattr(bundle.model.stages[-1], "numClasses", 2)
    out = out.withColumn(L.P_ATTACK, L.attack_probability(out, bundle.classes, width))
    return out.drop("raw_features", "kept_features", L.FEATURES, "prediction", "probability", "rawPrediction")


def score_stage1(bundle: Bundle, df: DataFrame) -> DataFrame:
    """Binary report at the bundle's threshold."""
    p = stage1_probability(bundle, df).withColumn(
        "predicted_bin", (F.col(L.P_ATTACK) >= F.lit(bundle.threshold)).cast("int"))
    cm = M.confusion_matrix(p, S.TARGET_BIN, "predicted_bin", labels=[0, 1])
    return M.classification_report(cm)


def stage2_predict(bundle: Bundle, df: DataFrame) -> DataFrame:
    """Adds ``predicted_tipo`` (class name; the prediction itself in a contract without names) and ``type_confidence``
    (the largest probability, 1 of a model without)."""
    df = bundle.remover.transform(df) if bundle.remover else df
    out = bundle.model.transform(conform_strict(
        df, bundle.columns, keep=[c for c in df.columns if c not in bundle.columns]))
    place = F.col("prediction").cast("int")
    name = F.get(F.array(*[F.lit(str(c)) for c in bundle.classes]), place) if bundle.classes else place.cast("string")
    conf = (F.array_max(L.vector_to_array(F.col("probability"))) if "probability" in out.columns
            else F.lit(1.0))
    out = out.withColumn("predicted_tipo", name).withColumn("type_confidence", conf)
    return out.drop("raw_features", "kept_features", L.FEATURES, "prediction", "probability", "rawPrediction")


# --- interpretability ---------------------------------------------------------------

def kept_features(bundle: Bundle) -> list[str]:
    """Feature names after the constant-feature filter."""
    from pyspark.ml.feature import VectorSlicer
    for st in bundle.model.stages:
        if isinstance(st, VectorSlicer):
            return [bundle.columns[i] for i in st.getIndices()]
    return list(bundle.columns)


def feature_importance(spark: SparkSession, bundle: Bundle, top: int = 10) -> DataFrame:
    """Top features: tree importances, or mean |coefficient| over classes."""
    names = kept_features(bundle)
    last = bundle.model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
        kind = "importance"
    else:
        mat = last.coefficientMatrix.toArray()
        vals = [float(abs(mat[:, j]).mean()) for j in range(mat.shape[1])]
        kind = "mean_abs_coefficient"
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature string, value double")
    return df.orderBy(F.desc("value"), "feature").limit(top).withColumn("kind", F.lit(kind))
