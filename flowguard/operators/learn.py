"""Spark ML building blocks for the two detection stages.

* ``ConstantFeatureFilter`` -- drops features that are constant on the fit
  data (min == max); fitted per training fold, returns a ``VectorSlicer``.
* ``Rebalanced`` -- fit-only wrapper: resamples the fold (undersampling or
  SMOTE), adds balanced class weights, fits the inner learner and returns the
  *inner model*, so scoring never resamples.
* ``BinaryF1Evaluator`` / ``MacroF1Evaluator`` -- model-choice metrics.
* ``candidates()`` -- the model families and grids of each stage.

Binary trees are trained as regressors on the 0/1 label: their leaves keep
the (weighted) attack rate, whereas classifier trees merge sibling leaves
that predict the same class and flatten the probabilities the threshold
search depends on.  Variance impurity is half the Gini impurity, so the
splits are the same.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators import balance as B
from flowguard.operators.forest import fit_grid
from flowguard.operators.logistic import RidgeLogistic
from flowguard.operators.metrics import binary_f1, macro_f1
from flowguard.operators.prepare import PopulationScaler
from flowguard.session import cut

FEATURES = "features"
LABEL = "label"
WEIGHT = "weight"
P_ATTACK = "p_attack"


class ConstantFeatureFilter(Estimator):
    """Keep the features whose min differs from their max on the fit data."""

    def __init__(self, inputCol: str = "raw_features", outputCol: str = FEATURES):
        super().__init__()
        self.inputCol, self.outputCol = inputCol, outputCol

    def _fit(self, dataset: DataFrame) -> Transformer:
        s = dataset.select(Summarizer.metrics("min", "max").summary(F.col(self.inputCol)).alias("s")).first()["s"]
        lo, hi = s["min"].toArray(), s["max"].toArray()
        keep = [i for i in range(len(lo)) if lo[i] != hi[i]]
        if not keep:
            raise ValueError("every feature is constant on the training data")
        return VectorSlicer(inputCol=self.inputCol, outputCol=self.outputCol, indices=keep)

    def copy(self, extra=None):
        return ConstantFeatureFilter(self.inputCol, self.outputCol)


class Rebalanced(Estimator):
    """Resample the fit data, weight classes, fit ``inner``; return its model."""

    strategy = Param(Params._dummy(), "strategy", "none | under | smote",
                     typeConverter=TypeConverters.toString)
    ratio = Param(Params._dummy(), "ratio", "minority/majority after undersampling",
                  typeConverter=TypeConverters.toFloat)
    k = Param(Params._dummy(), "k", "SMOTE neighbours", typeConverter=TypeConverters.toInt)
    inverseReg = Param(Params._dummy(), "inverseReg",
                       "C of a logistic model: regParam = 1 / (C * sum of weights)",
                       typeConverter=TypeConverters.toFloat)

    def __init__(self, inner: Estimator, strategy: str = "none", ratio: float = S.UNDERSAMPLE_RATIO,
                 k: int = S.SMOTE_K, inverseReg: float = 1.0, seed: int = S.SEED):
        super().__init__()
        self.inner = inner
        self.seed = seed
        self._set(strategy=strategy, ratio=ratio, k=k, inverseReg=inverseReg)

    def _resample(self, df: DataFrame, near: DataFrame | None = None) -> DataFrame:
        st = self.getOrDefault(self.strategy)
        if st == "under":
            return B.undersample(df, LABEL, self.getOrDefault(self.ratio), self.seed)
        if st == "smote":
            return B.smote(df.select(LABEL, S.ROW_ID, FEATURES), LABEL, FEATURES,
                           self.getOrDefault(self.k), self.seed, near=near)
        return df

    def prepared(self, dataset: DataFrame, near: DataFrame | None = None) -> DataFrame:
        """The resampled, weighted rows that a fit sees; the same for every point of a grid. ``near`` gives SMOTE its
        neighbours if they are known."""
        df = self._resample(dataset.select(S.ROW_ID, LABEL, FEATURES), near).select(LABEL, FEATURES)
        return cut(B.with_balanced_weights(df, LABEL, WEIGHT))

    def _fit(self, dataset: DataFrame) -> Model:
        return self.fit_prepared(self.prepared(dataset))

    def fit_points(self, df: DataFrame, points: list[dict]) -> list[Model]:
        """A model of the prepared rows for each point of a grid; trees are grown for all points at once."""
        models = fit_grid(df, self.inner, [{p.name: v for p, v in point.items()} for point in points], LABEL, WEIGHT, FEATURES)
        return [self.copy(point).fit_prepared(df) for point in points] if models is None else models

    def fit_prepared(self, df: DataFrame) -> Model:
        inner = self.inner.copy()
        if inner.hasParam("weightCol"):
            inner = inner.copy({inner.getParam("weightCol"): WEIGHT})
        if isinstance(inner, RidgeLogistic):
            total = df.agg(F.sum(WEIGHT)).first()[0]
            inner = inner.copy({inner.regParam: 1.0 / (self.getOrDefault(self.inverseReg) * total)})
        return inner.fit(df)

    def copy(self, extra=None):
        extra = dict(extra or {})
        that = super().copy(extra)          # same uid, own params copied, foreign ones ignored
        that.inner = self.inner.copy(extra)  # grid params addressed to the inner learner
        return that


def class_index(classes: list | None, wanted, width: int, fallback: int = 1) -> int:
    """Place of a class among a model's probabilities: as it is named or as text, else ``fallback``, else the last."""
    names = list(classes or [])
    for name in (wanted, str(wanted)):
        if name in names:
            return names.index(name)
    return fallback if fallback < width else width - 1


def attack_probability(df: DataFrame, classes: list | None = None, width: int = 2) -> Column:
    """P(attack) from a stage-1 model output: of classifiers the probability of class 1, wherever ``classes`` has it; of
    regressor trees the prediction, the mean label (the place of a row's class) of a leaf."""
    at = class_index(classes, 1, width)
    if "probability" in df.columns:
        return vector_to_array(F.col("probability"))[at]
    mean = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
    return mean if at == 1 else F.lit(1.0) - mean


class BinaryF1Evaluator(Evaluator):
    """F1 of the attack class with the prediction ``P(attack) > 0.5`` (a tie is class 0)."""

    def _evaluate(self, dataset: DataFrame) -> float:
        p = attack_probability(dataset)
        return binary_f1(dataset.withColumn(P_ATTACK, p), LABEL, F.col(P_ATTACK) > 0.5)

    def isLargerBetter(self) -> bool:
        return True


class MacroF1Evaluator(Evaluator):
    """Unweighted mean of the per-class F1 (over actual and predicted labels)."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return macro_f1(dataset.withColumn("_pred", F.col("prediction")), LABEL, "_pred")

    def isLargerBetter(self) -> bool:
        return True


# --- model families -------------------------------------------------------------

def _front(features: list[str], scale: bool) -> list:
    stages = [VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="error"),
              ConstantFeatureFilter("raw_features", FEATURES if not scale else "kept_features")]
    if scale:
        stages.append(PopulationScaler(inputCol="kept_features", outputCol=FEATURES))
    return stages


def candidates(features: list[str], stage: int, family: str = "all", seed: int = S.SEED) -> list[tuple[str, list, list[dict]]]:
    """``(name, stages, param_maps)`` per candidate model family.

    stage 1: undersampling to 0.333; RF / DT as regressors, LR binomial.
    stage 2: SMOTE; RF / DT / LR multinomial classifiers.
    Every family comes with its whole published grid; ``'interpretable'`` gives
    the shallow-tree grids. Families that are prepared alike share their front
    stages (the same objects), by which a search prepares a fold once for them.
    """
    strat = "under" if stage == 1 else "smote"
    out = []
    fronts = {scale: _front(features, scale) for scale in (False, True)}

    def add(name, inner, scale, maps):
        wrap = Rebalanced(inner, strategy=strat, seed=seed)
        stages = fronts[scale] + [wrap]
        pm = [{(wrap if p == "C" else inner).getParam("inverseReg" if p == "C" else p): v
               for p, v in m.items()} for m in maps]
        out.append((name, stages, pm))

    if family in ("all", "rf"):
        # with the node of every row and tree kept, a pass does not walk all trees down from their roots; same trees
        kind = RandomForestRegressor if stage == 1 else RandomForestClassifier
        rf = kind(seed=seed, featureSubsetStrategy="sqrt", maxBins=128, cacheNodeIds=True)
        add("rf", rf, False, [{"numTrees": t, "maxDepth": d} for t in (50, 100) for d in (8, 12)])
    if family in ("all", "dt"):
        dt = (DecisionTreeRegressor(seed=seed, maxBins=128) if stage == 1
              else DecisionTreeClassifier(seed=seed, maxBins=128))
        add("dt", dt, False, [{"maxDepth": d} for d in (8, 12)])
    if family == "interpretable":
        dt = (DecisionTreeRegressor(seed=seed, maxBins=128) if stage == 1
              else DecisionTreeClassifier(seed=seed, maxBins=128))
        depths, leaves = ((3, 5, 7), (10, 50, 100)) if stage == 1 else ((5, 8, 10), (5, 20, 50))
        add("dt", dt, False, [{"maxDepth": d, "minInstancesPerNode": m} for d in depths for m in leaves])
    if family in ("all", "lr"):
        lr = RidgeLogistic(maxIter=1000 if family == "all" else (3000 if stage == 1 else 4000),
                           family="binomial" if stage == 1 else "multinomial")
        cs = (0.1, 1.0, 10.0) if family == "all" else (0.01, 0.1, 1.0, 10.0)
        add("lr", lr, True, [{"C": c} for c in cs])
    return out

