"""Ridge logistic regression, binomial or multinomial, by Newton's method.

The rows are packed into blocks of doubles once. A round is one job: each block gives its part of the loss, the gradient
and the Hessian in numpy, and Spark adds them up. The objective is MLlib's (weighted mean loss + regParam / 2 * |w|^2,
intercepts free). It is convex, so that a few rounds reach its minimum where L-BFGS needs hundreds of jobs if the penalty
is weak.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasRegParam, HasTol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 2048             # rows whose products of classes and features are held at once
HALVINGS = 40           # of a step that does not lower the loss


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch (label, weight, features) as one block of doubles."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            block = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(), x])
            yield pa.RecordBatch.from_arrays([pa.array([block.shape[1]]), pa.array([block.tobytes()], pa.binary())],
                                             ["width", "block"])


def parts_of(block: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and Hessian of a block, one behind the other. ``weights`` has a row a class, the intercept last;
    a single row is that of class 1 against class 0."""
    classes, width = weights.shape
    size = classes * width
    loss, gradient, hessian = 0.0, np.zeros((classes, width)), np.zeros((size, size))
    for at in range(0, len(block), ROWS):
        label, w = block[at:at + ROWS, 0].astype(int), block[at:at + ROWS, 1]
        x = np.column_stack([block[at:at + ROWS, 2:], np.ones(len(w))])
        z = x @ weights.T
        if classes == 1:
            z = np.column_stack([np.zeros(len(w)), z])
        z -= z.max(axis=1, keepdims=True)
        log_sum = np.log(np.exp(z).sum(axis=1))
        loss += float(w @ (log_sum - z[np.arange(len(w)), label]))
        p = np.exp(z - log_sum[:, None])
        hit = label[:, None] == np.arange(z.shape[1])
        p, hit = p[:, -classes:], hit[:, -classes:]
        gradient += ((p - hit) * w[:, None]).T @ x
        px = (p[:, :, None] * x[:, None, :]).reshape(len(w), size)
        hessian -= (px * w[:, None]).T @ px
        for k in range(classes):
            own = slice(k * width, (k + 1) * width)
            hessian[own, own] += (x * (w * p[:, k])[:, None]).T @ x
    return np.concatenate([[loss], gradient.ravel(), hessian.ravel()])


class RidgeLogisticModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """``rawPrediction`` (margins; of two classes the first has 0), ``probability`` and ``prediction``, the likeliest class (the
    first of equals)."""

    coefficients = Param(Params._dummy(), "coefficients", "a row a class, one behind the other; a single row of class 1",
                         typeConverter=TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "a number a class", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", coefficients: list | None = None, intercepts: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def interceptVector(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.intercepts))

    @property
    def coefficientMatrix(self) -> DenseMatrix:
        values, rows = self.getOrDefault(self.coefficients), len(self.getOrDefault(self.intercepts))
        return DenseMatrix(rows, len(values) // rows, values, True)

    @property
    def numClasses(self) -> int:
        return max(2, len(self.getOrDefault(self.intercepts)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        matrix, free = self.coefficientMatrix.toArray(), self.interceptVector.toArray()
        if len(free) == 1:
            matrix, free = np.vstack([0 * matrix, matrix]), np.append(0.0, free)
        rows = F.array(*[F.struct(F.array(*[F.lit(float(v)) for v in row]).alias("w"), F.lit(float(b)).alias("b"))
                         for row, b in zip(matrix, free, strict=True)])
        margins = F.transform(rows, lambda r: F.aggregate(
            F.zip_with("_x", r["w"], lambda x, w: x * w), r["b"], lambda s, v: s + v))
        total = F.aggregate("_e", F.lit(0.0), lambda s, e: s + e)
        return (dataset.withColumn("_x", vector_to_array(F.col(self.getFeaturesCol()))).withColumn("_z", margins)
                .withColumn("_e", F.transform("_z", lambda z: F.exp(z - F.array_max("_z")))).withColumns({
                    "rawPrediction": array_to_vector("_z"),
                    "probability": array_to_vector(F.transform("_e", lambda e: e / total)),
                    "prediction": (F.array_position("_z", F.array_max("_z")) - 1).cast("double")})
                .drop("_x", "_z", "_e"))


class RidgeLogistic(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasRegParam, HasMaxIter, HasTol):
    """Fitted by full Newton steps, halved while they do not lower the loss. ``tol`` bounds how far the loss may still be
    from its minimum, as a share of it; ``maxIter`` the rounds. Labels are 0 to the number of classes less one."""

    family = Param(Params._dummy(), "family", "binomial | multinomial", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", weightCol: str | None = None,
                 regParam: float = 0.0, maxIter: int = 100, tol: float = 1e-12, family: str = "multinomial"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", regParam=0.0, maxIter=100, tol=1e-12, family="multinomial")

    def _fit(self, dataset: DataFrame) -> RidgeLogisticModel:
        label = F.col(self.getLabelCol()).cast("double")
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        rows = dataset.select(label.alias("y"), weight.alias("w"), vector_to_array(F.col(self.getFeaturesCol())).alias("x"))
        blocks = rows.mapInArrow(packed, "width long, block binary").rdd.map(
            lambda r: np.frombuffer(r["block"]).reshape(-1, r["width"])).persist()
        try:
            top, total, width = blocks.map(lambda b: (b[:, 0].max(), b[:, 1].sum(), b.shape[1])).reduce(
                lambda a, b: (max(a[0], b[0]), a[1] + b[1], a[2]))
            classes = 1 if self.getOrDefault(self.family) == "binomial" else int(top) + 1
            weights = self._minimum(blocks, np.zeros((classes, width - 1)), total)
        finally:
            blocks.unpersist()
        return RidgeLogisticModel(featuresCol=self.getFeaturesCol(), coefficients=weights[:, :-1].ravel().tolist(),
                                  intercepts=weights[:, -1].tolist())

    def _minimum(self, blocks, weights: np.ndarray, total: float) -> np.ndarray:
        penalty = np.full(weights.shape, self.getRegParam())
        penalty[:, -1] = 0.0

        def at(w: np.ndarray) -> tuple:
            sums = blocks.treeAggregate(0.0, lambda s, b: s + parts_of(b, w), lambda a, b: a + b) / total
            hessian = sums[1 + w.size:].reshape(w.size, w.size) + np.diag(penalty.ravel())
            return sums[0] + (penalty * w * w).sum() / 2, sums[1:1 + w.size] + (penalty * w).ravel(), hessian

        # a number added to all intercepts changes nothing: steps leave their sum as it is
        shift = np.zeros(weights.shape)
        shift[:, -1] = 1.0 if len(weights) > 1 else 0.0
        shift = np.outer(shift, shift)
        loss, gradient, hessian = at(weights)
        step, scale = None, 1.0
        for _ in range(self.getMaxIter()):
            step = np.linalg.lstsq(hessian + shift, gradient, rcond=None)[0]
            gain = float(gradient @ step) / 2
            if gain <= self.getTol() * abs(loss):
                break
            for halving in range(HALVINGS):
                scale = 0.5 ** halving
                moved = weights - scale * step.reshape(weights.shape)
                found = at(moved)
                if found[0] <= loss - 1e-4 * scale * gain:
                    break
            else:
                break
            weights, (loss, gradient, hessian) = moved, found
        return weights
