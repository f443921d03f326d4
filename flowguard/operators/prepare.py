"""Fitted preparation that is saved with a trained stage: a population scaler and a remover of constant columns."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.operators.clean import numeric_columns


class PopulationScalerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / std of each element; an element with std 0 is only centred."""

    mean = Param(Params._dummy(), "mean", "means", typeConverter=TypeConverters.toListFloat)
    std = Param(Params._dummy(), "std", "population standard deviations", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, mean: list | None = None,
                 std: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        means = F.array(*[F.lit(v) for v in self.getOrDefault(self.mean)])
        scale = F.array(*[F.lit(v if v > 0 else 1.0) for v in self.getOrDefault(self.std)])
        centred = F.zip_with(vector_to_array(F.col(self.getInputCol())), means, lambda x, m: x - m)
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.zip_with(centred, scale, lambda x, s: x / s)))


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Standardises a vector column to mean 0 and population standard deviation 1; fitted in one pass."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        if dataset.isEmpty():
            raise ValueError("no rows to fit the scaler on")
        s = dataset.select(Summarizer.metrics("mean", "variance", "count").summary(
            F.col(self.getInputCol())).alias("s")).first()["s"]
        n = s["count"]
        std = [math.sqrt(v * (n - 1) / n) for v in s["variance"].toArray()]
        return PopulationScalerModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                                     mean=s["mean"].toArray().tolist(), std=std)


class ConstantColumnModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Drops the columns that were constant on the fit data, from any table that has them."""

    dropped = Param(Params._dummy(), "dropped", "constant columns", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list | None = None, dropped: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def kept(self) -> list[str]:
        gone = set(self.getOrDefault(self.dropped))
        return [c for c in self.getInputCols() if c not in gone]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault(self.dropped))


class ConstantColumnRemover(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Finds the numeric columns without variance in one pass over the training rows: two values at least, all equal and
    finite; nulls do not count. Without ``inputCols`` every numeric column is looked at."""

    @keyword_only
    def __init__(self, *, inputCols: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ConstantColumnModel:
        columns = self.getInputCols() if self.isSet(self.inputCols) else numeric_columns(dataset)
        at = [F.col(f"`{c}`").cast("double") for c in columns]
        row = dataset.agg(*[x for i, c in enumerate(at) for x in (
            F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.count(c).alias(f"n{i}"))]).first() if columns else None
        dropped = [c for i, c in enumerate(columns)
                   if row[f"n{i}"] > 1 and row[f"lo{i}"] == row[f"hi{i}"] and math.isfinite(row[f"lo{i}"])]
        return ConstantColumnModel(inputCols=columns, dropped=dropped)
