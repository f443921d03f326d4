"""Ridge logistic regression: MLlib's minimum in few rounds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from flowguard.operators import learn as L
from flowguard.operators.logistic import RidgeLogistic, RidgeLogisticModel


def rows(spark, classes, n=600, copies=1):
    rng = np.random.default_rng(classes)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2]
    z = x @ rng.normal(size=(3, classes)) + rng.gumbel(size=(n, classes))
    return spark.createDataFrame([(float(y), float(w), Vectors.dense(v)) for y, w, v in zip(
        z.argmax(axis=1), rng.uniform(0.5, 2.0, n), x, strict=True) for _ in range(copies)], ["label", "weight", "features"]).repartition(3)


@pytest.mark.parametrize(("family", "classes"), [("binomial", 2), ("multinomial", 4)])
def test_minimum_and_predictions_are_those_of_mllib(spark, tmp_path, family, classes):
    df = rows(spark, classes).checkpoint()
    own = RidgeLogistic(weightCol="weight", regParam=1e-4, family=family).fit(df)
    other = LogisticRegression(weightCol="weight", regParam=1e-4, family=family, standardization=False, tol=1e-12,
                               maxIter=1000).fit(df)
    assert np.abs(own.coefficientMatrix.toArray() - other.coefficientMatrix.toArray()).max() < 1e-3
    assert np.abs(own.interceptVector.toArray() - other.interceptVector.toArray()).max() < 1e-3
    own.write().save(str(tmp_path / "m"))
    again = RidgeLogisticModel.load(str(tmp_path / "m"))
    assert again.numClasses == classes
    a, b = ([(r["probability"].toArray(), r["prediction"]) for r in m.transform(df).collect()] for m in (again, other))
    assert max(np.abs(x - y).max() for (x, _), (y, _) in zip(a, b, strict=True)) < 1e-4
    assert sum(x != y for (_, x), (_, y) in zip(a, b, strict=True)) <= 1


def test_a_point_of_the_search_is_fitted_in_few_jobs(spark):
    """Failed before: each of some hundred steps was a job or more."""
    (_, stages, points), = L.candidates(["a", "b", "c"], 2, "lr")
    context, jobs = spark.sparkContext, []
    for copies in (1, 4):
        some = rows(spark, 4, copies=copies).checkpoint()
        context.setJobGroup(f"lr{copies}", "fit")
        stages[-1].copy(points[-1]).fit_prepared(some)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"lr{copies}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert max(jobs) <= 25


def test_a_class_without_rows_and_rows_without_differences(spark):
    df = spark.createDataFrame([(y, 1.0, Vectors.dense([x])) for x, y in [(0.0, 0.0), (1.0, 2.0), (0.5, 0.0), (2.0, 2.0)] * 5],
                               ["label", "weight", "features"])
    model = RidgeLogistic(weightCol="weight", regParam=1e-2).fit(df)
    found = model.transform(df).select("label", "prediction", "probability").collect()
    assert model.numClasses == 3 and all(r["label"] == r["prediction"] and r["probability"][1] < 1e-3 for r in found)
    one = RidgeLogistic(weightCol="weight", regParam=1e-2, family="binomial").fit(df.where("label = 0"))
    assert {r["prediction"] for r in one.transform(df).collect()} == {0.0}
