"""Classification metrics as aggregations (one pass, tiny outputs).

Zero division gives 0 everywhere, as the reports being reproduced do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard import schema as S


def _div0(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, actual: str, predicted: str,
                     labels: list | None = None) -> DataFrame:
    """Long confusion matrix ``(actual, predicted, n)`` with every cell of the
    label grid, zero cells included.  Labels default to the union of actual
    and predicted values.

    One pass over ``df``: its counts, at most one row per pair of labels that
    occurs, become one array, from which labels and grid are taken.
    """
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    cells = counts.agg(F.collect_list(F.struct("actual", "predicted", "n")).alias("c"))
    if labels is None:
        seen = F.array_distinct(F.concat(F.transform("c", lambda e: e["actual"]), F.transform("c", lambda e: e["predicted"])))
        labs = F.filter(seen, lambda x: x.isNotNull())
    else:
        labs = F.array(*[F.lit(x) for x in labels])
    grid = cells.withColumn("l", labs).select("c", "l", F.explode("l").alias("actual")).select(
        "c", "actual", F.explode("l").alias("predicted"))
    n = F.aggregate(F.filter("c", lambda e: (e["actual"] == F.col("actual")) & (e["predicted"] == F.col("predicted"))),
                    F.lit(0).cast("long"), lambda a, e: a + e["n"])
    return grid.select("actual", "predicted", n.alias("n"))


def per_class_scores(cm: DataFrame) -> DataFrame:
    """``(label, tp, support, predicted, precision, recall, f1)`` from a long
    matrix: each cell counts for its actual and its predicted label."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = cm.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("s"), hit.alias("t"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"),
                 F.col("n").alias("p")))).alias("e")).select("e.*")
    t = sides.groupBy("label").agg(F.sum("t").cast("long").alias("tp"), F.sum("s").cast("long").alias("support"),
                                   F.sum("p").cast("long").alias("predicted"))
    return t.select(
        "label", "tp", "support", "predicted", _div0(F.col("tp"), F.col("predicted")).alias("precision"),
        _div0(F.col("tp"), F.col("support")).alias("recall"),
        _div0(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"))


def classification_report(cm: DataFrame, digits: int = 6) -> DataFrame:
    """Per-class precision / recall / F1 / support plus 'accuracy',
    'macro avg' and 'weighted avg' rows (accuracy sits in ``f1``).  The three
    rows come from the first class's row, so the matrix is read once."""
    every = Window.partitionBy()
    pc = per_class_scores(cm)
    total = F.sum("support").over(every)

    def mean(c):
        return F.avg(c).over(every)

    def weighted(c):
        return _div0(F.sum(F.col(c) * F.col("support")).over(every), total)

    def row(label, precision, recall, f1, support):
        return F.struct(label.cast("string").alias("label"), precision.cast("double").alias("precision"),
                        recall.cast("double").alias("recall"), f1.cast("double").alias("f1"),
                        support.cast("long").alias("support"))

    none = F.lit(None)
    own = row(F.col("label"), F.col("precision"), F.col("recall"), F.col("f1"), F.col("support"))
    summary = [row(F.lit("accuracy"), none, none, F.col("_acc"), F.col("_tot")),
               row(F.lit("macro avg"), F.col("_mp"), F.col("_mr"), F.col("_mf"), F.col("_tot")),
               row(F.lit("weighted avg"), F.col("_wp"), F.col("_wr"), F.col("_wf"), F.col("_tot"))]
    t = pc.withColumns({
        "_tot": total, "_acc": _div0(F.sum("tp").over(every), total),
        "_mp": mean("precision"), "_mr": mean("recall"), "_mf": mean("f1"),
        "_wp": weighted("precision"), "_wr": weighted("recall"), "_wf": weighted("f1"),
        "_first": F.row_number().over(Window.orderBy("label")) == 1})
    rows = t.select(F.explode(F.when(F.col("_first"), F.array(own, *summary)).otherwise(F.array(own))).alias("r")).select("r.*")
    return rows.select("label", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def macro_f1(df: DataFrame, actual: str, predicted: str) -> float:
    """Unweighted mean of per-class F1 over the union of labels (a scalar)."""
    pc = per_class_scores(confusion_matrix(df, actual, predicted))
    v = pc.agg(F.avg("f1")).first()[0]
    return float(v or 0.0)


def binary_counts(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """One row: tp, fp, fn, tn for a 0/1 label and a boolean prediction."""
    y = F.col(label) == 1
    return df.agg(
        F.sum((y & pred).cast("long")).alias("tp"), F.sum((~y & pred).cast("long")).alias("fp"),
        F.sum((y & ~pred).cast("long")).alias("fn"), F.sum((~y & ~pred).cast("long")).alias("tn"))


def binary_scores(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("*", _div0(tp, tp + fn).alias("recall"), _div0(tp, tp + fp).alias("precision"),
                         _div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


def binary_f1(df: DataFrame, label: str, pred: Column) -> float:
    return float(binary_scores(binary_counts(df, label, pred)).first()["f1"])


# --- threshold search ---------------------------------------------------------

def thresholds(n: int = S.THRESHOLD_COUNT, start: float = 0.01, stop: float = 0.99) -> list[float]:
    """Evenly spaced thresholds computed like numpy.linspace (i*step + start,
    last one set to ``stop``), so they agree bit for bit."""
    step = (stop - start) / (n - 1)
    vals = [i * step + start for i in range(n)]
    vals[-1] = stop
    return vals


def cleared(score: Column, grid: list[float] | None) -> Column:
    """How many thresholds of a rising grid a score reaches.  On the even grid
    (None) the place is computed, then settled by the three thresholds around
    it, each made as ``thresholds`` makes it."""
    if grid is not None:
        return F.size(F.filter(F.array(*[F.lit(float(t)) for t in grid]), lambda t: t <= score))
    n, even = S.THRESHOLD_COUNT, thresholds()
    step = (even[-1] - even[0]) / (n - 1)
    place = F.floor((score - F.lit(even[0])) / F.lit(step)).cast("int")
    low = F.least(F.greatest(place - 1, F.lit(0)), F.lit(n - 3))

    def reached(i: Column) -> Column:
        at = F.when(i == n - 1, F.lit(even[-1])).otherwise(i.cast("double") * F.lit(step) + F.lit(even[0]))
        return (at <= score).cast("int")

    return low + reached(low) + reached(low + 1) + reached(low + 2)


def threshold_sweep(df: DataFrame, label: str, score: str,
                    grid: list[float] | None = None) -> DataFrame:
    """Recall, precision and F1 of ``score >= t`` for every threshold t.

    One pass: each row finds how many thresholds it clears, rows are counted
    per (level, label) -- at most 2 x 100 groups -- and reverse cumulative sums
    give tp and predicted positives per level.
    """
    level = cleared(F.col(score), grid)
    grid = grid or thresholds()
    n = len(grid)
    counts = (df.where(F.col(score).isNotNull())
              .groupBy(level.alias("level")).agg(
                  F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                  F.count(F.lit(1)).alias("cnt")))
    spark = df.sparkSession
    dense = (spark.range(0, n + 1).select(F.col("id").cast("int").alias("level"))
             .join(counts, on="level", how="left").fillna(0, subset=["pos", "cnt"]))
    rev = Window.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    cum = dense.select("level", F.sum("pos").over(rev).alias("tp"), F.sum("cnt").over(rev).alias("pp"),
                       F.sum("pos").over(every).alias("P"))
    thr = spark.createDataFrame([(i + 1, float(t)) for i, t in enumerate(grid)], "level int, threshold double")
    t = thr.join(cum, on="level")
    return t.select("threshold", F.col("tp").cast("long").alias("tp"),
                    (F.col("pp") - F.col("tp")).cast("long").alias("fp"),
                    (F.col("P") - F.col("tp")).cast("long").alias("fn"),
                    _div0(F.col("tp"), F.col("P")).alias("recall"),
                    _div0(F.col("tp"), F.col("pp")).alias("precision"),
                    _div0(2 * F.col("tp"), F.col("P") + F.col("pp")).alias("f1"))


def best_threshold(sweep: DataFrame, recall_target: float = S.RECALL_TARGET) -> DataFrame:
    """One row: the threshold with the best F1 among those whose recall reaches
    the target (lowest threshold on ties); if none does, the one with the
    highest recall (lowest threshold on ties).  ``reached`` tells which."""
    ok = F.col("recall") >= F.lit(float(recall_target))
    ranked = sweep.withColumn("reached", F.max(ok).over(Window.partitionBy()))
    order = Window.orderBy(
        F.when(F.col("reached"), F.when(ok, F.col("f1"))).otherwise(F.col("recall")).desc_nulls_last(),
        F.col("threshold"))
    return (ranked.withColumn("_r", F.row_number().over(order)).where("_r = 1")
            .select("threshold", "recall", "precision", "f1", "reached"))


def best_threshold_value(sweep: DataFrame, recall_target: float = S.RECALL_TARGET) -> float:
    return float(best_threshold(sweep, recall_target).first()["threshold"])
