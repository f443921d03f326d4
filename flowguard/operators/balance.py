"""Fit-time class balancing: undersampling, SMOTE and balanced class weights.

All three run as DataFrame jobs on the training fold.  Every decision (which
rows to keep, which neighbour, the interpolation factor) is drawn from
``md5(seed:...)`` so runs are reproducible.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators.distribution import class_counts
from flowguard.operators.neighbours import knn_within_class
from flowguard.operators.ranking import ClassRanks
from flowguard.operators.sampling import collect_counts
from flowguard.session import cut


SHORT = 500     # rows that FoldNeighbours compares with all of their class


# --- undersampling ------------------------------------------------------------

def undersample_plan(counts: dict, ratio: float = S.UNDERSAMPLE_RATIO) -> dict:
    """``{class: rows kept}``: every class but the minority keeps
    ``int(n_minority / ratio)`` rows; raises if that exceeds a class's size."""
    minority = min(sorted(counts, key=repr), key=lambda c: counts[c])
    n_min = counts[minority]
    plan = {c: (n if c == minority else int(n_min / ratio)) for c, n in counts.items()}
    if any(plan[c] > counts[c] for c in counts):
        raise ValueError("the requested ratio would need new majority rows while undersampling; "
                         "increase the ratio (minority/majority is already above it)")
    return plan


def undersample(df: DataFrame, label: str, ratio: float = S.UNDERSAMPLE_RATIO, seed: int = S.SEED,
                row_id: str = S.ROW_ID) -> DataFrame:
    """Keep ``int(n_min/ratio)`` rows of every non-minority class (without
    replacement, by hash rank); the minority class is untouched."""
    ranks = ClassRanks(df, label, seed, row_id)
    plan = undersample_plan(ranks.counts(), ratio)
    out = ranks.assign([(c, k, 0, True) for c, k in plan.items()], "_keep", False, missing=False)
    return out.where("_keep").drop("_keep")


# --- class weights ------------------------------------------------------------

def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, weight)`` with weight = n / (n_classes * n_class)."""
    every = Window.partitionBy()
    c = class_counts(df, label)
    return c.select(f"`{label}`", (F.sum("n").over(every).cast("double")
                                   / (F.count(F.lit(1)).over(every) * F.col("n")).cast("double")).alias("weight"))


def with_balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Adds the balanced weight of each row's class (a per-class literal map)."""
    counts = collect_counts(df, label)
    total, k = sum(counts.values()), len(counts)
    w = F.create_map(*[x for c, n in counts.items() for x in (F.lit(c), F.lit(float(total) / float(k * n)))])
    return df.withColumn(out, F.element_at(w, F.col(label)))


def smote_k(counts: dict, k: int = S.SMOTE_K, floor_one: bool = True) -> int:
    """Neighbour count from the smallest class: min(k, max(1, n_min-1)) or
    min(k, n_min-1)."""
    n_min = min(counts.values())
    return min(k, max(1, n_min - 1)) if floor_one else min(k, n_min - 1)


def _u(seed: int, *parts: Column) -> Column:
    """Uniform double in [0, 1) from md5(seed:parts)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def draws_with_replacement(ranks: ClassRanks, wanted: dict, seed: int = S.SEED) -> DataFrame:
    """``(label, pid, draw)``: for each class of ``wanted`` that many draws of its rows, with replacement.

    Draw number d (from 1) of a class takes the row of rank floor(u * n) + 1 by hash, u from the seed, the class and d.
    """
    counts, spark, kind = ranks.counts(), ranks.df.sparkSession, ranks.keyed.schema["_g"].dataType.simpleString()
    plan = spark.createDataFrame([(c, int(m), counts[c]) for c, m in wanted.items() if m > 0],
                                 f"_g {kind}, _m long, _size long")
    # blocks of draw numbers first, so that the draws of one class are dealt out before they are listed
    block = 10_000
    drawn = (plan.withColumn("_i", F.explode(F.sequence(F.lit(0), F.floor((F.col("_m") - 1) / block))))
             .repartition("_g", "_i")
             .withColumn("draw", F.explode(F.sequence(F.col("_i") * block + 1, F.least("_m", (F.col("_i") + 1) * block))))
             .withColumn("_rank", F.floor(_u(seed, F.lit("base"), F.col("_g"), F.col("draw")) * F.col("_size")) + 1))
    return (drawn.join(ranks.ranked(), ["_g", "_rank"])
            .select(F.col("_g").alias(ranks.group), F.col("_id").alias("pid"), F.col("draw").cast("int").alias("draw")))


# --- SMOTE ----------------------------------------------------------------------

def smote(df: DataFrame, label: str, features: str = "features", k: int = S.SMOTE_K,
          seed: int = S.SEED, row_id: str = S.ROW_ID, replacement: bool = False,
          near: DataFrame | None = None) -> DataFrame:
    """Raise every class to the majority size with synthetic rows
    x + u * (neighbour - x), neighbour uniform among the k nearest rows of
    the same class, u uniform in [0, 1).

    Base rows are used evenly: class c needs ``need = n_max - n_c`` rows; each
    base row yields ``need div n_c`` rows and the first ``need mod n_c`` rows
    (by hash rank) one more.  With ``replacement`` the base rows are drawn with
    replacement instead, and ``draw`` numbers the draws of a class.  ``near`` gives the neighbours (label, pid, nn_rank,
    nn_pid) if they are known.  Output: ``label``, ``features``, ``synthetic``,
    ``base_id``, ``draw`` (0 for originals, which pass through) and ``nn_pid``.
    """
    ranks = ClassRanks(df.select(label, row_id, features), label, seed, row_id)
    counts = ranks.counts()
    n_max = max(counts.values()) if counts else 0
    need = {c: n_max - n for c, n in counts.items() if n < n_max}
    given = df.select(label, features, F.lit(False).alias("synthetic"), F.col(row_id).alias("base_id"),
                      F.lit(0).alias("draw"), F.lit(None).cast("long").alias("nn_pid"))
    if not need:
        return given
    small = min(counts[c] for c in need)
    if small <= k:
        raise ValueError(f"expected n_neighbors <= n_samples_fit, but n_samples_fit = {small}, "
                         f"n_neighbors = {k + 1}")
    # the first (need mod n) rows of a class by hash rank yield one row more
    reps = F.lit(0)
    for c, m in need.items():
        reps = F.when(F.col(label) == F.lit(c), F.lit(m // counts[c])).otherwise(reps)
    base = cut(ranks.assign([(c, m % counts[c], 0, 1) for c, m in need.items()], "_extra", 0)
               .where(F.col("_extra").isNotNull())
               .select(label, F.col(row_id).alias("pid"), vector_to_array(F.col(features)).alias("x"),
                       (reps + F.col("_extra")).alias("_reps")))
    near = knn_within_class(base.select(label, "pid", "x"), label, k) if near is None else near
    pick = (F.floor(_u(seed, F.lit("nn"), F.col("pid"), F.col("draw")) * F.lit(k)) + 1).cast("int")
    if replacement:
        drawn = draws_with_replacement(ranks, need, seed).join(base.drop("_reps"), on=[label, "pid"])
    else:
        drawn = base.where("_reps > 0").withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("_reps"))))
    made = (drawn.withColumn("nn_rank", pick)
            .join(near.select(label, "pid", "nn_rank", "nn_pid"), on=[label, "pid", "nn_rank"])
            .join(base.select(label, F.col("pid").alias("nn_pid"), F.col("x").alias("_nx")), on=[label, "nn_pid"])
            .withColumn("_g", _u(seed, F.lit("gap"), F.col("pid"), F.col("draw")))
            .select(label, array_to_vector(F.zip_with("x", "_nx", lambda a, b: a + F.col("_g") * (b - a))).alias(features),
                    F.lit(True).alias("synthetic"), F.col("pid").alias("base_id"), "draw", "nn_pid"))
    return given.unionByName(made)


class FoldNeighbours:
    """The k nearest rows of a class among those outside a fold, for every fold, from one search.

    ``df`` has ``label``, ``row_id``, the vector ``features`` and ``fold``.  All rows are searched once, for more neighbours
    than k; the first k outside a fold are those that a search without the fold would find. If every fold scales its
    vectors by itself, ``plain`` is the vector ahead of scaling: neighbours are then put in order by the distances of
    the fold. A row that is not listed is at least as far as the last one that is, times the least stretch between
    the two scales; the k-th distance has to be below that. Rows of which this does not tell the k nearest are
    compared with all rows of their class, or if they are many (SHORT), the fold is searched anew.
    """

    def __init__(self, df: DataFrame, label: str, features: str, k: int, row_id: str = S.ROW_ID, plain: str | None = None):
        self.label, self.k, self.most = label, k, 2 * k + 4
        rows = cut(df.select(label, F.col(row_id).alias("pid"), vector_to_array(F.col(features)).alias("x"), "fold",
                             (vector_to_array(F.col(plain)) if plain else F.lit(None).cast("array<double>")).alias("p")))
        counts: dict = {}
        for c, fold, n in rows.groupBy(label, "fold").agg(F.count(F.lit(1))).collect():
            counts.setdefault(c, {})[fold] = n
        # classes that SMOTE raises with all rows or without one of the folds
        folds = {f for per in counts.values() for f in per}
        sizes = [{c: sum(n for f, n in per.items() if f != left) for c, per in counts.items()} for left in (None, *folds)]
        small = sorted({c for size in sizes for c, n in size.items() if n < max(size.values())}, key=repr)
        self.rows = rows.where(F.col(label).isin(small)) if small else rows.limit(0)
        near = knn_within_class(self.rows.select(label, "pid", "x"), label, self.most)
        others = self.rows.select(label, F.col("pid").alias("nn_pid"), F.col("fold").alias("nn_fold"), F.col("p").alias("np"))
        lists = near.join(others, [label, "nn_pid"]).groupBy(label, "pid").agg(
            F.array_sort(F.collect_list(F.struct("nn_rank", "nn_pid", "nn_fold", "dist", "np"))).alias("list"))
        # a row without neighbours has an empty list
        self.lists = cut(self.rows.select(label, "pid", "fold", "p").join(lists, [label, "pid"], "left").withColumn(
            "list", F.coalesce("list", F.array().cast(lists.schema["list"].dataType))))

    def without(self, fold: int | None = None, scale: tuple | None = None) -> DataFrame:
        """(label, pid, nn_rank, nn_pid) of the rows outside ``fold`` (None: of all rows). ``scale`` is the fold's: which
        elements of the plain vector it keeps, their means and divisors, and the least stretch of a distance."""
        label, k = self.label, self.k
        outside = F.lit(True) if fold is None else F.col("fold") != fold
        listed = F.filter("list", lambda e: F.lit(True) if fold is None else e["nn_fold"] != fold)
        apart = lambda x, y: F.sqrt(F.aggregate(
            F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v))
        lists, rows = self.lists.where(outside), self.rows.where(outside)
        if scale is None:
            lists = lists.withColumn("best", F.slice(listed, 1, k)).withColumn("known", F.size("best") >= k)
        else:
            places, means, divisors, stretch = scale
            steps = F.array(*[F.struct(F.lit(int(j)).alias("j"), F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s"))
                              for j, m, s in zip(places, means, divisors, strict=True)])
            scaled = lambda v: F.transform(steps, lambda e: (F.get(v, e["j"]) - e["m"]) / e["s"])
            rows = rows.withColumn("x", scaled(F.col("p")))
            lists = lists.withColumn("q", scaled(F.col("p"))).withColumn("best", F.slice(F.array_sort(F.transform(
                listed, lambda e: F.struct(apart(F.col("q"), scaled(e["np"])).alias("dist"), e["nn_pid"].alias("nn_pid")))), 1, k))
            limit = F.get("list", F.lit(self.most - 1))["dist"] * F.lit(stretch * (1 - 1e-9))   # null: all of a class are listed
            lists = lists.withColumn("known", (F.size("best") >= k) & F.coalesce(F.get("best", F.lit(k - 1))["dist"] <= limit, F.lit(True)))
        lists = cut(lists.select(label, "pid", "known", F.col("best.nn_pid").alias("best")))
        found = lists.where("known").select(label, "pid", F.posexplode("best").alias("i", "nn_pid")).select(
            label, "pid", (F.col("i") + 1).cast("int").alias("nn_rank"), "nn_pid")
        short = lists.where("NOT known").select(label, "pid")
        n = short.count()
        if n == 0:
            return found
        rows = rows.select(label, "pid", "x")
        if n > SHORT:
            return knn_within_class(rows, label, k).select(label, "pid", "nn_rank", "nn_pid")
        pairs = rows.select(label, F.col("pid").alias("nn_pid"), F.col("x").alias("_nx")).join(
            F.broadcast(cut(rows.join(F.broadcast(short), [label, "pid"]))), label).where("nn_pid <> pid").withColumn(
            "dist", apart("x", "_nx"))
        first = F.row_number().over(Window.partitionBy(label, "pid").orderBy("dist", "nn_pid"))
        again = pairs.withColumn("nn_rank", first).where(F.col("nn_rank") <= k).select(label, "pid", "nn_rank", "nn_pid")
        return found.unionByName(again)
