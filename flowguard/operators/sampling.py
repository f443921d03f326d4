"""Exact stratified splits, samples, holdout and folds.

Per-class sizes follow the largest-remainder allocation of a stratified
shuffle split (the test side takes the complement); which rows go where is
decided by the per-class rank of ``md5(seed:row_id)`` (see ranking.py), so a
split is reproducible, equal in any engine, and never funnels a class through
one task.  Allocation tables have one row per class.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators.distribution import class_counts
from flowguard.operators.joins import anti_join, bounded_broadcast, semi_join  # noqa: F401
from flowguard.operators.ranking import ClassRanks

PART = "part"
IN_HOLDOUT = "in_holdout"


def collect_counts(df: DataFrame, label: str) -> dict:
    """``{class: n}`` (nulls excluded): one row per class."""
    return {r[0]: int(r[1]) for r in class_counts(df, label).collect()}


def known(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(f"`{label}`").isNotNull())


def split_allocation(counts: dict, test) -> dict:
    """Per-class train sizes of an exact stratified two-way split.

    ``test`` is a fraction (``ceil(test * total)`` rows) or a row count.
    Train sizes are the floor of the proportional share plus one for the
    largest remainders (ties by class); the test side is the complement.
    The arithmetic is double precision, in the same order as a stratified
    shuffle split computes it.
    """
    total = sum(counts.values())
    n_test = math.ceil(float(test) * total) if isinstance(test, float) else int(test)
    draw = total - n_test
    cont = {c: n / total * draw for c, n in counts.items()}
    train = {c: math.floor(v) for c, v in cont.items()}
    need = draw - sum(train.values())
    for c in sorted(counts, key=lambda c: (-(cont[c] - train[c]), c))[:max(need, 0)]:
        train[c] += 1
    return train


def check_split(counts: dict, train: dict, what: str) -> None:
    """The preconditions of a stratified split (classes >= 2, sides >= #classes)."""
    if not counts:
        raise ValueError(f"{what}: empty input")
    mn = min(counts.values())
    if mn < 2:
        raise ValueError(f"{what}: the least populated class has {mn} member(s); "
                         "every class needs at least 2")
    total, n_train = sum(counts.values()), sum(train.values())
    if not 0 < n_train < total:
        raise ValueError(f"{what}: test size {total - n_train} must lie in (0, {total})")
    if n_train < len(counts) or total - n_train < len(counts):
        raise ValueError(f"{what}: both sides need at least {len(counts)} rows (one per class)")


def stratified_split(df: DataFrame, label: str, test=S.TEST_FRACTION, seed: int = S.SEED,
                     row_id: str = S.ROW_ID, out: str = PART) -> DataFrame:
    """Add ``out`` = 'train' / 'test' (exact stratified two-way split)."""
    ranks = ClassRanks(known(df, label), label, seed, row_id)
    train = split_allocation(ranks.counts(), test)
    check_split(ranks.counts(), train, "stratified_split")
    return ranks.assign([(c, k, 0, "train") for c, k in train.items()], out, "test")


def three_way_split(df: DataFrame, label: str, val: float = S.VAL_FRACTION,
                    test: float = S.TEST_FRACTION, seed: int = S.SEED,
                    row_id: str = S.ROW_ID, out: str = PART) -> DataFrame:
    """Add ``out`` = 'train' / 'val' / 'test'.

    Test first (``test`` of all rows), then validation as ``val/(1-test)`` of
    the rest, both stratified: n=100 with classes 80/20 gives 69/16/15 and
    train classes 55/14.  One hash ranking serves both splits: the first
    ranks of a class are train, the next validation, the rest test.
    """
    ranks = ClassRanks(known(df, label), label, seed, row_id)
    a1 = split_allocation(ranks.counts(), test)
    check_split(ranks.counts(), a1, "three_way_split (test)")
    a2 = split_allocation(a1, val / (1.0 - test))
    check_split(a1, a2, "three_way_split (validation)")
    bounds = [(c, k, 0, "train") for c, k in a2.items()] + [(c, k, 1, "val") for c, k in a1.items()]
    return ranks.assign(bounds, out, "test")


def stratified_sample(df: DataFrame, label: str, size=S.SAMPLE_SIZE, seed: int = S.SEED,
                      row_id: str = S.ROW_ID, size_range: tuple[int, int] | None =
                      (S.SAMPLE_SIZE_MIN, S.SAMPLE_SIZE_MAX)) -> DataFrame:
    """Exact stratified sample of ``size`` rows (int) or of a fraction (float).

    The sample is the test side of a stratified split.  An absolute size is
    checked against ``size_range`` before any job runs.
    """
    if isinstance(size, int) and size_range is not None:
        lo, hi = size_range
        if not lo <= size <= hi:
            raise ValueError(f"sample size {size} must lie between {lo} and {hi} rows")
    split = stratified_split(df, label, size, seed, row_id, out="_side")
    return split.where(F.col("_side") == "test").drop("_side")


def rare_classes(df: DataFrame, label: str, min_samples: int) -> DataFrame:
    """``(label, n)`` of classes with fewer than ``min_samples`` rows."""
    return class_counts(df, label).where(F.col("n") < min_samples)


def drop_rare_classes(df: DataFrame, label: str, min_samples: int = S.MIN_CLASS_SIZE) -> DataFrame:
    """Remove the rows of classes with fewer than ``min_samples`` rows, and
    rows without label (the rare-class list is a small aggregate, applied as
    an IN filter)."""
    rare = [c for c, n in collect_counts(df, label).items() if n < min_samples]
    left = known(df, label)
    return left.where(~F.col(f"`{label}`").isin(rare)) if rare else left


def with_holdout(df: DataFrame, label: str = S.TARGET_FAMILY, test: float = S.HOLDOUT_FRACTION,
                 seed: int = S.SEED, row_id: str = S.ROW_ID) -> DataFrame:
    """``df`` with ``in_holdout``: whether a row belongs to the shared holdout,
    the test side of a stratified split.  Rows of classes with < 2 rows, and
    rows without label, do not.  No join: the side is a column of the row."""
    ranks = ClassRanks(df, label, seed, row_id)
    counts = {c: n for c, n in ranks.counts().items() if n >= S.MIN_STRATIFY_SIZE}
    train = split_allocation(counts, test)
    check_split(counts, train, "canonical_holdout")
    return ranks.assign([(c, k, 0, False) for c, k in train.items()], IN_HOLDOUT, True, missing=False)


def canonical_holdout(df: DataFrame, label: str = S.TARGET_FAMILY, test: float = S.HOLDOUT_FRACTION,
                      seed: int = S.SEED, row_id: str = S.ROW_ID) -> DataFrame:
    """Keys ``(row_id)`` of the shared holdout (see ``with_holdout``), to be
    persisted for jobs that read the table later."""
    return with_holdout(df, label, test, seed, row_id).where(IN_HOLDOUT).select(row_id)


def outside_holdout(df: DataFrame, **options) -> DataFrame:
    """Training data in one pass: the rows that ``with_holdout`` leaves."""
    return with_holdout(df, **options).where(~F.col(IN_HOLDOUT)).drop(IN_HOLDOUT)


def inside_holdout(df: DataFrame, **options) -> DataFrame:
    """Evaluation data in one pass: the rows that ``with_holdout`` holds back."""
    return with_holdout(df, **options).where(IN_HOLDOUT).drop(IN_HOLDOUT)


def exclude_holdout(df: DataFrame, holdout: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    """Training data: every row not in a persisted holdout."""
    return anti_join(df, holdout, row_id)


def holdout_rows(df: DataFrame, holdout: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    """Evaluation data: the rows in a persisted holdout."""
    return semi_join(df, holdout, row_id)


def fold_allocation(counts: dict, n_folds: int = S.CV_FOLDS) -> dict:
    """``{class: [rows in fold 0, ..., fold k-1]}`` of an unshuffled
    stratified k-fold: labels sorted by name are dealt round-robin to the
    folds, so class c at sorted positions [a, b) gets, in fold i, the number
    of positions p in [a, b) with p mod k = i.  Within a class folds are
    contiguous blocks of its order."""
    out, a = {}, 0
    for c in sorted(counts):
        b = a + counts[c]

        def upto(x, i):  # positions p < x with p mod k == i
            return (x - i + n_folds - 1) // n_folds
        out[c] = [upto(b, i) - upto(a, i) for i in range(n_folds)]
        a = b
    return out


def stratified_folds(df: DataFrame, label: str, n_folds: int = S.CV_FOLDS, seed: int = S.SEED,
                     row_id: str = S.ROW_ID, out: str = "fold") -> DataFrame:
    """Add ``out`` (0..n_folds-1): stratified k-fold assignment by hash rank."""
    ranks = ClassRanks(known(df, label), label, seed, row_id)
    counts = ranks.counts()
    if not counts or max(counts.values()) < n_folds:
        raise ValueError(f"n_splits={n_folds} cannot be greater than the number of members in each class")
    bounds = []
    for c, sizes in fold_allocation(counts, n_folds).items():
        k = 0
        for i, m in enumerate(sizes):
            k += m
            bounds.append((c, k, i, i))
    return ranks.assign(bounds, out, n_folds - 1)


def sample_audit(full: DataFrame, sample: DataFrame, label: str,
                 max_dev: float = S.SAMPLE_MAX_DEVIATION_PP) -> DataFrame:
    """Per class: share in the full data and in the sample (percent), deviation,
    'OK' / 'ERRO (>2%)' and the overall verdict ``validated``.  Never fails."""
    every = Window.partitionBy()

    def pct(df, name):
        c = class_counts(df, label)
        return c.select(f"`{label}`", (F.col("n").cast("double") * F.lit(100.0)
                                        / F.sum("n").over(every).cast("double")).alias(name))
    f = pct(full, "full_pct")
    s = pct(sample, "sample_pct")
    t = (f.join(bounded_broadcast(s), on=label, how="left").fillna(0.0, subset=["sample_pct"])
         .withColumn("deviation", F.col("sample_pct") - F.col("full_pct")))
    ok = F.abs(F.col("deviation")) <= F.lit(float(max_dev))
    return (t.withColumn("status", F.when(ok, "OK").otherwise("ERRO (>2%)"))
            .withColumn("validated", F.bool_and(ok).over(every)))

