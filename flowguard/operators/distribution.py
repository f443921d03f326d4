"""Class counts and distributions (partial aggregation, tiny outputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """``(column, n)``; nulls dropped unless ``keep_null`` (value_counts(dropna=False))."""
    src = df if keep_null else df.where(F.col(f"`{column}`").isNotNull())
    return src.groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias("n"))


def with_share(counts: DataFrame, n: str = "n", out: str = "pct") -> DataFrame:
    """Percent of the total; the total is a window over the (small) count table."""
    total = F.sum(n).over(Window.partitionBy())
    return counts.withColumn(out, F.col(n).cast("double") * F.lit(100.0) / total.cast("double"))


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts and percent per class, largest first, label as tie-break."""
    return (with_share(class_counts(df, column))
            .orderBy(F.desc("n"), F.col(f"`{column}`")))
