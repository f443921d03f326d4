"""Cleaning: column names, non-finite values, incomplete rows (all narrow)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from flowguard.functions.expressions import finite_or_null


def strip_column_names(df: DataFrame) -> DataFrame:
    """Trim blanks at both ends of every column name; case is kept.

    Spark accepts duplicate names silently, so a collision after trimming is
    an error here.
    """
    names = [c.strip() for c in df.columns]
    dups = sorted({n for n in names if names.count(n) > 1})
    if dups:
        raise ValueError(f"column names collide after stripping blanks: {dups}")
    return df.toDF(*names)


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type, in schema order (pandas select_dtypes('number'))."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def nonfinite_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """+-Inf and NaN -> null in the floating columns."""
    targets = set(columns if columns is not None else floating_columns(df))
    return df.select(*[
        finite_or_null(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`")
        for c in df.columns
    ])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop a row when any column (label included) is null."""
    return df.na.drop(how="any")


def clean_flows(df: DataFrame) -> DataFrame:
    """Names stripped, non-finite -> null, then rows with any null dropped."""
    return drop_incomplete(nonfinite_to_null(strip_column_names(df)))
