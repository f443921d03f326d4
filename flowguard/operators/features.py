"""Feature selection and conforming input to a trained model's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from flowguard import schema as S
from flowguard.functions.expressions import finite_or_zero, to_double_lenient


def split_features(df: DataFrame, extra_exclude: list[str] | None = None) -> list[str]:
    """Ordered feature columns: everything except leakage, targets and keys."""
    drop = set(S.LEAKAGE_COLUMNS) | {S.TARGET_BIN, S.TARGET_FAMILY, S.ROW_ID} | set(extra_exclude or [])
    return [c for c in df.columns if c not in drop]


def conform_strict(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly the model's columns in its order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks model columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in (keep or [])], *[F.col(f"`{c}`") for c in columns])


def conform_lenient(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Scoring-time conforming: reorder to the model's columns, a missing
    column becomes 0, extra columns are dropped (except ``keep``), every cell
    is coerced to a number and NaN / +-Inf / unparsable / null become 0."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def number(c: str):
        if c not in kinds:
            return F.lit(0.0)
        col = F.col(f"`{c}`")
        # numbers are taken as they are; only text is parsed
        return finite_or_zero(col.cast("double") if isinstance(kinds[c], NumericType) else to_double_lenient(col))

    feats = [number(c).alias(c) for c in columns]
    return df.select(*[F.col(f"`{c}`") for c in (keep or [])], *feats)
