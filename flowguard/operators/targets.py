"""Targets: binary attack flag and attack family from the raw label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.functions.expressions import family_of, is_benign_label, label_key


def add_targets(df: DataFrame, label: str = "Label", strict: bool = True) -> DataFrame:
    """Add ``target_bin`` (0 iff the label is BENIGN) and ``target_tipo``.

    With ``strict`` an unknown label fails the job with a message naming it.
    """
    lab = F.col(f"`{label}`")
    return df.withColumns({
        S.TARGET_BIN: F.when(is_benign_label(lab), 0).otherwise(1),
        S.TARGET_FAMILY: family_of(lab, strict=strict),
    })


def unmapped_labels(df: DataFrame, label: str = "Label") -> DataFrame:
    """Audit: raw labels that map to no family, with their keys and counts."""
    lab = F.col(f"`{label}`")
    return (df.where(family_of(lab, strict=False).isNull())
            .groupBy(lab.alias("label"), label_key(lab).alias("label_key"))
            .agg(F.count(F.lit(1)).alias("n")))


def attacks_only(df: DataFrame) -> DataFrame:
    return df.where(F.col(S.TARGET_BIN) == 1)
