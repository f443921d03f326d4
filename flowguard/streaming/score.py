"""Stateless cascade scoring of a flow stream, plus windowed alert counts.

The scoring is the same narrow projection as the batch path (lenient
conforming, compiled rule trees), so it runs unchanged on a streaming
DataFrame.  Alert counts per event-time window use a watermark so state for
closed windows is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators import cascade as C
from flowguard.operators.clean import strip_column_names
from flowguard.operators.features import conform_lenient
from flowguard.operators.rules import RuleTree


def score_stream(flows: DataFrame, stage1: RuleTree, threshold: float, stage2: RuleTree,
                 columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Upload-style scoring of each micro-batch row (no state)."""
    raw = strip_column_names(flows)
    keep = [c for c in (keep or []) + S.CONTEXT_COLUMNS if c in raw.columns]
    x = conform_lenient(raw, columns, keep=list(dict.fromkeys(keep)))
    return C.score_rules(x, stage1, threshold, stage2, C.DASHBOARD)


def alert_counts(scored: DataFrame, ts: str = "ts", window: str = "1 hour",
                 watermark: str = "1 hour") -> DataFrame:
    """Alerts and flows per event-time window (append mode after the watermark)."""
    # watermarks need TIMESTAMP; flow captures often carry TIMESTAMP_NTZ (session zone: UTC)
    scored = scored.withColumn(ts, F.col(ts).cast("timestamp"))
    return (scored.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("window"))
            .agg(F.count(F.lit(1)).alias("flows"),
                 F.sum((F.col(C.ALERT) == S.ALERT_ATTACK).cast("long")).alias("alerts")))
