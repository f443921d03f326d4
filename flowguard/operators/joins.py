"""Join helpers: broadcast only behind a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a derived "small" table may have before we stop broadcasting it.  The
# tables we broadcast (per-class allocations, cutoffs, label grids, weights)
# have one row per class or per class and boundary.
BROADCAST_MAX_ROWS = 200_000


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(small)`` if it has at most ``max_rows`` rows, else ``small``.

    The count runs one small job; callers pass tables that are aggregates or
    are persisted, so the check is cheap.  Beyond the bound the join falls
    back to a shuffle join (and AQE may still pick broadcast at runtime).
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def anti_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` (left_anti)."""
    return df.join(keys, on=on, how="left_anti")


def semi_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (left_semi)."""
    return df.join(keys, on=on, how="left_semi")
