"""Scoring uploads with saved bundles: the contract, not the model, says which probability is the attack's, which name
a prediction has, and from which probability on a flow is an alert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.operators import cascade as C
from flowguard.operators.clean import strip_column_names
from flowguard.operators.features import conform_lenient
from flowguard.plans import jobs as J
from flowguard.sources.files import read_flows

SHOWN = "_shown"


def first_bundle(spark: SparkSession, folder: str, names: list[str]) -> J.Bundle:
    """The first of the named bundles that exists in a folder; if none does, the first name is the one asked for."""
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        if J.bundle_exists(spark, path):
            return J.load_bundle(spark, path)
    raise FileNotFoundError(f"bundle not found at {folder.rstrip('/')}/{names[0]}; train the stage first")


def score_upload(raw: DataFrame, stage1: J.Bundle, stage2: J.Bundle, keep: list[str] | None = None) -> DataFrame:
    """Cascade of two bundles over a raw table: names stripped, features conformed leniently to both contracts, alerts
    (and only they) through stage 2. ``keep`` columns come first, then the context columns that the table has, then the
    results, in dashboard mode. Context may hold features too: it is carried apart from the numbers that are scored.
    A table without rows gives an empty result of the same columns."""
    named = strip_column_names(raw)
    keep = [c for c in keep or [] if c in named.columns]
    shown = [*[F.col(f"`{c}`") for c in keep], *C.context_columns(named)]
    # a struct without fields cannot be written; the mark is not shown
    carried = named.withColumn(SHOWN, F.struct(F.lit(True).alias("_row"), *shown))
    columns = list(dict.fromkeys([*stage1.columns, *stage2.columns]))
    scored = C.score_models(conform_lenient(carried, columns, keep=[SHOWN]), stage1, stage2, C.DASHBOARD)
    return scored.select(f"{SHOWN}.*", *C.RESULT_COLUMNS).drop("_row")


def score_file(spark: SparkSession, path: str, stage1: J.Bundle, stage2: J.Bundle) -> DataFrame:
    """``score_upload`` of a CSV or parquet file, with its row ids if it has them."""
    return score_upload(read_flows(spark, path), stage1, stage2, [S.ROW_ID])
