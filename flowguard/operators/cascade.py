"""Two-stage cascade scoring and the reports built on its output.

Stage 1 gives P(attack); rows at or above the threshold raise an alert and
only those get a stage-2 family.  With rule trees both stages are one
codegen'd expression and stage 2 is short-circuited by ``when(alert, ...)``.
With Spark ML bundles the stage-1 scores are cut, the alerts branch through the
stage-2 model and the two branches are re-joined with ``unionByName``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard import schema as S
from flowguard.functions.expressions import protocol_label, round_half_even
from flowguard.operators.rules import RuleTree, score_columns
from flowguard.session import cut

EVALUATION = "evaluation"   # non-alerts are 'Benign'
DASHBOARD = "dashboard"     # non-alerts are 'N/A' with a null type confidence

ALERT = "alert"
RESULT_CONFIDENCE = "result_confidence"
ATTACK_TYPE = "attack_type"
TYPE_CONFIDENCE = "type_confidence"
P_ATTACK = "p_attack"
RESULT_COLUMNS = [ALERT, RESULT_CONFIDENCE, ATTACK_TYPE, TYPE_CONFIDENCE]

# Display names of the result columns (fixed values of the scoring report).
DISPLAY_NAMES = {ALERT: "Alerta (Etapa 1)", RESULT_CONFIDENCE: "Confiança Resultado (%)",
                 ATTACK_TYPE: "Tipo de Ataque (Etapa 2)", TYPE_CONFIDENCE: "Confiança Tipo (%)"}


def _default_type(mode: str) -> Column:
    return F.lit(S.BENIGN_FAMILY if mode == EVALUATION else S.TYPE_NOT_APPLICABLE)


def _overlay(p: Column, threshold: float, label2: Column, conf2: Column, mode: str) -> dict[str, Column]:
    hit = p >= F.lit(float(threshold))
    return {
        P_ATTACK: p,
        ALERT: F.when(hit, F.lit(S.ALERT_ATTACK)).otherwise(F.lit(S.ALERT_NORMAL)),
        RESULT_CONFIDENCE: round_half_even(F.when(hit, p).otherwise(F.lit(1.0) - p) * F.lit(100.0), 2),
        ATTACK_TYPE: F.when(hit, label2).otherwise(_default_type(mode)),
        TYPE_CONFIDENCE: F.when(hit, round_half_even(conf2 * F.lit(100.0), 2)),
    }


def score_rules(df: DataFrame, stage1: RuleTree, threshold: float, stage2: RuleTree,
                mode: str = EVALUATION) -> DataFrame:
    """Cascade with compiled rule trees: one narrow projection, no shuffle."""
    s1 = score_columns(stage1)
    s2 = score_columns(stage2)
    return df.withColumns(_overlay(s1["p"], threshold, s2["label"], s2["confidence"], mode))


def score_models(df: DataFrame, bundle1, bundle2, mode: str = EVALUATION) -> DataFrame:
    """Cascade with trained bundles: stage 2 runs on the alerted rows only."""
    from flowguard.plans.jobs import stage1_probability, stage2_predict
    s1 = cut(stage1_probability(bundle1, df))
    hit = F.col(P_ATTACK) >= F.lit(float(bundle1.threshold))
    alerts = stage2_predict(bundle2, s1.where(hit))
    alerts = alerts.withColumns(_overlay(F.col(P_ATTACK), bundle1.threshold, F.col("predicted_tipo"),
                                         F.col("type_confidence"), mode)).drop("predicted_tipo")
    normal = s1.where(~hit).withColumns(_overlay(F.col(P_ATTACK), bundle1.threshold, F.lit(None).cast("string"),
                                                 F.lit(None).cast("double"), mode))
    return alerts.unionByName(normal)


def drop_singleton_classes(df: DataFrame, label: str = S.TARGET_FAMILY) -> DataFrame:
    """Rows of classes with fewer than two members are left out of evaluation."""
    from flowguard.operators.sampling import drop_rare_classes
    return drop_rare_classes(df, label, S.MIN_STRATIFY_SIZE)


# --- reports on a scored table ----------------------------------------------------

def alert_kpis(scored: DataFrame) -> DataFrame:
    """One row: normal flows, attacks detected, anomaly rate in percent (1 decimal)."""
    a = F.col(ALERT) == S.ALERT_ATTACK
    t = scored.agg(F.sum((~a).cast("long")).alias("normal"), F.sum(a.cast("long")).alias("attacks"),
                   F.count(F.lit(1)).alias("total"))
    return t.select("normal", "attacks", "total",
                    round_half_even(F.col("attacks").cast("double") * F.lit(100.0)
                                    / F.col("total").cast("double"), 1).alias("anomaly_rate_pct"))


def alert_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy(ALERT).agg(F.count(F.lit(1)).alias("n"))


def attack_types(scored: DataFrame) -> DataFrame:
    """Families among the alerts, most frequent first (empty when no alert)."""
    return (scored.where(F.col(ALERT) == S.ALERT_ATTACK).groupBy(ATTACK_TYPE)
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), ATTACK_TYPE))


def missed_attacks(scored: DataFrame, actual: str = S.TARGET_FAMILY, predicted: str = ATTACK_TYPE) -> DataFrame:
    """Attacks the cascade called Benign, per family (families with misses,
    most missed first) plus an ``ALL`` row; percent of the family's attacks."""
    att = F.col(actual) != S.BENIGN_FAMILY
    miss = att & (F.col(predicted) == S.BENIGN_FAMILY)
    every = F.grouping("family") == 1
    per = (scored.where(att).select(F.col(actual).alias("family"), miss.cast("long").alias("m"))
           .rollup("family").agg(F.sum("m").alias("missed"), F.count(F.lit(1)).alias("total"), every.alias("_all")))
    out = per.where("_all AND total > 0 OR NOT _all AND missed > 0")
    return (out.withColumn("family", F.when(F.col("_all"), F.lit("ALL")).otherwise(F.col("family")))
            .withColumn("pct", F.col("missed").cast("double") * F.lit(100.0) / F.col("total").cast("double"))
            .orderBy("_all", F.desc("missed"), "family").drop("_all"))


def context_columns(df: DataFrame) -> list[Column]:
    """The context columns present, in display order; Protocol becomes the
    readable ``Protocolo``."""
    cols = []
    for c in S.CONTEXT_COLUMNS:
        if c in df.columns:
            cols.append(protocol_label(F.col(c)).alias("Protocolo") if c == "Protocol" else F.col(f"`{c}`"))
    return cols


def result_table(scored: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Context columns first, then the result columns that exist."""
    present = [c for c in RESULT_COLUMNS if c in scored.columns]
    return scored.select(*[F.col(c) for c in (keep or [])], *context_columns(scored), *present)


def page_count(total: int, size: int) -> int:
    return max(1, -(-total // size))


def result_page(table: DataFrame, page: int = 1, size: int = S.DEFAULT_PAGE_SIZE,
                order: str = S.ROW_ID) -> DataFrame:
    """Rows ``[(page-1)*size, page*size)`` in ``order``; a page past the end is empty."""
    if size not in S.PAGE_SIZES:
        raise ValueError(f"page size must be one of {S.PAGE_SIZES}")
    if page < 1:
        raise ValueError("pages start at 1")
    return table.orderBy(order).offset((page - 1) * size).limit(size)


def page_after(table: DataFrame, last: object | None = None, size: int = S.DEFAULT_PAGE_SIZE,
               order: str = S.ROW_ID) -> DataFrame:
    """The next ``size`` rows after key ``last`` (None: the first page): a page
    far down costs no more than the first, as nothing before it is gathered."""
    if size not in S.PAGE_SIZES:
        raise ValueError(f"page size must be one of {S.PAGE_SIZES}")
    rest = table if last is None else table.where(F.col(order) > F.lit(last))
    return rest.orderBy(order).limit(size)


def page_caption(total: int, page: int, size: int) -> str:
    start = (page - 1) * size
    end = min(start + size, total)
    return f"Exibindo {start + 1}-{end} de {total} fluxos"

