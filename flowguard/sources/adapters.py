"""Flow-shaped stand-in tables built from the driver's ``events`` table.

The real flow captures are not available, so these adapters only *shape*
``events`` rows into the flow schema the jobs expect (raw names with stray
blanks, non-finite cells, a label column).  They do none of the jobs' work;
every operator downstream is written for any table of this schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_INF = float("inf")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int").cast("double")


def flows_from_events(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """Raw flow table (uncleaned) with a planted label; one row per event.

    ``with_source`` adds ``source`` (the event type), standing in for the
    capture file a flow was read from."""
    ev = read_table(spark, sf_dir, "events")
    eid, v, k = F.col("event_id"), F.col("value"), _k()
    one = F.lit(1.0)

    def attack(k: F.Column) -> F.Column:
        return (F.when(k < 25, "DDoS").when(k < 45, "DoS Hulk").when(k < 55, "DoS slowloris").when(k < 75, "PortScan")
                .when(k < 85, "FTP-Patator").when(k < 92, "Bot").otherwise("Web Attack � XSS"))

    label = (F.when(eid % 4999 == 0, "Infiltration")
             .when(eid % 53 == 0, "BENIGN")
             .when(eid % 599 == 0, "DDoS")
             .when(v <= 100, F.when(eid % 2 == 0, "BENIGN").otherwise(" Benign "))
             .otherwise(F.get(F.transform(F.array(k), attack), F.lit(0))))  # k is read from the JSON once
    return ev.select(
        eid.alias("row_id"),
        (v * F.lit(1000.0)).alias(" Flow Duration"),
        k.alias("Total Fwd Packets"),
        (eid % 1460).cast("double").alias("Fwd Packet Length Max"),
        F.when(eid % 97 == 0, F.lit(_INF))
         .when(eid % 101 == 0, F.lit(float("nan")))
         .when(eid % 103 == 0, F.lit(None).cast("double"))
         .otherwise(v / (k + one)).alias("Flow Bytes/s"),
        F.when(eid % 211 == 0, F.lit(-_INF)).otherwise((k + one) / (v + one)).alias("Flow Packets/s "),
        (eid % 2).cast("double").alias("SYN Flag Count"),
        F.lit(0.0).alias("Bwd PSH Flags"),
        (F.col("user_id") % 3).cast("double").alias("Down/Up Ratio"),
        (v / (v + F.lit(50.0))).alias("Unit Score"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")).alias("Source IP"),
        label.alias("Label"),
        *([F.col("event_type").alias("source")] if with_source else []),
    )


def flows_csv_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string flow table as an uploaded CSV would arrive.

    ``Bwd PSH Flags`` is missing, ``Extra`` is surplus, some cells are junk
    ('abc', '1d'), text infinities / NaN or null, and ``Protocol`` holds
    numbers, decimals and text.
    """
    base = flows_from_events(spark, sf_dir).drop("Bwd PSH Flags")
    eid = F.col("row_id")
    feats = [c for c in base.columns if c not in ("row_id", "Source IP", "Label")]

    def junk(c: str) -> F.Column:
        return (F.when(eid % 31 == 0, F.lit("abc"))
                .when(eid % 37 == 0, F.lit("inf"))
                .when(eid % 41 == 0, F.lit("NaN"))
                .when(eid % 43 == 0, F.lit("1d"))
                .when(eid % 47 == 0, F.lit(None).cast("string"))
                .otherwise(F.col(f"`{c}`").cast("string")))

    proto = (F.when(eid % 7 == 0, "6").when(eid % 7 == 1, "17").when(eid % 7 == 2, "1")
             .when(eid % 7 == 3, "6.0").when(eid % 7 == 4, "abc").when(eid % 7 == 5, F.lit(None))
             .otherwise("200"))
    return base.select(
        eid,
        *[junk(c).alias(c) for c in feats],
        F.col("`Source IP`"),
        proto.cast("string").alias("Protocol"),
        F.lit("x").alias("Extra"),
        F.col("Label"),
    )
