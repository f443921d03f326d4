"""From raw documents to shards: the stages of a training-data pipeline.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again as the next one's
``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import decontaminate, mixing, near_dup, quality, sharding
from flowguard.llm.common import cut, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, predicts to be good."""
    ensemble = quality.fit_on(docs, read_table(spark, sf_dir, "labels"), F.lit(True))
    return quality.kept(docs, ensemble)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of their five-word shingles: that of the least id."""
    return near_dup.deduplicated(docs, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover less than 80 % of the words of every benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else mixed


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard (0 to 23, nearly equal bytes) and slot."""
    return sharding.shard_documents(docs)


STAGES = [("quality classifier", keep_quality), ("MinHash near-dedup", drop_near_duplicates),
          ("benchmark decontamination", drop_benchmark_leaks), ("mixing sources to target weights", mix_sources),
          ("sharding", into_shards)]
#: Trained trees and greedy tiling are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = cut(docs) if i + 1 < len(STAGES) else docs
    return docs
