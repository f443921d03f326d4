"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every flowguard job relies on.  AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting protects the class-keyed
# joins where one class (normal traffic) holds most rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # files of checkpoint() go when their DataFrame does
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "flowguard",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with flowguard's defaults.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``spark.sql.shuffle.partitions`` for the data (AQE coalesces the rest).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and persisted tables.

    The cluster names it in ``spark.checkpoint.dir``; Spark reads that when the
    context starts.  Only where it is unset, on a single machine (tests, local
    benches), a private temporary folder takes its place; on a cluster that is
    an error, as executors could not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                                   "(e.g. an object-store prefix) visible to every executor")
            path = tempfile.mkdtemp(prefix="flowguard-ckpt-")
        context.setCheckpointDir(path)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: later jobs
    neither repeat its work nor depend on executors that may be lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
