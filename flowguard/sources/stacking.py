"""Files stacked into one table, with rows read and rows written compared file by file.

Rows are counted as the write reads them (an ``Observation`` on each scan), so that the files are read once.  What
arrived is counted from the written table, of which that reads the file names alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowguard.sources.files import FILE, opened_files, scan_files, scans_of

COUNTED_AT_ONCE = 32     # files of one scan: each is a counter of its own on every row


def stack_files(spark: SparkSession, paths: list[str], out: str, columns: list[str] | None = None) -> DataFrame:
    """Writes the readable files, stacked by column name with a column ``file``, to ``out`` and returns the report of
    ``reconciled``.  Without a readable file nothing is written."""
    opened, errors = opened_files(spark, list(dict.fromkeys(paths)))
    counters, frames = [], []
    for files in scans_of(opened):
        for i in range(0, len(files), COUNTED_AT_ONCE):
            part, seen = files[i:i + COUNTED_AT_ONCE], Observation()
            df = scan_files(spark, part, columns, with_file=True)
            frames.append(df.observe(seen, *[F.count_if(F.col(FILE) == f.path).alias(f"n{j}") for j, f in enumerate(part)]))
            counters.append((part, seen))
    if frames:
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).write.mode("overwrite").parquet(out)
    read = {f.path: seen.get[f"n{j}"] for part, seen in counters for j, f in enumerate(part)}
    return reconciled(spark, read, spark.read.parquet(out) if frames else None, errors)


def reconciled(spark: SparkSession, read: dict[str, int], written: DataFrame | None,
               errors: list[tuple[str, str]] = ()) -> DataFrame:
    """(file, read_rows, written_rows, matches, error): one row a file, also for those that only the written table names.

    ``matches`` is false if the counts differ, and null for a file that could not be read.  A file without rows matches
    with two zeros."""
    known = spark.createDataFrame([(p, n, None) for p, n in read.items()] + [(p, None, e) for p, e in errors],
                                  f"{FILE} string, read_rows long, error string")
    if written is None:
        found = known.select(FILE).limit(0).withColumn("written_rows", F.lit(0).cast("long"))
    else:
        found = written.groupBy(FILE).agg(F.count(F.lit(1)).alias("written_rows"))
    both = known.join(found, FILE, "full")
    counted = F.col("error").isNull()
    return both.select(
        FILE, F.when(counted, F.coalesce("read_rows", F.lit(0))).alias("read_rows"),
        F.when(counted, F.coalesce("written_rows", F.lit(0))).alias("written_rows"),
        F.when(counted, F.coalesce("read_rows", F.lit(0)) == F.coalesce("written_rows", F.lit(0))).alias("matches"), "error")
