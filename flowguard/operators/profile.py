"""Data profile in one aggregation pass, unpivoted afterwards.

Per column: min / max / mean over non-NaN values (infinities included, as a
pandas ``describe`` does), whether any value lies outside [0, 1], null / NaN
count, infinity count, and whether the column is constant (at least two
values, no infinity, min == max -- a variance test can return 1e-35 for a
constant and is avoided).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from flowguard import schema as S

_INF = float("inf")


def column_profile(df: DataFrame, exclude: list[str] | None = None, digits: int = 6) -> DataFrame:
    """``(pos, column, is_numeric, min, max, mean, outside_01, nulls, infs, constant)``."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude or [])]
    aggs, structs = [], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, NumericType)
        floating = isinstance(f.dataType, (DoubleType, FloatType))
        missing = c.isNull() | F.isnan(c) if floating else c.isNull()
        aggs.append(F.sum(missing.cast("long")).alias(f"n{i}"))
        if numeric:
            v = F.when(~F.isnan(c), c) if floating else c
            inf = (F.abs(c) == F.lit(_INF)) if floating else F.lit(False)
            aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"mu{i}"),
                     F.max(((v < 0) | (v > 1)).cast("int")).alias(f"out{i}"),
                     F.sum(inf.cast("long")).alias(f"inf{i}"), F.count(v).alias(f"cnt{i}")]
            structs.append(F.struct(
                F.lit(i).alias("pos"), F.lit(f.name).alias("column"), F.lit(True).alias("is_numeric"),
                F.col(f"lo{i}").cast("double").alias("min"), F.col(f"hi{i}").cast("double").alias("max"),
                F.round(F.col(f"mu{i}"), digits).alias("mean"),
                F.coalesce(F.col(f"out{i}"), F.lit(0)).cast("boolean").alias("outside_01"),
                F.col(f"n{i}").alias("nulls"), F.col(f"inf{i}").alias("infs"),
                ((F.col(f"cnt{i}") >= 2) & (F.col(f"inf{i}") == 0) & (F.col(f"lo{i}") == F.col(f"hi{i}")))
                .alias("constant")))
        else:
            structs.append(F.struct(
                F.lit(i).alias("pos"), F.lit(f.name).alias("column"), F.lit(False).alias("is_numeric"),
                F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"),
                F.lit(None).cast("double").alias("mean"), F.lit(False).alias("outside_01"),
                F.col(f"n{i}").alias("nulls"), F.lit(0).cast("long").alias("infs"),
                F.lit(False).alias("constant")))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def metadata_columns(columns: list[str]) -> list[str]:
    """Columns whose lower-cased name contains a metadata pattern."""
    return [c for c in columns if any(m in c.lower() for m in S.METADATA_PATTERNS)]


def profile_summary(df: DataFrame, prof: DataFrame, label: str = "Label") -> DataFrame:
    """One row: rows, columns, features, numeric columns, columns outside
    [0, 1], NaN / null total, Inf total, constant columns, metadata columns."""
    meta = ", ".join(metadata_columns(df.columns))
    per_column = prof.agg(
        F.count(F.lit(1)).alias("columns"),
        F.sum(F.col("is_numeric").cast("long")).alias("numeric_columns"),
        F.sum((F.col("is_numeric") & F.col("outside_01")).cast("long")).alias("outside_01_columns"),
        F.sum("nulls").alias("nulls"), F.sum("infs").alias("infs"),
        F.sum(F.col("constant").cast("long")).alias("constant_columns"),
        F.lit(1).alias("_k"))
    rows = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(1).alias("_k"))
    # both sides are one-row aggregates
    return (rows.join(per_column, on="_k").drop("_k")
            .withColumn("features", F.col("columns") - F.lit(1 if label in df.columns else 0))
            .withColumn("metadata_columns", F.lit(meta)))


REPORT_COLUMNS = ("section", "column", "metric", "value")


def _long(section: str, column, pairs: list[tuple[str, object]]):
    """Structs of one report row per metric; null values stay as rows."""
    return F.array(*[F.struct(F.lit(section).alias("section"), column.alias("column"), F.lit(m).alias("metric"),
                              v.cast("string").alias("value")) for m, v in pairs])


def profile_report(df: DataFrame, errors: list[tuple[str, str]], file: str = "file", label: str = "Label") -> DataFrame:
    """The profile as ``(section, column, metric, value)``, all text.

    Sections: ``errors`` (files that could not be read), ``labels`` (rows per
    file and label, column ``file``: label), ``files`` (rows per file),
    ``totals``, ``normalisation`` (verdict and the detail columns' range and
    mean), ``missing`` (nulls and infinities, total and of the detail columns)
    and ``constant`` columns.  Label counts take one pass, all column
    statistics another.
    """
    spark = df.sparkSession
    counts = (df.rollup(file, label).agg(F.count(F.lit(1)).alias("n"), F.grouping(label).alias("gl"),
                                         F.grouping(file).alias("gf")))
    of_counts = counts.select(F.explode(F.when(F.col("gf") == 1, _long("totals", F.lit(None).cast("string"), [
        ("rows", F.col("n"))])).when(F.col("gl") == 1, _long("files", F.col(file), [("rows", F.col("n"))])).otherwise(
        _long("labels", F.concat_ws(": ", F.col(file), F.coalesce(F.col(label), F.lit("null"))), [("rows", F.col("n"))]))
        ).alias("r")).select("r.*")
    stats = column_profile(df.drop(file))
    per = stats.withColumns({k: F.col(f"`{k}`") for k in ("min", "max", "mean")})
    detail = F.col("column").isin(list(S.PROFILE_EXAMPLE_COLUMNS))
    finite = F.col("column").isin(list(S.PROFILE_DETAIL_COLUMNS))
    none = F.array().cast("array<struct<section:string,column:string,metric:string,value:string>>")
    of_columns = per.select(F.explode(F.concat(
        F.when(detail, _long("normalisation", F.col("column"), [(m, F.format_string("%.3f", F.col(m))) for m in (
            "min", "max", "mean")])).otherwise(none),
        F.when(finite, _long("missing", F.col("column"), [("nulls", F.col("nulls")), ("infs", F.col("infs"))])).otherwise(none),
        F.when(F.col("constant"), _long("constant", F.col("column"), [("constant", F.lit(True))])).otherwise(none),
    )).alias("r")).select("r.*")
    meta = metadata_columns(df.columns)
    outside = F.sum((F.col("is_numeric") & F.col("outside_01")).cast("long"))
    nothing = F.lit(None).cast("string")
    of_all = stats.agg(
        F.count(F.lit(1)).alias("columns"), F.sum(F.col("is_numeric").cast("long")).alias("numeric"), outside.alias("out"),
        F.sum("nulls").alias("nulls"), F.sum("infs").alias("infs"), F.sum(F.col("constant").cast("long")).alias("const")
    ).select(F.explode(F.concat(
        _long("totals", nothing, [("columns", F.col("columns")), ("features", F.col("columns") - int(label in df.columns)),
                                  ("metadata_columns", F.lit(", ".join(meta)))]),
        _long("normalisation", nothing, [("numeric_columns", F.col("numeric")), ("outside_01_columns", F.col("out")),
                                         ("normalised", F.col("out") == 0)]),
        _long("missing", nothing, [("nulls", F.col("nulls")), ("infs", F.col("infs"))]),
        _long("constant", nothing, [("columns", F.col("const"))]))).alias("r")).select("r.*")
    out = of_counts.unionByName(of_columns).unionByName(of_all)
    if errors:
        out = out.unionByName(spark.createDataFrame([("errors", f, "error", e) for f, e in errors],
                                                    "section string, column string, metric string, value string"))
    return out


def write_report(report: DataFrame, path: str) -> None:
    """The report as JSON lines; it has a few rows per column and label."""
    report.coalesce(1).write.mode("overwrite").json(path)
