"""Flow files: stacked by name, projected, with unreadable ones reported.

Files are opened side by side; those of one schema are read by one scan, so
that the plan grows with the distinct schemas and not with the files.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowguard.operators.joins import bounded_broadcast

FILE = "file"
OPENED_AT_ONCE = 16     # files whose schemas are fetched side by side
_PART = "_part_file"


class Opened(NamedTuple):
    path: str
    schema: StructType
    parts: list[str]    # the files that make it up


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every column as text: guessing types would turn a
    number column with one odd cell into text, or the cell into null."""
    return spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8")


def _is_csv(path: str) -> bool:
    return path.lower().rstrip("/").endswith(".csv")


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path) if _is_csv(path) else spark.read.parquet(path)


def _opened(spark: SparkSession, path: str) -> Opened | tuple[str, str]:
    try:
        df = read_flows(spark, path)
        return Opened(path, df.schema, df.inputFiles())
    except AnalysisException as e:
        return path, e.getCondition() or str(e).split("\n")[0]
    except (PySparkException, Py4JJavaError) as e:   # a damaged file fails the job that reads its schema
        damaged = re.search(r"\[(FAILED_READ_FILE[A-Z_.]*)\]", str(e))
        if damaged is None:
            raise
        return path, damaged[1]


def opened_files(spark: SparkSession, paths: list[str]) -> tuple[list[Opened], list[tuple[str, str]]]:
    """The readable files, and ``(file, error)`` of the others."""
    with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
        found = list(pool.map(lambda path: _opened(spark, path), paths))
    return [f for f in found if isinstance(f, Opened)], [f for f in found if not isinstance(f, Opened)]


def scans_of(opened: list[Opened]) -> list[list[Opened]]:
    """Files that one scan reads: of equal format and schema. A file named twice is read by another scan, and a table
    parted by directories by one of its own."""
    groups: dict[tuple, list[Opened]] = {}
    seen: dict[str, int] = {}
    for f in opened:
        again = max((seen.get(part, 0) for part in f.parts), default=0)
        for part in f.parts:
            seen[part] = again + 1
        below = [unquote(part).split(unquote(f.path).rstrip("/"))[-1] for part in f.parts]
        own = f.path if any("=" in x for x in below) else ""
        groups.setdefault((_is_csv(f.path), f.schema.json(), again, own), []).append(f)
    return list(groups.values())


def scan_files(spark: SparkSession, files: list[Opened], columns: list[str] | None, with_file: bool) -> DataFrame:
    paths = [f.path for f in files]
    if len(files) == 1:
        df = _projected(read_flows(spark, paths[0]), columns)
        return df.withColumn(FILE, F.lit(paths[0])) if with_file else df
    reader = spark.read.schema(files[0].schema)
    df = reader.csv(paths, header=True, encoding="UTF-8") if _is_csv(paths[0]) else reader.parquet(*paths)
    if not with_file:
        return _projected(df, columns)
    named = spark.createDataFrame([(re.sub("^file:/+", "file:/", part), f.path) for f in files for part in f.parts],
                                  f"{_PART} string, {FILE} string")
    df = df.withColumn(_PART, F.regexp_replace("_metadata.file_path", "^file:/+", "file:/"))
    out = _projected(df.drop(_PART), columns).columns
    df = _projected(df, None if columns is None else [*columns, _PART])
    return df.join(bounded_broadcast(named), _PART, "left").select(*[F.col(f"`{c}`") for c in out], FILE)


def _projected(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """The wanted columns by their stripped name, absent ones as null text."""
    if columns is None:
        return df
    have = {c.strip(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[c]}`").alias(c) if c in have else F.lit(None).cast("string").alias(c)
                       for c in columns])


def load_flows_reported(spark: SparkSession, paths: list[str], columns: list[str] | None = None,
                        with_file: bool = False) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """The readable files stacked by column name, and ``(file, error)`` of the
    others.  Columns that a file lacks are null; ``columns`` prunes the scans;
    ``with_file`` adds the path each row came from."""
    opened, errors = opened_files(spark, paths)
    frames = [scan_files(spark, files, columns, with_file) for files in scans_of(opened)]
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None), errors


def load_flows(spark: SparkSession, paths: list[str], columns: list[str] | None = None,
               with_file: bool = False) -> DataFrame:
    """All files stacked by column name; the first unreadable one is an error."""
    df, errors = load_flows_reported(spark, paths, columns, with_file)
    if errors or df is None:
        raise FileNotFoundError(f"cannot read {errors[0][0]}: {errors[0][1]}" if errors else "no flow files given")
    return df
