"""Sharding by histogram sort: bytes below candidate key boundaries are counted exactly, again and again, until the
splitters meet their tolerance; then rows are exchanged once. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.llm.common import cut, read_table

#: A sort key is two numbers of 60 bits, hashes of the text and of the id; a round counts below 2 ** DIGIT candidate
#: boundaries between each two known ones.
DIGIT, DIGITS = 12, 5
#: Within a shard, rows are numbered in 2 ** CELL * 2 ** CELL cells, so that a large group of copies is split too.
CELL = 10


def hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def with_keys(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns({
        "size": (F.octet_length(body) + 8).cast("long"), "text_crc32": F.crc32(body.cast("binary")),
        "_k1": hash60(body), "_k2": hash60(F.concat(F.lit("id:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))})


@dataclass
class Probe:
    """A splitter being refined: it lies in the cell of keys that begin with ``prefix`` (of ``level`` digits)."""
    target: float
    level: int = 0
    prefix: int = 0
    below: int = 0
    whole: int = 0
    found: tuple[int, int] | None = None


def edge(level: int, prefix: int) -> tuple[int, int]:
    """The least key (k1, k2) of a cell."""
    bits = DIGIT * level
    if level <= DIGITS:
        return prefix << (DIGIT * DIGITS - bits), 0
    low = bits - DIGIT * DIGITS
    return prefix >> low, (prefix & ((1 << low) - 1)) << (DIGIT * DIGITS - low)


def digit_of(level: int) -> Column:
    key = "_k1" if level < DIGITS else "_k2"
    return F.shiftright(key, DIGIT * (DIGITS - 1 - level % DIGITS)).bitwiseAND((1 << DIGIT) - 1)


def cell_of(level: int) -> list[Column]:
    """Columns that name a row's cell at a level (two numbers, as 120 bits don't fit in one)."""
    bits = DIGIT * DIGITS
    one = F.shiftright("_k1", bits - DIGIT * min(level, DIGITS)) if level else F.lit(0).cast("long")
    two = F.shiftright("_k2", bits - DIGIT * (level - DIGITS)) if level > DIGITS else F.lit(0).cast("long")
    return [one.alias("_p1"), two.alias("_p2")]


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """Keys at which shards 1, 2, ... begin.

    Each round is one aggregation over the narrow key table: of every cell that still holds a splitter, the bytes of
    its 2 ** DIGIT parts (at most shards * 2 ** DIGIT rows come to the driver, whatever the input). A splitter is done
    when a boundary lies within ``tolerance`` of its target share, or when its cell holds one text only. Copies of a
    text stay together, at the nearer end of their cell, unless they exceed a whole shard; such a group is split on.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    share = total / shards
    probes = [Probe(share * j) for j in range(1, shards)]
    for level in range(2 * DIGITS):
        open_ = [p for p in probes if p.found is None and p.level == level]
        if not open_:  # none here; others may wait at a deeper level, within a large group
            continue
        low = DIGIT * max(0, level - DIGITS)
        names = {(p.prefix >> low, p.prefix & ((1 << low) - 1)) for p in open_}
        cell = cell_of(level)
        inside = keys.select("size", "_k1", *cell, digit_of(level).alias("_d"))
        if level:
            held = F.lit(False)
            for a, b in sorted(names):
                held = held | ((F.col("_p1") == a) & (F.col("_p2") == b))
            inside = inside.where(held)
        rows = inside.groupBy("_p1", "_p2", "_d").agg(
            F.sum("size").alias("n"), F.min("_k1").alias("a"), F.max("_k1").alias("b")).collect()
        parts: dict = {}
        for r in sorted(rows, key=lambda r: (r["_p1"], r["_p2"], r["_d"])):
            parts.setdefault((r["_p1"] << low) | r["_p2"], []).append(r)
        for p in open_:
            below = p.below
            for r in parts.get(p.prefix, []):
                if below + r["n"] < p.target:
                    below += r["n"]
                    continue
                prefix, level_in = (p.prefix << DIGIT) | r["_d"], level + 1
                near_end = p.target - below > below + r["n"] - p.target
                off = min(p.target - below, below + r["n"] - p.target)
                one_text = r["a"] == r["b"]
                inside_group = level >= DIGITS
                if off <= tolerance * share:
                    p.found = edge(level_in, prefix + near_end)
                elif one_text and not inside_group and r["n"] <= share:
                    p.found = (r["a"] + near_end, 0)
                elif one_text and not inside_group:
                    # a group larger than a shard: go on by the ids' hashes
                    p.level, p.prefix, p.below = DIGITS, r["a"], below
                elif level_in == 2 * DIGITS:
                    p.found = edge(level_in, prefix + near_end)
                else:
                    p.level, p.prefix, p.below = level_in, prefix, below
                break
            else:
                p.found = edge(level, p.prefix + 1)
    return sorted(p.found for p in probes)


def shard_documents(df: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text",
                    tolerance: float = 0.001) -> DataFrame:
    """``df`` with size, text_crc32, law ('bytes'), shard and slot: shards of nearly equal bytes.

    size is the text's UTF-8 bytes plus 8. Rows are ordered by the hash of their text, then of their id; shards are
    ranges of that order, and slot numbers a shard's rows from 0 without gaps. Equal texts (null counts as empty) share
    a shard unless together they exceed one: each of a shard's two boundaries may be off by half of the group that it
    crosses, where that is more than the tolerance. Repeated rows count one by one. An empty table gives no rows. Columns of
    these names in ``df`` are replaced. Nothing depends on partitions or task order, so retried tasks agree.
    """
    given = {"size", "text_crc32", "law", "shard", "slot"}
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))  # keeps helper names apart
    doc_id = f"_row.`{doc_id}`"
    keyed = with_keys(row, doc_id, f"_row.`{text}`")
    keys = cut(keyed.select("size", "_k1", "_k2"))

    def placed(rows: DataFrame) -> DataFrame:
        n = F.lit(0)
        for a, b in at:
            n = n + ((F.col("_k1") > a) | ((F.col("_k1") == a) & (F.col("_k2") >= b))).cast("int")
        return rows.withColumns({"shard": n, "_c1": F.shiftright("_k1", 60 - CELL), "_c2": F.shiftright("_k2", 60 - CELL)})

    at = splitters(keys, shards, tolerance)
    cell = ["shard", "_c1", "_c2"]
    before = Window.partitionBy("shard").orderBy("_c1", "_c2").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed(keys).groupBy(*cell).agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("_k1", "_k2", doc_id))
    return (placed(keyed).join(counts, cell)
            .withColumns({"slot": (F.col("_before") + rank - 1).cast("long"), "law": F.lit("bytes")})
            .select(*[F.col(f"_row.`{c}`") for c in df.columns if c not in given], "size", "text_crc32", "law", "shard", "slot"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))
