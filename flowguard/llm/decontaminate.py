"""Benchmark decontamination by greedy string tiling.

Documents and test items that share a seed (a run of ``least`` words, found by running Karp-Rabin hashes) are joined;
the longest matches are marked, one after another and without overlap, until none of ``least`` words is left. A document
that covers enough of an item is contaminated, in whatever order it has the item's parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import WordKeys, cut, mixed, n_words, read_table, words_of

#: Words of a shortest match, and the percentage of an item's words that tiles must cover.
LEAST, PERCENT = 5, 80
#: Bits of the map of seeds that spares most words of documents the join. Its size is fixed (1 MB): with more seeds it
#: lets more through, and the join decides.
MAP_BITS = 23
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def running_hash(keys: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin fingerprints, modulo 2 ** 64, of all runs of ``size`` word keys."""
    n = len(keys) - size + 1
    if n <= 0:
        return keys[:0]
    out = np.full(n, np.uint64(size))
    for i in range(size):
        out = out * BASE + keys[i:i + n]
    return mixed(out)


def seeds_of_items(items: DataFrame, item_id: str, text: str, least: int) -> DataFrame:
    """(seed, size, item, item_id, item_words, item_at): the runs of every item; one of fewer words is one run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = WordKeys()
        for batch in batches:
            out = {k: [] for k in ("seed", "size", "item", "item_id", "item_words", "item_at")}
            for item_id, text, item in zip(*(batch.column(i) for i in range(3)), strict=True):
                keys = keys_of.of(words_of(text.as_py()))
                size = min(least, len(keys))
                found = running_hash(keys, size).view(np.int64) if size else []
                n = len(found)
                for k, v in zip(out, (found, [size] * n, [item.as_py()] * n, [item_id.as_py()] * n, [len(keys)] * n,
                                      range(n)), strict=True):
                    out[k].extend(v)
            yield pa.RecordBatch.from_arrays([
                pa.array(out["seed"], pa.int64()), pa.array(out["size"], pa.int64()), pa.array(out["item"], pa.int64()),
                pa.array(out["item_id"], batch.column(0).type), pa.array(out["item_words"], pa.int64()),
                pa.array(out["item_at"], pa.int64())], list(out))

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"), F.xxhash64(
        F.col(item_id).cast("string"), F.col(text)).alias("item")).where("text IS NOT NULL").dropDuplicates(["item"])
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"seed long, size long, item long, item_id {kind}, item_words long, item_at long")


def seed_map(seeds: DataFrame) -> tuple[bytes, list[int]]:
    """The map of fixed size, made on the executors (its 64-bit words come to the driver), and the runs' sizes."""
    words = (seeds.select(F.pmod("seed", F.lit(1 << MAP_BITS)).alias("b"))
             .groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(b % 64 AS INT)))").alias("v")).collect())
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in words:
        bits[r["w"]] = r["v"]
    return bits.astype("<i8").tobytes(), sorted(r["size"] for r in seeds.select("size").distinct().collect())


def seeds_of_documents(df: DataFrame, doc_id: str, text: str, bits: bytes, sizes: list[int]) -> DataFrame:
    """(doc_id, text_hash, seed, doc_at): runs of the documents' words that the map lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of, known = WordKeys(), np.frombuffer(bits, np.uint8)
        for batch in batches:
            rows, seeds, places = [], [], []
            for i, text in enumerate(batch.column(1)):
                keys = keys_of.of(words_of(text.as_py()))
                for size in sizes:
                    found = running_hash(keys, size)
                    b = (found & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)
                    at = np.flatnonzero((known[b >> 3] >> (b & 7).astype(np.uint8)) & 1)
                    if len(at):
                        rows.append(np.full(len(at), i))
                        seeds.append(found[at].view(np.int64))
                        places.append(at)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(np.concatenate(seeds)),
                     pa.array(np.concatenate(places))], ["doc_id", "text_hash", "seed", "doc_at"])

    ids = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.where("text IS NOT NULL").mapInArrow(run, f"doc_id {kind}, text_hash long, seed long, doc_at long")


def tiles(doc_at: np.ndarray, item_at: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of a document and an item from their common runs of ``size`` words: (document, item, length).

    Runs on one diagonal make maximal matches. The longest comes first (then the first in the document, then in the
    item); what earlier tiles leave of a match goes on as shorter matches.
    """
    order = np.lexsort((doc_at, doc_at - item_at))
    d, i = doc_at[order], item_at[order]
    if len(d) == 0:
        return []
    new = np.flatnonzero(np.r_[True, (np.diff(d) != 1) | (np.diff(i) != 1)])
    ends = np.r_[new[1:], len(d)] - 1
    heap = [(-int(d[b] - d[a]) - size, int(d[a]), int(i[a])) for a, b in zip(new, ends, strict=True)]
    heapq.heapify(heap)
    marked_d, marked_i, out = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + k not in marked_d and b + k not in marked_i for k in range(-n)]
        if all(free):
            out.append((a, b, -n))
            marked_d.update(range(a, a - n))
            marked_i.update(range(b, b - n))
            continue
        k = 0
        while k < -n:
            if not free[k]:
                k += 1
                continue
            end = k
            while end < -n and free[end]:
                end += 1
            if end - k >= size:
                heapq.heappush(heap, (k - end, a + k, b + k))
            k = end
    return out


def tiling():
    """A pandas UDF: the tiles of common places (doc_at, item_at) of runs of a size."""
    @F.pandas_udf("n_tiles long, covered long, spans array<struct<doc_at:long,item_at:long,words:long>>")
    def run(places: pd.Series, size: pd.Series) -> pd.DataFrame:
        out = []
        for p, n in zip(places, size, strict=True):
            d = np.array([x["doc_at"] for x in p], np.int64)
            i = np.array([x["item_at"] for x in p], np.int64)
            found = tiles(d, i, int(n))
            out.append((len(found), sum(t[2] for t in found), [dict(zip(("doc_at", "item_at", "words"), t, strict=True))
                                                               for t in sorted(found)]))
        return pd.DataFrame(out, columns=["n_tiles", "covered", "spans"])

    return run


def overlaps(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
             item_text: str = "text", least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, item_id, item_words, n_tiles, covered, spans): a row for each text and item whose tiles
    cover ``percent`` of the item's words or more.

    A-Z count as a-z. Null and empty texts match nothing; an item of fewer than ``least`` words matches as a whole.
    Texts of any length are read whole; repeated rows of ``df`` give one row, repeated items too; empty tables give
    none. Documents' texts are never shuffled: only places of runs that the seed map lets through are.
    """
    seeds = cut(seeds_of_items(items, item_id, item_text, least))
    bits, sizes = seed_map(seeds)
    found = seeds_of_documents(df, doc_id, text, bits, sizes)
    # fewer places than these can't cover enough of the item, however they lie
    enough = F.col("_places") * F.col("size") * 100 >= F.col("item_words") * percent
    pairs = (found.join(seeds, "seed").groupBy("doc_id", "text_hash", "item", "item_id", "item_words", "size")
             .agg(F.collect_set(F.struct("doc_at", "item_at")).alias("places"))
             .withColumn("_places", F.size(F.array_distinct(F.col("places.item_at")))).where(enough))
    return (pairs.withColumn("_t", tiling()("places", "size"))
            .select("doc_id", "text_hash", "item_id", "item_words", "_t.n_tiles", "_t.covered", "_t.spans")
            .where(F.col("covered") * 100 >= F.col("item_words") * percent))


def decontaminate(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df``, all its columns, whose text covers no item; null texts stay. An item of fewer than LEAST words
    (an answer such as 'yes') takes out only texts that have its words and no others: ``overlaps`` reports it wherever it
    occurs, but a word in common is no leak."""
    bad = overlaps(df, items, doc_id, text, item_id, item_text).select(
        "text_hash", F.col("doc_id").alias("_id"),
        F.when(F.col("item_words") < LEAST, F.col("item_words")).alias("_only")).distinct()
    mark = df.withColumns({"_hash": F.xxhash64(text), "_words": n_words(text)})
    hit = F.col("_only").isNull() | (F.col("_words") == F.col("_only"))
    return mark.join(bad, (F.col("_hash") == F.col("text_hash")) & F.col(doc_id).eqNullSafe(F.col("_id")) & hit,
                     "left_anti").drop("_hash", "_words")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return overlaps(docs, read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "item_words", "covered", "n_tiles")
