"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import checkpoint_dir

#: Fixed value: a word is a run of characters other than blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Words that a task's word table holds before it is emptied (a cache: it never changes a result).
WORD_CACHE = 400_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there: later jobs neither repeat its work nor
    depend on the disks of executors that may be lost."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def crc_of_id(col: str | Column) -> Column:
    """crc32 of the id as text (null id: of the empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def n_words(text: str | Column) -> Column:
    """Words of a text, natively; null and blank texts have none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


class WordKeys(dict):
    """word (bytes) -> 64-bit key, computed once per word and task.

    Two of n distinct words share a key with a chance of about n * n / 4e19.
    """

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        key = xxhash.xxh3_64_intdigest(word)
        self[word] = key
        return key

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text) -> list:
    """Words of a text as UTF-8 bytes, A-Z lower-cased (bytes.split() parts at just the six blanks)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit keys."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_keys(keys: np.ndarray, size: int) -> np.ndarray:
    """Keys of all runs of ``size`` words; a shorter, non-empty text is one run as a whole."""
    if len(keys) == 0:
        return keys
    n = min(size, len(keys))
    out = np.full(len(keys) - n + 1, n, np.uint64)
    for i in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + keys[i:len(keys) - n + 1 + i])
    return out


def packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them, which the first byte names."""
    kind = next(k for k in ("u1", "u2", "u4", "u8") if len(counts) == 0 or counts.max() <= np.iinfo(k).max)
    return kind[1].encode() + counts.astype("<" + kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data[1:], f"<u{chr(data[0])}").astype(np.int64)
