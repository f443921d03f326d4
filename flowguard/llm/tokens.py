"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import read_table

#: Fixed values of byte-level BPE files: the blanks and the pattern that parts a text into pre-tokens.
BLANK = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + BLANK + r"\p{L}\p{N}]+|[" + BLANK + r"]+(?![^"
             + BLANK + r"])|[" + BLANK + r"]+")
#: A blank before a non-blank always begins a pre-token, so pieces between such places are counted apart.
PIECE = " (?=[^" + BLANK + "])"
#: Pieces kept by a task with their counts (a cache), and the longest that are kept.
CACHE, CACHE_CHARS = 600_000, 64
MARKS = frozenset(".,;:!?")
#: Texts are worked off in runs of about so many characters.
RUN_CHARS = 4_000_000
SPREAD, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)
NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the file: printable Latin-1 characters for themselves, the others
    in turn from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class MergeTable:
    """Merges of a byte-level BPE file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, ids = spec["model"], spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.width = np.int64(max(ids.values()) + 1)
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        key = left * self.width + right
        self.rank = np.argsort(key, kind="stable")
        self.key = key[self.rank]
        # most pairs are found through a slot of their own; those that share one are searched for
        slot = (self.key.view(np.uint64) * SPREAD) >> SHIFT
        self.slot = np.zeros(1 << 20, np.int32)
        self.slot[slot] = np.arange(len(slot))
        self.shared = np.bincount(slot.astype(np.int64), minlength=1 << 20) > 1
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)[self.rank]
        self.first = np.array([ids[c] for c in byte_symbols()], np.int64)
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)

    def pairs(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no merge) and place in the table of the pair that begins at each symbol."""
        rank, place = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            key = symbols[:-1] * self.width + symbols[1:]
            slot = (key.view(np.uint64) * SPREAD) >> SHIFT
            at = self.slot[slot]
            shared = np.flatnonzero(self.shared[slot])
            at[shared] = np.minimum(np.searchsorted(self.key, key[shared]), len(self.key) - 1)
            fits = (self.key[at] == key) & (owner[:-1] == owner[1:])
            rank[:-1][fits], place[:-1] = self.rank[at[fits]], at
        return rank, place

    def count(self, pre_tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token. In every round each sequence merges all places of its own pair of lowest
        rank; sequences without a pair leave the arrays. Every merge of such files makes another symbol, whose own
        merges rank later, so a round gives what the same merges one by one would give."""
        length = np.array([len(x) for x in pre_tokens], np.int64)
        left = length.copy()
        symbols = self.first[np.frombuffer(b"".join(pre_tokens), np.uint8)]
        owner = np.repeat(np.arange(len(pre_tokens)), length)
        while len(symbols):
            rank, place = self.pairs(symbols, owner)
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[start, len(symbols)])
            lowest = np.minimum.reduceat(rank, start)
            left[owner[start]] = size
            lowest_here = np.repeat(lowest, size)
            at = np.flatnonzero((rank == lowest_here) & (rank < NONE))
            if len(at) == 0:
                break
            # x x x: places of one pair may overlap; from the left, every other one of a run merges
            run = np.cumsum(np.r_[True, np.diff(at) != 1]) - 1
            first = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            symbols[at] = self.made[place[at]]
            keep = lowest_here < NONE
            gone = at + 1
            keep[gone] = False
            symbols, owner = symbols[keep], owner[keep]
        return left


class Counter:
    """Counts tokens of texts as the file's own library gives them."""

    def __init__(self, path: str):
        import regex

        self.table = MergeTable(path)
        self.pattern, self.piece = regex.compile(PRE_TOKEN), re.compile(PIECE)
        self.special = re.compile("|".join(map(re.escape, self.table.special))) if self.table.special else None
        self.first, self.inner, self.long_first, self.long_inner = {}, {}, [], []

    def parts(self, piece: str, blank: str) -> list[str]:
        """Pre-tokens of a piece; letters, or letters and one mark, need no pattern."""
        if piece.isalpha():
            return [blank + piece]
        if piece[-1:] in MARKS and piece[:-1].isalpha():
            return [blank + piece[:-1], piece[-1]]
        return self.pattern.findall(blank + piece)

    def learn(self, pieces: set, cache: dict, long: list, blank: str) -> None:
        """Count pieces that the cache lacks, all in one batch of arrays."""
        new = [x for x in pieces if x not in cache]
        if not new:
            return
        found = [self.parts(x, blank) for x in new]
        each = {t: i for i, t in enumerate({t for f in found for t in f})}
        counts = self.table.count([t.encode("utf-8", "surrogatepass") for t in each]) if each else np.zeros(0, int)
        counts = counts.tolist()
        for x, f in zip(new, found, strict=True):
            cache[x] = counts[each[f[0]]] if len(f) == 1 else sum([counts[each[t]] for t in f])
        long += [x for x in new if len(x) > CACHE_CHARS]

    def run(self, texts: list) -> list[int]:
        parted, plus = [], []
        for text in texts:
            n, segments = 0, [text or ""]
            if self.special is not None and any(s in segments[0] for s in self.table.special):
                n, segments = len(self.special.findall(text)), self.special.split(text)
            plus.append(n)
            parted.append([self.piece.split(s) for s in segments])
        if len(self.first) + len(self.inner) > CACHE:
            self.first.clear()
            self.inner.clear()
        self.learn({s[0] for p in parted for s in p}, self.first, self.long_first, "")
        inner = set()
        for p in parted:
            for s in p:
                inner.update(s[1:])
        self.learn(inner, self.inner, self.long_inner, " ")
        get = self.inner.__getitem__
        out = [n + sum(self.first[s[0]] + sum(map(get, s[1:])) for s in p) for n, p in zip(plus, parted, strict=True)]
        for cache, long in ((self.first, self.long_first), (self.inner, self.long_inner)):
            for x in long:
                del cache[x]
            long.clear()
        return out

    def __call__(self, texts) -> list[int]:
        out, run, size = [], [], 0
        for text in texts:
            run.append(text)
            size += len(text or "")
            if size >= RUN_CHARS:
                out += self.run(run)
                run, size = [], 0
        return out + (self.run(run) if run else [])


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) to every row of ``df``.

    Null and empty texts have 0 bytes and 0 tokens. Every row stays, repeated rows too; columns of these three names
    in ``df`` are replaced. The text is counted whole, whatever its length; special strings in it count as one token,
    as the library does by default. ``tokenizer_path`` is read by the driver and sent to the tasks (a vocabulary's size
    doesn't grow with the data). No shuffle: each task works through its own texts.
    """
    counter = Counter(tokenizer_path)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(counter(texts.tolist()), dtype="int64")

    body = F.coalesce(F.col(text), F.lit(""))
    return (df.withColumns({"n_bytes": F.octet_length(body).cast("long"), "n_tokens": tokens(body)})
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")
