"""Phrase collocation mining by Rabin-Karp fingerprints.

Words and runs of words are hashed without being cut out of the text: prefix polynomials (one over the bytes of many
texts, one over the hashes of their words) give the fingerprint of any span as a difference of two prefixes. The shuffle
adds up the fingerprints of each size, packed; runs that hold a rare shorter run stay where they are. Only phrases that
turn out frequent are then read from the texts: first from a few rows, which hold most of the very frequent ones, then
what is open from more, and what is still open from every row.

A fingerprint is a 64-bit polynomial with 32 further bits from a second, independent polynomial. Both are the key of the
sum, so phrases that collide in the first are told apart by the second and stay apart in the text.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.llm.common import cut, mixed, packed, read_table, unpacked
from flowguard.operators.joins import bounded_broadcast

#: Bytes that end a piece, and blanks between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b"\x20\x09"
LEAST, LONGEST, TOP = 10, 3, 2000
#: Bytes of text hashed at once (a longer text is hashed whole, alone).
BLOCK = 1 << 18
#: Bits of the map of frequent runs (by their fingerprints' first bits) that spares most rare runs the shuffle, and of the
#: number of its slices. Its size is fixed (16 MB): with more runs it lets more through, and the sums decide.
MAP_BITS, SLICE_BITS = 27, 6
#: Sums that a task holds before it adds them up, and sends them if half as many are left; phrases it sends at once; bytes
#: of text for each bucket of sums, about.
HELD, SENT, BUCKET_BYTES = 500_000, 50_000, 16 << 20
#: Bits of the number of buckets at least (a byte of the fingerprint is not sent), and by which buckets of phrases are fewer.
BUCKET_BITS, COARSE = 8, 2
#: Shares of the rows (one in ...) that frequent phrases are read from in turn; the last is every row.
SHARES = 64, 8, 1
#: Bits of the number of phrases that a task remembers, so as not to send them again.
SEEN_BITS = 17
#: Rows of a language that one task ranks.
RANKED = 10_000

#: Rows that hold many runs each: fingerprints and counts, or phrases of one language and their counts or fingerprints.
RUNS = {"size": pa.int32(), "bucket": pa.int64(), "lang": pa.string(), "keys": pa.binary(), "checks": pa.binary(),
        "counts": pa.binary(), "phrases": pa.binary()}
RUNS_DDL = "size int, bucket long, lang string, keys binary, checks binary, counts binary, phrases binary"


class Spans:
    """Words of a block of texts and fingerprints of their runs, by prefix polynomials modulo 2 ** 64.

    ``texts``: UTF-8 bytes of each; ``salts``: a key a text (its language's) that fingerprints of its runs depend on.
    """

    def __init__(self, texts: list[bytes], salts: np.ndarray):
        letters, kind = _tables()
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        kinds = kind[data]
        gap = kinds > 0
        self.start = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
        self.end = np.flatnonzero(~gap & np.r_[gap[1:], True]) + 1
        self.text = np.searchsorted(ends, self.start, side="right")
        self.piece = np.cumsum(kinds == 2)[self.start] if len(self.start) else self.start
        self.salt = salts[self.text] if len(self.start) else np.zeros(0, np.uint64)
        self.letters = letters, data
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _prefix(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefixes over the words' hashes, and the powers that bring a run to its own start, of one polynomial.

        A word's hash is (P[end] - P[start]) * base ** -start, P being the prefix sums of letter * base ** place.
        """
        if which not in self.made:
            (letters, data), base = self.letters, (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[which]
            inverse = pow(base, -1, 1 << 64)
            prefix = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(letters[which][data] * _powers(base, len(data)), out=prefix[1:])
            word = (prefix[self.end] - prefix[self.start]) * _powers(inverse, len(data))[self.start]
            word = mixed(word ^ mixed((self.end - self.start).astype(np.uint64))) + self.salt
            prefix = np.zeros(len(word) + 1, np.uint64)
            np.cumsum(mixed(word) * _powers(base, len(word)), out=prefix[1:])
            self.made[which] = prefix, _powers(inverse, len(word))
        return self.made[which]

    def places(self, size: int) -> np.ndarray:
        """First words of the runs of ``size`` words that lie in one piece."""
        n = max(len(self.start) - size + 1, 0)
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1:])

    def keys(self, at: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        prefix, inverse = self._prefix(which)
        return mixed((prefix[at + size] - prefix[at]) * inverse[at] + np.uint64(size))

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, key, check) of the runs of ``size`` words that lie in one piece."""
        at = self.places(size)
        return at, self.keys(at, size), self.keys(at, size, 1)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the bytes, A-Z as a-z, for either polynomial; and the kinds of bytes: 1 blank, 2 end of a piece."""
    letters = np.random.default_rng(20_240_601).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
    letters[:, 65:91] = letters[:, 97:123]
    kind = np.zeros(256, np.uint8)
    kind[list(WORD_ENDS)], kind[list(PIECE_ENDS)] = 1, 2
    return letters, kind


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 16), np.uint64(base))
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


def _bits(slices: dict[int, bytes]) -> np.ndarray:
    """A map from its slices (deflated, as the plans of jobs hold them; empty ones are left out)."""
    out = np.zeros((1 << SLICE_BITS, 1 << (MAP_BITS - SLICE_BITS - 3)), np.uint8)
    for i, data in slices.items():
        out[i] = np.frombuffer(zlib.decompress(data), np.uint8)
    return out.ravel()


def _listed(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which keys a map holds."""
    at = (keys >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def _summed(parts: list[tuple], check: int | None = None) -> tuple:
    """Sums by key of parts (key, n, and columns of which any row's value does). The parts are taken out of their list, a
    column at a time, so that they are not held twice. ``check``: a column that belongs to the key, too."""
    columns = [list(c) for c in zip(*parts, strict=True)]
    parts.clear()

    def whole(i: int) -> np.ndarray:
        column = np.concatenate(columns[i])
        columns[i] = []
        return column

    key = whole(0)
    order = np.argsort(key, kind="stable")
    new = key[order][1:] != key[order][:-1]
    if check is not None:
        checks = np.concatenate(columns[check])
        if (~new & (checks[order][1:] != checks[order][:-1])).any():
            order = np.lexsort((checks, key))
            new = key[order][1:] != key[order][:-1]
            new |= checks[order][1:] != checks[order][:-1]
    key = key[order]
    first = np.flatnonzero(np.r_[True, new]) if len(key) else order
    n = np.add.reduceat(whole(1)[order], first) if len(key) else whole(1)
    key, order = key[first], order[first]
    return key, n, *(whole(i)[order] for i in range(2, len(columns)))


def _batch(**columns) -> pa.RecordBatch:
    n = len(columns["bucket"])
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in RUNS.items()],
                                      list(RUNS))


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=list(RUNS), dtype=object)


def _parts(*columns: np.ndarray) -> list[slice]:
    """Slices of equal neighbours."""
    change = functools.reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(np.r_[True, change])
    return [slice(x, y) for x, y in zip(first.tolist(), [*first[1:].tolist(), len(columns[0])], strict=True)]


def _check(spans: Spans, at: np.ndarray, size: int) -> np.ndarray:
    return (spans.keys(at, size, 1) >> np.uint64(32)).astype("<u4")


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows and texts of a batch, some megabytes at a time."""
    rows, texts, held = [], [], 0
    for i, text in enumerate(batch.column("text")):
        text = text.as_py().encode("utf-8", "surrogatepass")
        if rows and held + len(text) > BLOCK:
            yield rows, texts
            rows, texts, held = [], [], 0
        rows.append(i)
        texts.append(text)
        held += len(text)
    if rows:
        yield rows, texts


def counted(docs: DataFrame, size: int, shorter: dict[int, bytes] | None, least: int, buckets: int) -> DataFrame:
    """Fingerprints of the runs of ``size`` words that occur ``least`` times, and their number; runs of which ``shorter``,
    the map of the runs that are a word shorter, lacks either are left out. Without ``shorter``, the words of each language
    as well (size 0).

    Tasks send their sums packed, parted by the fingerprints' first bits into ``2 ** buckets`` buckets, whose number grows
    with the texts so that a bucket's size does not.
    """
    def sent(parts: list[tuple]) -> pa.RecordBatch:
        key, n, check = _summed(parts, 2)
        bucket = (key >> np.uint64(64 - buckets)).astype(np.int64)
        low = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
        of = _parts(bucket)
        return _batch(size=np.full(len(of), size, np.int32), bucket=bucket[[p.start for p in of]],
                      keys=[low[p].tobytes() for p in of], checks=[check[p].tobytes() for p in of],
                      counts=[packed(n[p]) for p in of])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, parts, held, words = _bits(shorter or {}), [], 0, Counter()
        for batch in batches:
            salts_of = batch.column("salt").to_numpy().view(np.uint64)
            langs = batch.column("lang").to_pylist()
            for rows, texts in blocks(batch):
                spans = Spans(texts, salts_of[rows])
                at = spans.places(size)
                if shorter is None:
                    for i, n in zip(rows, np.bincount(spans.text, minlength=len(rows)).tolist(), strict=True):
                        words[langs[i], int(salts_of[i]) >> (64 - buckets)] += n
                elif len(at):
                    known = np.zeros(len(spans.start) + 1, bool)
                    short = spans.places(size - 1)
                    known[short] = _listed(spans.keys(short, size - 1), bits)
                    at = at[known[at] & known[at + 1]]
                if len(at):
                    parts.append(_summed([(spans.keys(at, size), np.ones(len(at), np.int64), _check(spans, at, size))], 2))
                    held += len(parts[-1][0])
                if held > HELD:
                    parts = [_summed(parts, 2)]
                    held = len(parts[0][0])
                    if held > HELD // 2:
                        held = 0
                        yield sent(parts)
        if parts:
            yield sent(parts)
        if words:
            yield _batch(size=np.zeros(len(words), np.int32), bucket=[b for _, b in words], lang=[x for x, _ in words],
                         counts=[packed(np.array([n])) for n in words.values()])

    def frequent(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        if pdf["size"].iloc[0] == 0:
            words = Counter()
            for lang, counts in zip(pdf["lang"], pdf["counts"], strict=True):
                words[lang] += int(unpacked(counts)[0])
            return _frame([{"size": 0, "bucket": bucket >> COARSE, "lang": x, "counts": packed(np.array([n])), "phrases": b""}
                           for x, n in words.items()])
        parts = []
        for keys, checks, counts in zip(pdf["keys"], pdf["checks"], pdf["counts"], strict=True):
            wide = np.full((len(keys) // 7, 8), bucket >> (buckets - 8), np.uint8)
            wide[:, :7] = np.frombuffer(keys, np.uint8).reshape(-1, 7)
            parts.append((wide.view("<u8").ravel(), unpacked(counts), np.frombuffer(checks, "<u4")))
        key, n, check = _summed(parts, 2)
        on = n >= least
        return _frame([{"size": size, "bucket": bucket >> COARSE, "keys": key[on].tobytes(), "checks": check[on].tobytes(),
                        "counts": packed(n[on])}] if on.any() else [])

    return (docs.select("text", "lang", "salt").mapInArrow(run, RUNS_DDL).groupBy("size", "bucket")
            .applyInPandas(frequent, RUNS_DDL))


def frequent_map(runs: DataFrame, size: int, buckets: int) -> dict[int, bytes]:
    """The map of counted runs of ``size`` words. It comes to the driver in slices of bounded size."""
    def drawn(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << (MAP_BITS - SLICE_BITS), np.uint8)
        for keys in pdf["keys"]:
            places = (np.frombuffer(keys, "<u8") >> np.uint64(64 - MAP_BITS)).astype(np.int64)
            bits[places & (len(bits) - 1)] = 1
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "data": [zlib.compress(np.packbits(bits), 1)]})

    part = F.shiftright("bucket", buckets - COARSE - SLICE_BITS).alias("slice")
    slices = (runs.where(F.col("size") == size).select(part, "keys").groupBy("slice")
              .applyInPandas(drawn, "slice long, data binary").collect())
    return {r["slice"]: bytes(r["data"]) for r in slices}


def read_phrases(docs: DataFrame, maps: dict[int, dict[int, bytes]], buckets: int) -> DataFrame:
    """Phrases of the runs in ``maps``, by size, with their fingerprints: once a task, or more often if it forgets some."""
    def sent(parts: list[tuple], langs: list[str]) -> pa.RecordBatch:
        key, check, lang = (np.concatenate([p[i] for p in parts]) for i in range(3))
        phrases = [x for p in parts for x in p[3]]
        bucket = (key >> np.uint64(64 - buckets + COARSE)).astype(np.int64)
        order = np.lexsort((bucket, lang))
        key, check, lang, bucket = key[order], check[order], lang[order], bucket[order]
        phrases = [phrases[i] for i in order.tolist()]
        of = _parts(bucket, lang)
        return _batch(bucket=bucket[[p.start for p in of]], lang=[langs[lang[p.start]] for p in of],
                      keys=[key[p].tobytes() for p in of], checks=[check[p].tobytes() for p in of],
                      phrases=[b"\n".join(phrases[p]) for p in of])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, parts, held = {k: _bits(x) for k, x in maps.items()}, [], 0
        codes: dict[str, int] = {}
        seen_keys, seen_checks = np.zeros(1 << SEEN_BITS, np.uint64), np.full(1 << SEEN_BITS, -1, np.int64)
        for batch in batches:
            salts_of = batch.column("salt").to_numpy().view(np.uint64)
            langs = batch.column("lang").to_pylist()
            for rows, texts in blocks(batch):
                spans = Spans(texts, salts_of[rows])
                lang = np.array([codes.setdefault(langs[i], len(codes)) for i in rows])
                data = spans.letters[1]
                for size in bits:
                    at = spans.places(size)
                    key = spans.keys(at, size)
                    on = _listed(key, bits[size])
                    at, key = at[on], key[on]
                    key, _, check, at = _summed([(key, np.ones(len(at), np.int64), _check(spans, at, size), at)], 2)
                    slot = ((key ^ check) & np.uint64(len(seen_keys) - 1)).astype(np.int64)
                    new = (seen_keys[slot] != key) | (seen_checks[slot] != check)
                    key, check, at, slot = key[new], check[new], at[new], slot[new]
                    seen_keys[slot], seen_checks[slot] = key, check
                    if len(at):
                        parts.append((key, check, lang[spans.text[at]], [
                            b" ".join(data[x:y].tobytes().lower().split())
                            for x, y in zip(spans.start[at].tolist(), spans.end[at + size - 1].tolist(), strict=True)]))
                        held += len(at)
                if held > SENT:
                    yield sent(parts, list(codes))
                    parts, held = [], 0
        if parts:
            yield sent(parts, list(codes))

    return docs.select("text", "lang", "salt").mapInArrow(run, RUNS_DDL)


def named(phrases: DataFrame, runs: DataFrame, last: bool) -> DataFrame:
    """The counted ``runs`` by language with their phrases, if ``phrases`` has them, else as they are."""
    def match(phrases: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
        if runs.empty:
            return _frame([])
        bucket = int(runs["bucket"].iloc[0])
        wanted = pd.DataFrame({
            "key": np.frombuffer(b"".join(runs["keys"]), "<u8"), "check": np.frombuffer(b"".join(runs["checks"]), "<u4"),
            "n": np.concatenate([unpacked(x) for x in runs["counts"]]),
            "size": np.repeat(runs["size"].to_numpy(), [len(x) // 8 for x in runs["keys"]])})
        got = pd.DataFrame({
            "key": np.frombuffer(b"".join(phrases["keys"]), "<u8"), "check": np.frombuffer(b"".join(phrases["checks"]), "<u4"),
            "lang": np.repeat(phrases["lang"].to_numpy(object), [len(x) // 8 for x in phrases["keys"]]),
            "phrase": pd.Series([x for p in phrases["phrases"] for x in p.split(b"\n")], dtype=object)})
        got = wanted.merge(got.drop_duplicates(["key", "check"]), on=["key", "check"], how="left")
        is_open = got["phrase"].isna()
        if last and is_open.any():
            raise ValueError("a phrase that was counted is in no text")
        return _frame([
            {"size": size, "bucket": bucket, "lang": lang, "counts": packed(part["n"].to_numpy()),
             "phrases": b"\n".join(part["phrase"])} for (lang, size), part in got[~is_open].groupby(["lang", "size"])
        ] + [
            {"size": size, "bucket": bucket, "keys": part["key"].to_numpy().tobytes(),
             "checks": part["check"].to_numpy().tobytes(), "counts": packed(part["n"].to_numpy())}
            for size, part in got[is_open].groupby("size")])

    return phrases.groupBy("bucket").cogroup(runs.groupBy("bucket")).applyInPandas(match, RUNS_DDL)


def unfolded(found: DataFrame) -> DataFrame:
    """(lang, phrase, size, n) of rows that hold many phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = unpacked(row["counts"])
                phrases = pa.array(row["phrases"].split(b"\n"), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["lang"]] * len(n), pa.string()), phrases, pa.array(np.full(len(n), row["size"], np.int32)),
                    pa.array(n)], ["lang", "phrase", "size", "n"])

    return found.select("lang", "size", "counts", "phrases").mapInArrow(run, "lang string, phrase string, size int, n long")


def frequent_phrases(df: DataFrame, text: str, lang: str, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, n): every run of one to ``longest`` words inside a piece that occurs ``least`` times in its
    language, and, with size 0, the number of words of each language.

    Any occurrence gives the phrase of a run, so that it does not matter which rows are read first; every row is read last.
    """
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")
    docs = docs.select("lang", "text", F.xxhash64(F.lit(7), "lang").alias("salt"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKET_BITS, math.ceil(math.log2(max(size / BUCKET_BYTES, 1))))
    maps: dict[int, dict[int, bytes]] = {}
    tables = []
    for k in range(1, longest + 1):
        tables.append(cut(counted(docs, k, maps.get(k - 1), least, buckets)))
        maps[k] = frequent_map(tables[-1], k, buckets)
    runs = functools.reduce(DataFrame.unionByName, tables)
    found, runs = [runs.where("size = 0")], runs.where("size > 0")
    for share in SHARES if size > BUCKET_BYTES else SHARES[-1:]:
        some = docs if share == 1 else docs.where(F.rand(share) < 1 / share)
        both = cut(named(read_phrases(some, maps, buckets), runs, share == 1))
        found.append(both.where("phrases IS NOT NULL"))
        runs = both.where("phrases IS NULL")
        if share > 1:
            maps = {k: frequent_map(runs, k, buckets) for k in maps}
            if not any(maps.values()):
                break
    return unfolded(functools.reduce(DataFrame.unionByName, found))


def _joined(words: str, first: str, last: str) -> Column:
    return F.expr(f"array_join(slice({words}, {first}, {last}), ' ')")


def collocations(frequent: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    part = frequent.where("size > 0").select("lang", "phrase", F.col("n").alias("f"))
    phrases = (frequent.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"),
                                                 F.split("phrase", " ").alias("w")))
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "size", "a", "k", _joined("w", "1", "k").alias("left"),
                    _joined("w", "k + 1", "size - k").alias("right")))
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    whole = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {whole('a')} * {whole('a')}) div ({whole('l')} * {whole('r')})")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    # runs inside longer candidates that occur at least half as often
    inner = (phrases.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
             .groupBy("lang", _joined("w", "s", "m").alias("phrase")).agg(F.max("a").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a")
            .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    kept = cut(kept.withColumn("_h", F.pmod(F.xxhash64("phrase"), F.lit(1 << 40))))
    words = frequent.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    # groups of about RANKED rows send their best on, until a language is one group
    tasks = 1
    while kept.count() > tasks * RANKED:
        tasks *= RANKED // top
    while True:
        order = Window.partitionBy("lang", F.pmod("_h", F.lit(tasks))).orderBy(F.desc("score"), F.desc("a"), "phrase")
        kept = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        if tasks == 1:
            break
        tasks //= RANKED // top
    return kept.join(bounded_broadcast(words), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP) -> DataFrame:
    """Collocations of each language (null: ``und``): runs of two to ``longest`` words that occur ``least`` times, scored
    by the weakest cut of floor(10**6 * a * a / (l * r)), without those that a longer one explains.

    Null and empty texts have no words. Very long texts are hashed whole. Repeated rows count as often as they occur.
    Ties go by count, then by the phrase's bytes. An empty table gives no rows; other columns play no part.
    """
    return collocations(cut(frequent_phrases(df, text, lang, least, longest)), least, longest, top)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of two to three words of each language of ``documents``."""
    return mine_phrases(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(ps) AS p FROM pieces) q),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' ')))
         AS phrase FROM words, range(1, 4) t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, a, j, l.f AS l, r.f AS r,
         CAST(1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = list_aggregate(c.w[1:j], 'string_agg', ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = list_aggregate(c.w[j + 1:], 'string_agg', ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_runs AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cand WHERE k = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_runs GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
         WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
