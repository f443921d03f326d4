"""Language-model scores: a log-bilinear neural model, trained in numpy by noise-contrastive estimation.

The model has two levels. The first predicts a word's class from the classes of the two words before it: the most frequent
training words are classes of their own, the other frequent ones share classes, all the rest fall into a few classes by
their shape. The second predicts, from the class of the word before, which word of a shared class it is; every word of
such a class has a vector of its own. How many words are frequent grows with the corpus, as the square root of its size,
and so do the shared classes. Rare words have their add-one share of their shape.

Texts are cut into words once: blocks of documents keep their distinct words and the tokens as places among these.
Counts of every training word come from an exact join: blocks send their distinct words to buckets, which add up and
send back the counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import WORD_CACHE, crc_of_id, cut, packed, read_table, unpacked, words_of

#: Most words that are a class of their own; dimensions; noise words and tokens of a step; rounds over all training
#: texts. (More frequent words than HEAD share classes and are told apart at the second level.)
HEAD, DIM, NOISE, STEP, ROUNDS, RATE = 504, 24, 64, 2048, 2, 0.1
#: A word is frequent if training texts hold it this often: the square root of the corpus's bytes by RARER, but LEAST at
#: the least. So 16 times the text gives about four times the words, at most RARER * sqrt(bytes).
LEAST, RARER = 4, 40
#: Shapes of words (the low bits of their keys): four kinds of last character, with or without other than ASCII.
SHAPES = 8
#: Text bytes of a block of documents, about.
BLOCK_BYTES = 8_000_000
#: Partial models that are averaged in one group; parameters of a row.
FAN_IN, PIECE = 16, 1 << 20
END = np.uint64(SHAPES - 1)
COUNT_SCHEMA = ("kind int, block long, counts binary, n long, v long, shape_n array<long>, shape_v array<long>, "
                "top array<struct<key:long,n:long>>")


class ShapedKeys(dict):
    """word (bytes) -> 64-bit key whose low three bits are the word's shape; computed once per word and task."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        last = word[-1:]
        kind = 1 if last == b"." else 2 if last == b"," else 0 if last.isalnum() or last >= b"\x80" else 3
        key = (xxhash.xxh3_64_intdigest(word) & ~7) | kind << 1 | (not word.isascii())
        self[word] = key
        return key


def tokens_of(texts, keys_of: ShapedKeys) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, each text closed by END, and the place where each text begins."""
    out, start, n = [], np.zeros(len(texts), np.int64), 0
    end = np.array([END], np.uint64)
    for i, text in enumerate(texts):
        words = words_of(text)
        start[i] = n
        n += len(words) + 1
        out += [np.fromiter(map(keys_of.__getitem__, words), np.uint64, len(words)), end]
    return np.concatenate(out) if out else np.zeros(0, np.uint64), start


def tokenised(docs: DataFrame) -> DataFrame:
    """(block, ids, held, keys, at, starts): documents in blocks of about BLOCK_BYTES, cut where they are read, so that no
    id and no source makes a block larger. ``keys``: the block's distinct words, sorted; ``at``: each token's place among
    them; ``starts``: the first token of each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, number, keys_of = TaskContext.get().partitionId() << 32, 0, ShapedKeys()
        ids, held, texts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            keys, starts = tokens_of(texts, keys_of)
            own, at = np.unique(keys, return_inverse=True)
            values = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([first + number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                pa.array([np.concatenate(held).tobytes()], pa.binary()), pa.array([own.astype("<u8").tobytes()], pa.binary()),
                pa.array([packed(at)], pa.binary()), pa.array([packed(starts)], pa.binary())],
                ["block", "ids", "held", "keys", "at", "starts"])

        for batch in batches:
            begin, flags = 0, batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, text in enumerate(batch.column(2)):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BLOCK_BYTES or i + 1 == batch.num_rows:
                    ids.append(batch.column(0).slice(begin, i + 1 - begin))
                    held.append(flags[begin:i + 1])
                    begin = i + 1
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, held, texts, size, number = [], [], [], 0, number + 1
        if texts:
            yield block()

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"block long, ids array<{kind}>, held binary, keys binary, at binary, starts binary")


def decoded(held: bytes, keys: bytes, at: bytes, starts: bytes) -> tuple:
    """(distinct keys, tokens, document starts, held-out documents, training tokens as a mask) of a block."""
    at, starts, held = unpacked(at), unpacked(starts), np.frombuffer(held, bool)
    return np.frombuffer(keys, "<u8"), at, starts, held, np.repeat(~held, np.diff(np.r_[starts, len(at)]))


def block_words(blocks: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, keys, counts): each block's distinct words, parted by the high bits of their keys, with their
    number in its training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *data in zip(*batch.columns, strict=True):
                own, at, _, _, train = decoded(*(x.as_py() for x in data))
                counts = np.bincount(at, weights=train, minlength=len(own)).astype(np.int64)
                edges = np.searchsorted(own >> np.uint64(64 - bits) if bits else np.zeros(len(own), np.uint64),
                                        np.arange((1 << bits) + 1, dtype=np.uint64))
                parts = [(b, x, y) for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if y > x]
                yield pa.RecordBatch.from_arrays([
                    pa.array([b for b, _, _ in parts], pa.int64()), pa.array([block.as_py()] * len(parts), pa.int64()),
                    pa.array([own[x:y].tobytes() for _, x, y in parts], pa.binary()),
                    pa.array([packed(counts[x:y]) for _, x, y in parts], pa.binary())], ["bucket", "block", "keys", "counts"])

    return blocks.select("block", "held", "keys", "at", "starts").mapInArrow(
        run, "bucket long, block long, keys binary, counts binary")


def added_up(words: DataFrame, least: int) -> DataFrame:
    """Per bucket: for each block the corpus counts of its words (kind 0), and a summary (kind 1): tokens, distinct
    words, both by shape, and the bucket's words that occur ``least`` times."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, "<u8") for x in pdf["keys"]]
        each, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([unpacked(x) for x in pdf["counts"]]),
                             minlength=len(each)).astype(np.int64)
        place = np.r_[0, np.cumsum([len(x) for x in keys])]
        bucket = int(pdf["bucket"].iloc[0])
        rows = [(0, int(b), packed(counts[at[x:y]]), bucket, 0, None, None, None)
                for b, x, y in zip(pdf["block"], place[:-1], place[1:], strict=True)]
        shape, known = (each & np.uint64(SHAPES - 1)).astype(np.int64), counts > 0
        often = np.flatnonzero(counts >= least)
        rows.append((1, -1, None, int(counts.sum()), int(known.sum()),
                     np.bincount(shape, weights=counts, minlength=SHAPES).astype(np.int64).tolist(),
                     np.bincount(shape[known], minlength=SHAPES).tolist(),
                     [{"key": int(k), "n": int(n)} for k, n in zip(each.view(np.int64)[often], counts[often],
                                                                   strict=True)]))
        return pd.DataFrame(rows, columns=["kind", "block", "counts", "n", "v", "shape_n", "shape_v", "top"])

    return words.groupBy("bucket").applyInPandas(run, COUNT_SCHEMA)


@dataclass
class Vocabulary:
    """What the model and the base score know of the training corpus. It holds the frequent words: at most the corpus's
    bytes by their least count, that is RARER times the square root of the bytes."""
    tokens: int
    distinct: int
    keys: np.ndarray      # of the frequent words, sorted
    classes: np.ndarray   # of each of these words, then of the shapes
    places: np.ndarray    # likewise: place among the words of shared classes, which lie class by class; -1: none
    shares: np.ndarray    # unigram shares of the classes, add-one smoothed: the model's start and the noise of its training
    edges: np.ndarray     # of the shared classes among their words
    far: np.ndarray       # shares of those words in their class
    rare: np.ndarray      # per shape: tokens + distinct + 1 of the rare words

    @staticmethod
    def of(counts: DataFrame) -> Vocabulary:
        heads = counts.where("kind = 1")
        row = heads.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), *[
            F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("shape_n", "shape_v") for i in range(SHAPES)]).first()
        top = heads.select(F.explode("top").alias("t")).select("t.key", "t.n").collect()
        keys = np.array([r["key"] for r in top], np.int64).view(np.uint64)
        n = np.array([r["n"] for r in top], np.int64)
        order = np.lexsort((keys, -n))
        keys, n = keys[order], n[order]
        shape = (keys & np.uint64(SHAPES - 1)).astype(np.int64)
        rest = np.array([row[f"shape_n{i}"] or 0 for i in range(SHAPES)]) - np.bincount(
            shape, weights=n, minlength=SHAPES).astype(np.int64)
        kinds = np.array([row[f"shape_v{i}"] or 0 for i in range(SHAPES)]) - np.bincount(shape, minlength=SHAPES)
        # shared classes: words of like shape and frequency
        head = min(HEAD, len(keys))
        far = np.argsort(shape[head:], kind="stable") + head
        shared = math.ceil(math.sqrt(len(far)) / 2)
        edges = np.linspace(0, len(far), shared + 1).astype(np.int64)
        sizes = np.diff(edges)
        classes, places = np.arange(len(keys)), np.full(len(keys), -1)
        classes[far], places[far] = head + np.repeat(np.arange(shared), sizes), np.arange(len(far))
        in_class = np.r_[np.bincount(classes, weights=n, minlength=head + shared), rest] + 1.0
        in_far = n[far] / np.repeat(np.add.reduceat(n[far], edges[:-1]), sizes) if shared else np.zeros(0)
        by_key = np.argsort(keys)
        return Vocabulary(int(row["n"] or 0), int(row["v"] or 0), keys[by_key],
                          np.r_[classes[by_key], head + shared + np.arange(SHAPES)],
                          np.r_[places[by_key], np.full(SHAPES, -1)], in_class / in_class.sum(), edges, in_far,
                          rest + kinds + 1)


def word_ids(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of words among the frequent ones, sorted by key; of others, their shape after these."""
    out = len(known) + (keys & np.uint64(SHAPES - 1)).astype(np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        out = np.where(known[at] == keys, at, out)
    return out


class LogBilinear:
    """First level: score(c | u, v) = (one[u] + two[v]) . out[c] + bias[c], u being the class of the word before and v
    that of the one before u. Second level, for the words x of a shared class: near[u] . far[x] + far_bias[x].

    ``shares``: of the classes; ``edges``: of the shared classes among their words; ``far``: shares of those words.
    """
    NAMES = ("one", "two", "out", "bias", "near", "far", "far_bias")

    def __init__(self, shares: np.ndarray, edges: np.ndarray | None = None, far: np.ndarray | None = None, seed: int = 3):
        rng = np.random.default_rng(seed)
        n = len(shares)
        self.noise = shares
        self.edges, self.far_noise = (np.zeros(1, np.int64), np.zeros(0)) if edges is None else (edges, far)
        self.one, self.two, self.out = (rng.normal(0, 0.1, (n, DIM)).astype(np.float32) for _ in range(3))
        self.bias = np.log(shares).astype(np.float32)
        self.near, self.far = (rng.normal(0, 0.1, (k, DIM)).astype(np.float32) for k in (n, len(self.far_noise)))
        self.far_bias = np.log(self.far_noise).astype(np.float32)

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> LogBilinear:
        for k in self.NAMES:
            x = getattr(self, k)
            setattr(self, k, flat[:x.size].reshape(x.shape).astype(np.float32))
            flat = flat[x.size:]
        return self

    def train(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, rng, seen: dict) -> None:
        """Noise-contrastive steps with AdaGrad for the first level. ``seen``: sums of squared gradients, kept by the
        caller. Single precision."""
        contrast = Contrast(self.noise)
        for at in range(0, len(w), STEP):
            a, b, c = u[at:at + STEP], v[at:at + STEP], w[at:at + STEP]
            dr, do, db = contrast.step(self.one[a] + self.two[b], c, self.out, self.bias, rng)
            for k, g in (("one", summed(a, dr, self.one.shape)), ("two", summed(b, dr, self.two.shape)), ("out", do),
                         ("bias", db)):
                x = getattr(self, k)
                moved(x, seen.setdefault(k, np.full(x.shape, 1e-8, np.float32)), g / np.float32(len(c)))

    def train_far(self, u: np.ndarray, x: np.ndarray, rng, seen: dict) -> None:
        """The like for the second level: a step takes words of one shared class, and the classes take turns."""
        shared = np.searchsorted(self.edges, x, side="right") - 1
        order = np.argsort(shared, kind="stable")
        u, x = u[order], x[order]
        begin = np.searchsorted(shared[order], np.arange(len(self.edges)))
        of_class = {}
        for i, k in sorted((i, k) for k in range(len(begin) - 1) for i in range(0, begin[k + 1] - begin[k], STEP)):
            mine = slice(begin[k] + i, min(begin[k] + i + STEP, begin[k + 1]))
            words = slice(self.edges[k], self.edges[k + 1])
            if k not in of_class:
                of_class[k] = Contrast(self.far_noise[words])
            a = u[mine]
            dr, do, db = of_class[k].step(self.near[a], x[mine] - words.start, self.far[words], self.far_bias[words], rng)
            for name, part, g in (("near", slice(None), summed(a, dr, self.near.shape)), ("far", words, do),
                                  ("far_bias", words, db)):
                y = getattr(self, name)
                moved(y[part], seen.setdefault(name, np.full(y.shape, 1e-8, np.float32))[part], g / np.float32(len(a)))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Natural log-probabilities of classes: part[0][u, c] + part[1][v, c] - norm[u, v]; all sums of exponentials are
        one matrix product."""
        one, two, out, bias = (getattr(self, k).astype(np.float64) for k in ("one", "two", "out", "bias"))
        first, second = one @ out.T + bias, two @ out.T
        top, top2 = first.max(axis=1, keepdims=True), second.max(axis=1, keepdims=True)
        return np.stack([first, second]), np.log(np.exp(first - top) @ np.exp(second - top2).T) + top + top2.T

    def far_norms(self) -> np.ndarray:
        """Per class of the word before and shared class: the log of the sum of the words' exponentials, a matrix product
        for each shared class."""
        out = np.zeros((len(self.near), len(self.edges) - 1))
        for c, (x, y) in enumerate(zip(self.edges[:-1], self.edges[1:], strict=True)):
            z = self.near @ self.far[x:y].T + self.far_bias[x:y]
            top = z.max(axis=1, keepdims=True)
            out[:, c] = (top + np.log(np.exp(z - top).sum(axis=1, keepdims=True, dtype=np.float64)))[:, 0]
        return out


class Contrast:
    """Noise-contrastive steps: each true word of a step against NOISE words drawn from the noise shares, which the words of
    the step have in common."""

    def __init__(self, shares: np.ndarray):
        self.offset = np.log(NOISE * shares).astype(np.float32)
        self.drawn = np.cumsum(shares)

    def step(self, r: np.ndarray, c: np.ndarray, out: np.ndarray, bias: np.ndarray, rng) -> tuple:
        """Gradients of the contexts ``r``, of ``out`` and of ``bias``, for the true words ``c``."""
        noise = np.minimum(np.searchsorted(self.drawn, rng.random(NOISE)), len(self.drawn) - 1)
        q, qn = out[c], out[noise]
        true = sigmoid((self.offset - bias)[c] - np.einsum("ij,ij->i", r, q))
        false = sigmoid(r @ qn.T + (bias[noise] - self.offset[noise]))
        np.negative(false, out=false)
        dr = true[:, None] * q + false @ qn
        do = summed(c, true[:, None] * r, out.shape)
        np.add.at(do, noise, false.T @ r)
        db = np.bincount(c, weights=true, minlength=len(bias)).astype(np.float32)
        np.add.at(db, noise, false.sum(0))
        return dr, do, db


def moved(x: np.ndarray, total: np.ndarray, g: np.ndarray) -> None:
    """An AdaGrad step of ``x``, in place."""
    total += g * g
    x += np.float32(RATE) * g / np.sqrt(total)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function, in place of ``x``."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def summed(at: np.ndarray, rows: np.ndarray, shape: tuple) -> np.ndarray:
    """Rows added up by their place in an array of the given shape."""
    order = np.argsort(at.astype(np.uint16) if shape[0] <= 1 << 16 else at, kind="stable")
    place = at[order]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    out = np.zeros(shape, rows.dtype)
    out[place[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def contexts(classes: np.ndarray, start: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the word before each token and of the one before that; before a text stands END."""
    u, v = np.r_[end, classes[:-1]], np.r_[end, end, classes[:-2]][:len(classes)]
    u[start] = end
    v[start] = end
    second = start + 1
    v[second[second < len(classes)]] = end
    return u, v


def one_round(blocks: DataFrame, vocabulary: Vocabulary, start: np.ndarray, number: int) -> np.ndarray | None:
    """Every task trains on all its training texts from the same parameters; the results are averaged by tokens, PIECE
    parameters a row, in groups of FAN_IN, until one is left."""
    sent = blocks.sparkSession.sparkContext.broadcast((
        vocabulary.keys, vocabulary.classes, vocabulary.places, vocabulary.shares, vocabulary.edges, vocabulary.far, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        known, classes, places, shares, edges, far, start = sent.value
        model = LogBilinear(shares, edges, far).load(start)
        end = int(classes[word_ids(known, np.array([END]))[0]])
        rng, seen, n = np.random.default_rng((number, part)), {}, 0
        for batch in batches:
            for data in zip(*batch.columns, strict=True):
                own, at, starts, _, train = decoded(*(x.as_py() for x in data))
                ids = word_ids(known, own)
                w = classes[ids][at]
                u, v = (x[train] for x in contexts(w, starts, end))
                x = places[ids][at][train]
                model.train(u, v, w[train], rng, seen)
                model.train_far(u[x >= 0], x[x >= 0], rng, seen)
                n += len(u)
        if n:
            flat = model.parameters().astype(np.float64) * n
            pieces = range(0, len(flat), PIECE)
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(pieces), pa.int64()), pa.array(range(len(pieces)), pa.int64()),
                pa.array([float(n)] * len(pieces)), pa.array([flat[i:i + PIECE].tobytes() for i in pieces], pa.binary())],
                ["part", "piece", "n", "sums"])

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(x) for x in pdf["sums"])
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN_IN], "piece": pdf["piece"].iloc[:1],
                             "n": [pdf["n"].sum()], "sums": [sums.tobytes()]})

    schema = "part long, piece long, n double, sums binary"
    models = cut(blocks.select("held", "keys", "at", "starts").mapInArrow(run, schema))
    left = models.agg(F.max("part")).first()[0]
    if left is None:
        return None
    while left > 0:
        models = models.groupBy(F.floor(F.col("part") / FAN_IN).alias("g"), "piece").applyInPandas(merged, schema)
        left //= FAN_IN
    rows = sorted(models.select("piece", "n", "sums").collect(), key=lambda r: r["piece"])
    return np.concatenate([np.frombuffer(r["sums"]) / r["n"] for r in rows])


def score(df: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``df``.

    The model learns from rows where ``held_out`` is not true. Null texts are empty: one END token. Repeated rows and ids
    count each. Texts are read whole. Without training rows all counts are 0 and the model keeps its uniform start. An
    empty table gives no rows. base_score and score are log10 of probabilities, base by add-one counts, score by the
    model; both give all unseen words together (in score: of one shape) one share. Distinct words of a corpus are told
    apart by 61-bit hashes.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                     F.coalesce(text, F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a bucket gets the words of a fixed number of blocks
    bits = max(0, (math.ceil(size / BLOCK_BYTES / 4) - 1).bit_length()) if size else 0
    blocks = cut(tokenised(docs))
    counts = cut(added_up(block_words(blocks, bits), max(LEAST, math.isqrt(size) // RARER)))
    vocabulary = Vocabulary.of(counts)
    model = LogBilinear(vocabulary.shares, vocabulary.edges, vocabulary.far)
    for number in range(ROUNDS):
        learned = one_round(blocks, vocabulary, model.parameters(), number)
        if learned is not None:
            model.load(learned)
    # plain arrays: workers need no copy of this package to read them
    held = docs.sparkSession.sparkContext.broadcast((
        vocabulary.keys, vocabulary.classes, vocabulary.places, vocabulary.edges, vocabulary.rare, model.near, model.far,
        model.far_bias, model.far_norms(), *model.tables()))
    train_tokens, train_distinct = vocabulary.tokens, vocabulary.distinct
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        known, classes, places, edges, rare_counts, near, far, far_bias, far_norm, parts, norm = held.value
        own, at, start, held_out, _ = decoded(*(block[c][0].as_py() for c in ("held", "keys", "at", "starts")))
        order = np.argsort(found["n"].to_numpy())
        of_own = np.concatenate([unpacked(found["counts"][int(i)].as_py()) for i in order])
        if len(of_own) != len(own):
            raise ValueError(f"a block has {len(own)} distinct words, but {len(of_own)} counts")
        ids = word_ids(known, own)
        rare = ids >= len(known)
        plus = np.log10(of_own + 1.0)
        within = np.where(rare, plus - np.log10(rare_counts[np.where(rare, ids - len(known), 0)]), 0.0)
        w, place = classes[ids][at], places[ids][at]
        u, v = contexts(w, start, int(classes[word_ids(known, np.array([END]))[0]]))
        logs = parts[0][u, w] + parts[1][v, w] - norm[u, v]
        one = np.flatnonzero(place >= 0)
        for some in np.array_split(one, len(one) // 100_000 + 1):
            x, before = place[some], u[some]
            logs[some] += (np.einsum("nd,nd->n", near[before], far[x]) + far_bias[x]
                           - far_norm[before, np.searchsorted(edges, x, side="right") - 1])
        logs = logs / math.log(10) + within[at]
        n = np.diff(np.r_[start, len(at)])
        values = block["ids"].combine_chunks()
        values = values.chunk(0).flatten() if isinstance(values, pa.ChunkedArray) else values.flatten()
        return pa.Table.from_arrays([
            values, pa.array(held_out), pa.array(n), pa.array(np.add.reduceat((of_own > 0)[at].astype(np.int64), start)),
            pa.array(np.full(len(n), train_tokens, np.int64)),
            pa.array(np.add.reduceat(plus[at], start) - n * math.log10(train_tokens + train_distinct + 1)),
            pa.array(np.add.reduceat(logs, start))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (blocks.groupBy("block").cogroup(counts.where("kind = 0").select("block", "counts", "n").groupBy("block"))
            .applyInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                               "base_score double, score double"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, crc_of_id("doc_id") % 7 == 2)
