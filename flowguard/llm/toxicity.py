"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors over the words and five-character runs that mark a class in labelled examples; document
frequencies come from all documents. The examples lie in an inverted index whose postings are cut into blocks of
examples, each with the largest weight of every term in it. For a text these maxima bound the cosine that a block can
reach; blocks are opened in the order of their bounds until no other can hold one of the nearest examples, so the
neighbours are those of the exact cosine. Their votes count by similarity, are calibrated on labelled rows apart from
the index, and the neighbours come along as evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.llm.common import WORD_CACHE, WordKeys, crc_of_id, cut, read_table, shingle_keys, words_of
from flowguard.operators.joins import bounded_broadcast

#: Bounds of the fit: labelled ids of each class drawn by a hash (about; all where there are
#: fewer), of which a quarter calibrates the votes and the others are the index; terms of the vectors.
TOXIC_ROWS, CLEAN_ROWS, TERMS = 3000, 6000, 2048
#: A term marks a class if its log-likelihood ratio has a chance of about 1e-7 under independence.
LEAST_RATIO = 28.4
NEIGHBOURS, EVIDENCE = 15, 3
#: Examples of a block of postings, and blocks opened before the others' bounds are looked at.
BLOCK, FIRST_BLOCKS = 64, 2
#: Votes that the share of toxic rows has of its own.
PRIOR_VOTES = 0.25
RUN = 5
SCORES = ("score double, predicted int, "
          "evidence array<struct<example:string, toxic:int, similarity:double>>")


def terms_of(word: str) -> set[str]:
    """A word and its runs of five characters, the word's ends included."""
    padded = f"<{word}>"
    return {padded, *(padded[i:i + RUN] for i in range(len(padded) - RUN + 1))}


class Vectors:
    """Term counts of texts over a fixed list of terms; words are looked up once a task (a cache of bounded size)."""

    def __init__(self, terms: list[str]):
        self.place = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, counts), ascending; null and empty texts have none."""
        found: Counter = Counter()
        if text:
            known = self.known
            for word, n in Counter(re.findall(r"\w+", text.lower())).items():
                places = known.get(word)
                if places is None:
                    if len(known) >= WORD_CACHE:
                        known.clear()
                    places = known[word] = tuple(sorted(self.place[t] for t in terms_of(word) if t in self.place))
                for p in places:
                    found[p] += n
        at = np.array(sorted(found), np.int64)
        return at, np.array([found[i] for i in at], np.float64)


def weighed(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1.0 + np.log(counts)) * idf[terms]
    return w / math.sqrt(float(w @ w)) if len(w) else w


class BlockMaxIndex:
    """Postings (term -> examples, weights) in blocks of examples, with the largest weight of each term and block.

    Examples whose heaviest terms agree lie together, so that the maxima of a block are tight.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        lead = [int(t[np.argmax(w)]) if len(t) else n_terms for t, w in vectors]
        #: place in the index -> number of the example
        self.example = np.array(sorted(range(len(vectors)), key=lambda i: (lead[i], i)), np.int64)
        place = np.empty(len(vectors), np.int64)
        place[self.example] = np.arange(len(vectors))
        sizes = np.array([len(t) for t, _ in vectors], np.int64)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        at = np.repeat(place, sizes)
        order = np.lexsort((at, term))
        self.at, self.weight = at[order].astype(np.int32), weight[order]
        self.blocks = -(-len(vectors) // BLOCK)
        cell = term[order] * self.blocks + self.at // BLOCK
        self.first = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)).reshape(-1)
        self.most = np.zeros((n_terms, self.blocks))
        np.maximum.at(self.most.reshape(-1), cell, self.weight)

    def _opened(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Exact cosines with all examples of the given blocks, by block and place in it."""
        cells = (terms[:, None] * self.blocks + blocks[None, :]).ravel()
        n = self.first[cells + 1] - self.first[cells]
        total = int(n.sum())
        postings = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[cells], n)
        slot = np.repeat(np.tile(np.arange(len(blocks)), len(terms)) * BLOCK, n) + self.at[postings] % BLOCK
        factor = np.repeat(np.repeat(weights, len(blocks)), n)
        return np.bincount(slot, self.weight[postings] * factor, len(blocks) * BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the ``k`` nearest examples with a common term; ties go by number."""
        if not len(terms) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        near, cos = np.zeros(0, np.int64), np.zeros(0)
        for part in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
            least = cos[-1] if len(cos) == k else 0.0
            part = part[(bound[part] > 0) & (bound[part] >= least - 1e-9)]
            if not len(part):
                continue
            found = self._opened(terms, weights, part)
            hit = np.flatnonzero(found > 0)
            near = np.concatenate([near, self.example[part[hit // BLOCK] * BLOCK + hit % BLOCK]])
            cos = np.concatenate([cos, found[hit]])
            best = np.lexsort((near, -np.round(cos, 12)))[:k]
            near, cos = near[best], cos[best]
        return near, cos


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step function nearest to ``y``: (mean x, mean y) of each pooled group."""
    order = np.argsort(x, kind="stable")
    groups: list[list[float]] = []
    for xi, yi, w in zip(x[order], y[order], weight[order], strict=True):
        groups.append([w, w * yi, w * xi])
        while len(groups) > 1 and groups[-2][1] * groups[-1][0] >= groups[-1][1] * groups[-2][0]:
            last = groups.pop()
            groups[-1] = [a + b for a, b in zip(groups[-1], last, strict=True)]
    return np.array([g[2] / g[0] for g in groups]), np.array([g[1] / g[0] for g in groups])


@dataclass
class Neighbours:
    """The index with what a score needs; plain arrays, bounded by the constants above."""
    terms: list[str]
    idf: np.ndarray
    index: BlockMaxIndex
    ids: list[str]
    toxic: np.ndarray
    share: float
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def vote(self, near: np.ndarray, cos: np.ndarray) -> float:
        """Share of toxic neighbours, weighed by similarity over distance, with the overall share as a prior."""
        w = cos / (1.1 - np.minimum(cos, 1.0))
        return float((w @ self.toxic[near] + PRIOR_VOTES * self.share) / (w.sum() + PRIOR_VOTES))

    def found(self, vector: tuple[np.ndarray, np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        terms, counts = vector
        near, cos = self.index.nearest(terms, weighed(terms, counts, self.idf), NEIGHBOURS)
        return self.vote(near, cos), near, cos

    def score(self, vote: float) -> float:
        if self.knots is None:
            return self.share
        return float(np.interp(vote, *self.knots))


def _sample(ids: DataFrame, seed: str) -> tuple[DataFrame, float]:
    """About TOXIC_ROWS and CLEAN_ROWS of the labelled ids (id, y), with the share of its class that each stands for; and
    the share of toxic ones among all."""
    n = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    at = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string"))), 1, 8), 16, 10).cast("double")
    share = F.when(F.col("y") == 1, F.lit(TOXIC_ROWS / max(n.get(1, 0), 1))).otherwise(
        F.lit(CLEAN_ROWS / max(n.get(0, 0), 1)))
    some = ids.withColumns({"at": at / 2 ** 32, "share": F.least(share, F.lit(1.0))}).where("at < share").drop("at")
    return cut(some), n.get(1, 0) / max(sum(n.values()), 1)


def _without_copies(sample: DataFrame) -> DataFrame:
    """One row (the least id; toxic before clean) of those that share their least five-word shingle: the words of a text
    with many near copies would seem to mark its class."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys_of = WordKeys()
        for f in frames:
            found = [shingle_keys(keys_of.of(words_of(t)), RUN) for t in f["text"]]
            f["least"] = [str(k.min()) if len(k) else "" for k in found]
            yield f

    rows = sample.select("id", "text", "y", "share")
    rows = rows.mapInPandas(run, "id string, text string, y int, share double, least string")
    first = Window.partitionBy("least").orderBy(F.desc("y"), "id", "text")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "least")


def _marking_terms(examples: DataFrame) -> list[str]:
    """The terms most associated with a class, by the likelihood ratio of their documents; none without two classes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            n: Counter = Counter()
            for text, y in zip(f["text"], f["y"], strict=True):
                found = set()
                for word in set(re.findall(r"\w+", (text or "").lower())):
                    found |= terms_of(word)
                n.update((t, int(y)) for t in found)
            yield pd.DataFrame([(t, n_ if y else 0, 0 if y else n_) for (t, y), n_ in n.items()],
                               columns=["term", "toxic", "clean"])

    total = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    if not toxic or not clean:
        return []
    counts = (examples.select("text", "y").mapInPandas(run, "term string, toxic long, clean long")
              .groupBy("term").agg(F.sum("toxic").cast("double").alias("a"), F.sum("clean").cast("double").alias("b")))

    def part(seen: Column, margin: Column, column: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen * (toxic + clean) / (margin * column))).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    has, lacks = a + b, F.lit(float(toxic + clean)) - a - b
    ratio = 2 * (part(a, has, toxic) + part(b, has, clean) + part(toxic - a, lacks, toxic) + part(clean - b, lacks, clean))
    best = counts.withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "term")
    return sorted(r["term"] for r in best.limit(TERMS).select("term").collect())


def _document_frequencies(texts: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of all documents and, of those, how many have each term."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, n = Vectors(terms), np.zeros(len(terms) + 1, np.int64)
        for f in frames:
            n[-1] += len(f)
            for text in f["text"]:
                n[vectors.of(text)[0]] += 1
        at = np.flatnonzero(n)
        yield pd.DataFrame({"term": at, "n": n[at]})

    rows = texts.mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(terms) + 1, np.int64)
    for r in rows:
        out[r["term"]] = r["n"]
    return int(out[-1]), out[:-1].astype(float)


def fit(df: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", seed: str = "toxicity") -> Neighbours:
    """The nearest-example scorer of ``labels`` (ids, 0 or 1) whose rows of ``df`` satisfy ``may_learn``.

    The index and its calibration take a bounded sample of labelled rows (the constants above); document frequencies
    cover all rows of ``df``. Null labels, other values than 0 and 1 and null ids teach nothing; of several labels of
    one id, the largest counts. Without labels every score is 0; with one class only, that class's share.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("y"))
    rows = df.where(may_learn).select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select("id").distinct().join(known, "id").select("id", F.col("y").cast("int").alias("y"))
    drawn, base = _sample(ids, seed)
    # only the sampled rows' texts are moved; of rows with equal ids, the least text
    sample = (rows.join(bounded_broadcast(drawn), "id").groupBy("id", "y", "share").agg(F.min("text").alias("text"))
              .withColumn("id", F.col("id").cast("string")))
    sample = cut(_without_copies(sample))
    apart = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    terms = _marking_terms(sample.where(~apart))
    n, having = _document_frequencies(df.select(F.col(text).alias("text")), terms)
    idf = np.log((1.0 + n) / (1.0 + having)) + 1.0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(terms)
        for f in frames:
            found = [vectors.of(t) for t in f.pop("text")]
            f["terms"], f["counts"] = [t for t, _ in found], [c for _, c in found]
            yield f

    held = sample.select("id", "y", "share", apart.alias("apart"), "text").mapInPandas(
        run, "id string, y int, share double, apart boolean, terms array<long>, counts array<double>").toPandas()
    held["terms"] = [np.array(t, np.int64) for t in held["terms"]]
    held["counts"] = [np.array(c, np.float64) for c in held["counts"]]
    held["key"] = [(i, t.tobytes()) for i, t in zip(held["id"], held["terms"], strict=True)]
    held = held.sort_values("key", ignore_index=True)
    own, other = held[~held["apart"].astype(bool)], held[held["apart"].astype(bool)]
    vectors = [(t, weighed(t, c, idf)) for t, c in zip(own["terms"], own["counts"], strict=True)]
    model = Neighbours(terms, idf, BlockMaxIndex(vectors, len(terms)), own["id"].tolist(),
                       own["y"].to_numpy(np.float64), base)
    if len(other) and len(set(held["y"])) == 2:
        votes = np.array([model.found(v)[0] for v in zip(other["terms"], other["counts"], strict=True)])
        model.knots = isotonic(votes, other["y"].to_numpy(np.float64), 1.0 / other["share"].to_numpy(np.float64))
    return model


def scored(df: DataFrame, model: Neighbours, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id with score (0 to 1), predicted (score >= 0.5) and evidence: the nearest examples (id as text,
    label, cosine).

    Null and empty texts and texts without a marking term have no neighbours: the prior's vote, no evidence. Very long
    texts count whole, repeated rows give equal rows, ties of examples go by their number, an empty table gives no rows.
    Other columns play no part.
    """
    session = df.sparkSession
    parts = session.sparkContext.broadcast((model.terms, model.idf, vars(model.index), model.ids, model.toxic,
                                            model.share, model.knots))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, idf, arrays, ids, toxic, share, knots = parts.value
        index = BlockMaxIndex.__new__(BlockMaxIndex)
        vars(index).update(arrays)
        near_by, vectors = Neighbours(terms, idf, index, ids, toxic, share, knots), Vectors(terms)
        for f in frames:
            out = []
            for text in f.pop("text"):
                vote, near, cos = near_by.found(vectors.of(text))
                score = near_by.score(vote)
                out.append((score, int(score >= 0.5), [
                    {"example": ids[e], "toxic": int(toxic[e]), "similarity": min(float(c), 1.0)}
                    for e, c in zip(near[:EVIDENCE], cos[:EVIDENCE], strict=True)]))
            yield pd.DataFrame({"id": f["id"], **{k: [o[i] for o in out] for i, k in enumerate(
                ("score", "predicted", "evidence"))}})

    kind = df.schema[doc_id].dataType.simpleString()
    out = df.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")).mapInPandas(
        run, "id string, " + SCORES)
    return out.select(F.col("id").cast(kind).alias(doc_id), "score", "predicted", "evidence")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows whose crc32 of the id, modulo 5, is 0 teach nothing."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_of_id("doc_id") % 5 == 0
    model = fit(docs, labels, ~held_out)
    ids = F.transform("evidence", lambda e: e["example"].cast("long"))
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", ids.alias("neighbours"),
                                      F.transform("evidence", lambda e: e["similarity"]).alias("similarities"))
