"""Near-duplicates by circulant MinHash.

Two permutations, the second read from circularly shifted places, give all coordinates of a signature. Equal sets are
one class from the start. Classes that share a band are tested against the best-connected class of their bucket, and
then every further pair of a bucket that could still join two components. Tests are exact, on full sets of shingles.
Pairs are spared them if their sizes or signatures rule a link out, or what the first tests told: which shingles of the
bucket's lead either class has, how many others, and into which places of a map these fall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import WordKeys, cut, mixed, read_table, shingle_keys, words_of

#: Places of the permutations; coordinates of a signature, in BANDS bands of ROWS. A pair of similarity 0.85 shares no
#: band with a chance of (1 - 0.85 ** 6) ** 40 = 6e-9, one of 0.8 with 5e-6.
UNIVERSE, BANDS, ROWS = 1 << 22, 40, 6
#: The last bit of each coordinate goes to a sketch of WORDS numbers of 64 bits. A pair is spared its test if its
#: sketches differ by SIGMAS standard deviations more than those of a pair at the limit would on average.
#: A pair at the limit is dropped so with a chance of 3.4e-8 (0.85) or 3.0e-8 (0.8).
WORDS, SIGMAS = 4, 6
#: Shingles that are looked up at once.
STEP = 4096
#: Places of the map of a text's shingles that another lacks, for each shingle of the other.
PLACES = 4
SCHEMA = "text_hash long, n_shingles long, cls binary, bands array<long>, sketch array<long>"


class Circulant:
    """Signatures of sets of 64-bit keys."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.first = rng.permutation(UNIVERSE).astype(np.int32)
        second = rng.permutation(UNIVERSE).astype(np.int32)
        n = BANDS * ROWS
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.r_[second, second[:n - 1]], n)

    def signature(self, keys: np.ndarray) -> np.ndarray:
        """Coordinate k is the least second[first[x] + k] over the set, places counted in a circle."""
        at = self.first[(keys >> np.uint64(42)).astype(np.int64)]
        out = self.shifted[at[:STEP]].min(axis=0)
        for i in range(STEP, len(at), STEP):
            np.minimum(out, self.shifted[at[i:i + STEP]].min(axis=0), out=out)
        return out

    def bands(self, signature: np.ndarray) -> np.ndarray:
        parts = signature.reshape(BANDS, ROWS).astype(np.uint64)
        out = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i in range(ROWS):
            out = mixed(out + parts[:, i] * np.uint64(0xD6E8FEB86659FD93))
        return out.view(np.int64)

    def sketch(self, signature: np.ndarray) -> np.ndarray:
        bits = np.zeros(64 * WORDS, np.uint8)
        bits[:len(signature)] = signature & 1
        return np.packbits(bits).view(np.int64)


def shingle_set(text, keys_of: WordKeys, size: int) -> np.ndarray:
    return np.unique(shingle_keys(keys_of.of(words_of(text)), size))


def signatures(df: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls, bands, sketch): cls names the set (128 bits), null as the rest for an empty
    one; doc_id and text_hash find the row again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        keys_of, hashes = WordKeys(), Circulant()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, cls, bands, sketches = [], [], [], []
                for t in part.column(1):
                    keys = shingle_set(t.as_py(), keys_of, size)
                    n.append(len(keys))
                    cls.append(xxhash.xxh3_128_digest(keys.tobytes()) if len(keys) else None)
                    found = hashes.signature(keys) if len(keys) else None
                    bands.append(None if found is None else hashes.bands(found))
                    sketches.append(None if found is None else hashes.sketch(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "n_shingles", "cls", "bands", "sketch"])

    ids = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def jaccard_of(size: int):
    """A pandas UDF for two texts: shared shingles, shingles in either, a bit for each shingle of the first (in rising
    order of keys): whether the second has it, and a map of the second's other shingles: the places, of as many for each
    first text, that their keys fall into."""
    @F.pandas_udf("both long, either long, has array<long>, others array<long>")
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keys_of, last = WordKeys(), {}

        def of(text):
            if text not in last:
                if len(last) >= 16:
                    last.clear()
                last[text] = shingle_set(text, keys_of, size)
            return last[text]

        for a, b in batches:
            both, either, has, others = [], [], [], []
            for x, y in zip(a, b, strict=True):
                s, t = of(x), shingle_set(y, keys_of, size)
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                hit = t[at] == s
                n = int(hit.sum())
                both.append(n)
                either.append(len(s) + len(t) - n)
                bits = np.zeros(-(-len(s) // 64) * 64, np.uint8)
                bits[:len(s)] = hit
                has.append(np.packbits(bits).view(np.int64))
                places = np.zeros(PLACES * len(bits), np.uint8)
                places[(np.delete(t, at[hit]) % np.uint64(len(places))).astype(np.int64)] = 1
                others.append(np.packbits(places).view(np.int64))
            yield pd.DataFrame({"both": both, "either": either, "has": has, "others": others})

    return count


def tested(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``pairs`` (a, b) with both, either, has and others. a may be the same class in very many pairs: it is joined last, where
    AQE can split it; each text is sent once a pair."""
    one = texts.select(F.col("cls").alias("b"), F.col("text").alias("_tb"))
    two = texts.select(F.col("cls").alias("a"), F.col("text").alias("_ta"))
    count = jaccard_of(size)(F.col("_ta"), F.col("_tb"))
    return (pairs.join(one, "b").join(two, "a").select("a", "b", count.alias("_n"))
            .select("a", "b", "_n.both", "_n.either", "_n.has", "_n.others"))


def components(edges: DataFrame) -> DataFrame:
    """(cls, root) for every end of an edge (a, b); root is the least class reachable.

    Large-star and small-star steps in turn: a class's neighbours are tied to its least neighbour until nothing
    changes, in a number of rounds that grows with the logarithm of the largest component.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    state = edges.where("a != b").select(high.alias("u"), low.alias("v")).distinct()
    before = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above u are tied to u's least neighbour
        state = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its neighbours below are tied to the least of them
        least = state.groupBy("u").agg(F.min("v").alias("m"))
        state = state.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        state = cut(state)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = state.select(F.col("u").alias("cls"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("cls"), "root").distinct())


def buckets(classes: DataFrame) -> DataFrame:
    """(h, cls, lead, degree): members of the band buckets of two classes or more. lead is the member that meets most
    others in all its buckets together (degree): among near copies of one text, most often that text."""
    rows = classes.select("cls", F.explode("bands").alias("h"))
    many = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(rows.join(many, "h"))
    degree = members.groupBy("cls").agg(F.sum("n").alias("degree"))
    ranked = members.join(degree, "cls").select("h", "cls", F.struct("degree", "cls").alias("rank"))
    leads = ranked.groupBy("h").agg(F.max("rank").alias("best")).select(
        "h", F.col("best.cls").alias("lead"), F.col("best.degree").alias("degree"))
    return members.select("h", "cls").join(leads, "h")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85,
                    size: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of ``df``; rows link if their sets of ``size``-word
    shingles have a Jaccard similarity of ``percent`` / 100 or more.

    A-Z count as a-z. A text of fewer words is one shingle; one without words, or null, has an empty set, links with
    nothing and is its own component. component_id is the least doc_id reachable by links. Repeated rows each get
    their row. A null id has a null component unless its copies have ids. An empty table gives no rows. Other columns
    of ``df`` are not used. Chance enters twice: a link that shares no band is missed (see BANDS),
    and one not joined through a bucket's lead whose sketches differ too much (see SIGMAS).
    """
    rows = cut(signatures(df, doc_id, text, size))
    # classes go by a number from here on
    heads = cut(rows.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("cls").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("h")).select(
        F.col("cls").alias("digest"), F.col("h.doc_id").alias("rep"), F.col("h.text_hash").alias("rep_hash"))
        .withColumn("cls", F.monotonically_increasing_id()))
    of_heads = rows.withColumnRenamed("cls", "digest").join(heads.withColumnRenamed("digest", "_d"), [
        F.col("digest") == F.col("_d"), F.col("doc_id") == F.col("rep"), F.col("text_hash") == F.col("rep_hash")])
    members = cut(buckets(of_heads.select("cls", "bands")))
    mine = members.select("cls").distinct()
    about = cut(of_heads.select("cls", F.col("n_shingles").alias("n"), "sketch").join(mine, "cls", "left_semi"))
    texts = cut(texts_of(df, heads.join(mine, "cls", "left_semi"), doc_id, text))
    linked = F.expr(f"100 * both >= {percent} * either")
    # each class against the best lead that it meets, then all leads of the buckets that this leaves open
    star = members.where("cls != lead")
    best = star.groupBy("cls").agg(F.max(F.struct("degree", "lead")).alias("b")).select(F.col("b.lead").alias("a"), F.col("cls").alias("b"))
    stars = cut(tested(best, texts, size))
    roots = components(stars.where(linked))
    stray = in_components(members, roots).where("root != lead_root").select("h").distinct()
    rest = (star.join(stray, "h", "left_semi").select(F.col("lead").alias("a"), F.col("cls").alias("b")).distinct()
            .join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    later = cut(tested(rest, texts, size))
    if not later.where(linked).isEmpty():
        roots = components(edges_of(roots).unionByName(later.where(linked).select("a", "b")))
    stars = stars.unionByName(later)
    more = cut(tested(open_pairs(members, about, stars, roots, percent), texts, size).where(linked))
    if not more.isEmpty():
        roots = components(edges_of(roots).unionByName(more.select("a", "b")))
    named = heads.join(roots, "cls")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    found = heads.join(named.select("cls", "root").join(least, "root").select("cls", "least"), "cls", "left").select(
        F.col("digest").alias("cls"), F.coalesce("least", "rep").alias("_component"))
    return rows.drop("bands", "sketch").join(found, "cls", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("_component", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def texts_of(df: DataFrame, heads: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(cls, text): the text of the first document of each class."""
    docs = df.select(F.col(doc_id).alias("rep"), F.col(text).alias("text"), F.xxhash64(text).alias("rep_hash"))
    return docs.join(heads, ["rep", "rep_hash"]).dropDuplicates(["rep", "rep_hash"]).select("cls", "text")


def plausible(percent: int) -> Column:
    """Whether a pair (na, sa, nb, sb: sizes and sketches) may be similar enough."""
    limit, n = percent / 100, BANDS * ROWS
    off = (1 - limit) / 2
    most = math.ceil(n * off + SIGMAS * math.sqrt(n * off * (1 - off)))
    differ = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(WORDS)), F.lit(0))
    return F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)") & (differ <= most)


def not_excluded(percent: int) -> Column:
    """Whether a pair may still be similar enough, by its bucket's lead: the two share at most the lead's shingles that
    both have (ha, hb), and of either's others (oa, ob) no more than there are, less the places of its map (ma, mb) that
    the other's lacks: one shingle at least fell into each, which the other cannot have."""
    def bits(of) -> Column:
        return F.aggregate(of, F.lit(0), lambda n, x: n + F.bit_count(x))

    def alone(x: str, y: str) -> Column:
        return bits(F.zip_with(x, y, lambda p, q: p.bitwiseAND(F.bitwise_not(q))))

    most = bits(F.zip_with("ha", "hb", lambda p, q: p.bitwiseAND(q))) + F.least(
        F.col("oa") - alone("ma", "mb"), F.col("ob") - alone("mb", "ma"))
    return 100 * most >= percent * (F.col("na") + F.col("nb") - most)


def edges_of(roots: DataFrame) -> DataFrame:
    return roots.where("cls != root").select(F.col("cls").alias("a"), F.col("root").alias("b"))


def in_components(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the roots of class and lead (themselves, if nothing links them)."""
    of_lead = roots.select(F.col("cls").alias("lead"), F.col("root").alias("lead_root"))
    return (members.join(roots, "cls", "left").join(of_lead, "lead", "left")
            .withColumns({"root": F.coalesce("root", "cls"), "lead_root": F.coalesce("lead_root", "lead")}))


def open_pairs(members: DataFrame, about: DataFrame, stars: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a bucket but no component yet. One of them is outside its lead's component; both meet by
    bucket and size class, as sizes of linked sets differ by the limit at most. In the buckets that have such classes all
    members were tested against the lead, which with sketches and sizes rules most pairs out as they meet."""
    size = F.floor(F.log("n") / -math.log(percent / 100) + F.lit(1e-9)).cast("int")
    all_ = in_components(members, roots).select("h", "cls", "lead", "root", "lead_root")
    stray = all_.where("root != lead_root").select("h").distinct()
    told = stars.select(F.col("a").alias("lead"), F.col("b").alias("cls"), "both", "has", F.col("others").alias("map"))
    near = (all_.join(stray, "h", "left_semi").join(told, ["lead", "cls"]).join(about, "cls")
            .withColumns({"size": size, "others": F.col("n") - F.col("both")}))
    near = cut(near.select("h", "size", "cls", "n", "root", "lead_root", "others", "sketch", "has", "map"))

    def side(rows: DataFrame, x: str) -> DataFrame:
        return rows.select("h", "size", "lead_root", *[F.col(c).alias(n + x) for c, n in (
            ("cls", ""), ("n", "n"), ("root", "r"), ("others", "o"), ("sketch", "s"), ("has", "h"), ("map", "m"))])

    one = side(near.where("root != lead_root").withColumn(
        "size", F.explode(F.sequence(F.col("size") - 1, F.col("size") + 1))), "a").drop("lead_root")
    may = F.expr("ra != rb AND (rb = lead_root OR a < b)") & plausible(percent) & not_excluded(percent)
    return one.join(side(near, "b"), ["h", "size"]).where(may).select("a", "b").distinct()


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80,
                 size: int = 5) -> DataFrame:
    """The rows of ``df``, all columns, that near_duplicates keeps: one id of each component. Of rows equal in id and
    text one stays; rows without id all stay."""
    kept = near_duplicates(df, doc_id, text, percent, size).where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    mine = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.xxhash64(text).alias("_hash"),
                     F.col(doc_id).alias("_id"))
    return (mine.where("_id IS NOT NULL").join(kept, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
            .unionByName(mine.where("_id IS NULL")).select("_row.*"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash")
