import collections
import random
import zlib

import pytest

from flowguard.llm import mixing, sharding, tokens
from flowguard.llm.common import n_words

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


def library(texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library_on_random_text():
    rng = random.Random(5)
    bits = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "½", "١", "日本", "'s", "'", "!!", "A", "aaaa",
            "<|endoftext|>", "<|endof", "1234", "　", "🙂", "​", "\r\n", "ing", "tion", "xx" * 40]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(3000)]
    assert tokens.Counter(PATH)(texts) == library(texts)


def test_counts_do_not_depend_on_the_cache(monkeypatch):
    texts = [f"alpha beta{i} gamma{i % 7}. delta" for i in range(200)]
    expected = library(texts)
    monkeypatch.setattr(tokens, "CACHE", 3)
    monkeypatch.setattr(tokens, "RUN_CHARS", 100)
    assert tokens.Counter(PATH)(texts) == expected


def test_token_counts_of_edge_rows(edge, empty):
    rows = tokens.count_tokens(edge, PATH, limit=10).collect()
    texts = [r["text"] or "" for r in rows]
    assert [r["n_tokens"] for r in rows] == library(texts)
    assert [r["n_bytes"] for r in rows] == [len(t.encode()) for t in texts]
    assert all(r["over_limit"] == (r["n_tokens"] > 10) for r in rows)
    assert len(rows) == edge.count() and tokens.count_tokens(empty, PATH).count() == 0


def water(sizes, weights, share, most):
    """Targets by resharing again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def corpus(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randint(0, 400)), rng.choice(["s1", "s1", "s1", "s2", "s3", "s4", None])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_equal_resharing(spark):
    df = corpus(spark).withColumn("size", n_words("text")).withColumn("_src", mixing.source_key("source"))
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    sizes = {r["source"]: r["n"] for r in df.groupBy("source").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()}
    assert got == pytest.approx(water(sizes, (5, 2, 1), 1.5, 2.0))


def test_mix_meets_targets_and_repeats(spark):
    df = corpus(spark)
    rows = mixing.mix(df, block_words=16).collect()
    taken, target, per_doc = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r["source"]] += r["n_words"]
        target[r["source"]] = r["target"]
        per_doc[r["doc_id"], r["size"]] += r["n_words"]
    assert all(abs(taken[s] - target[s]) < 1 for s in target)
    assert all(n <= 2 * size for (_, size), n in per_doc.items())
    slots = [(r["slot"], r["source"]) for r in rows if r["slot"] is not None]
    assert len({s for s, _ in slots}) == len(set(slots))  # a slot has one source
    key = lambda r: (str(r["doc_id"]), str(r["slot"]), r["n_words"])
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mix(df.repartition(7), block_words=16).collect()))


def test_every_prefix_of_the_schedule_is_mixed(spark):
    rows = mixing.mix(corpus(spark, 600), block_words=8).where("slot IS NOT NULL").select(
        "slot", "source", "target").distinct().orderBy("slot").collect()
    total = sum({r["source"]: r["target"] for r in rows}.values())
    head = rows[:len(rows) // 4]
    for s, t in {r["source"]: r["target"] for r in rows}.items():
        share = sum(r["source"] == s for r in head) / len(head)
        assert abs(share - t / total) < 0.02


def test_mix_of_edge_rows(edge, empty):
    rows = mixing.mix(edge).groupBy("_src", "_row").agg({"n_words": "sum"}).collect()
    assert len(rows) == edge.count() and mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(edge).columns == edge.columns
    assert mixing.mixed_documents(edge).where("doc_id = 7").count() <= 4


def test_mixed_documents_end_at_the_boundary_nearest_to_the_target(spark):
    df = corpus(spark)
    whole = {(r["doc_id"], r["text"]) for r in df.collect()}
    got = mixing.mixed_documents(df).collect()
    assert {(r["doc_id"], r["text"]) for r in got} <= whole
    pieces = mixing.mix(df).groupBy("_src", "_row", "source", "pass", "size").agg({"n_words": "sum"}).withColumnRenamed("sum(n_words)", "n")
    want, words = collections.Counter(), collections.Counter()
    for r in pieces.where("n > 0").collect():
        want[r["source"]] += r["size"] * (2 * r["n"] >= r["size"])
    for r in got:
        words[r["source"]] += len((r["text"] or "").split())
    assert words == want
    targets = {r["source"]: (r["target"], r["most"]) for r in mixing.mix(df).groupBy("source").agg(
        {"target": "max", "size": "max"}).toDF("source", "a", "b").selectExpr("source", "greatest(a, b) AS x", "least(a, b) AS y")
        .selectExpr("source", "x AS target", "y AS most").collect()}
    assert all(abs(words[s] - t) <= m for s, (t, m) in targets.items() if t)


def shards_of(rows, shards):
    size, slots, where = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[r["text"] or ""].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(size) <= set(range(shards))
    return size, where


def test_shards_are_even_and_keep_copies_together(spark):
    rng = random.Random(2)
    texts = ["x" * rng.randint(0, 300) + str(i) for i in range(3000)] + ["copy " * 20] * 60
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_documents(df, 10).collect()
    size, where = shards_of(rows, 10)
    mean = sum(size.values()) / 10
    largest = max(60 * 108, 300)
    assert max(size.values()) < mean * 1.002 + largest and min(size.values()) > mean * 0.998 - largest
    assert all(len(s) == 1 for s in where.values())
    assert all(r["size"] == len((r["text"] or "").encode()) + 8 and r["text_crc32"] == zlib.crc32(
        (r["text"] or "").encode()) for r in rows)


def test_a_group_larger_than_a_shard_is_split(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same text', concat('t', id)) AS text")
    size, where = shards_of(sharding.shard_documents(df, 16).collect(), 16)
    mean = sum(size.values()) / 16
    assert len(where["same text"]) > 1 and max(size.values()) < 1.05 * mean and min(size.values()) > 0.95 * mean


def test_all_splitters_within_one_group(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "IF(id < 2900, 'same text', concat('t', id)) AS text")
    size, _ = shards_of(sharding.shard_documents(df, 2).collect(), 2)
    assert max(size.values()) < 1.05 * min(size.values())


def test_shards_of_edge_rows(edge, empty):
    rows = sharding.shard_documents(edge, 3).collect()
    assert len(rows) == edge.count()
    shards_of(rows, 3)
    assert sharding.shard_documents(empty, 3).count() == 0
