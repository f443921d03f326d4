import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import host_rules, lm, quality
from flowguard.llm.common import crc_of_id
from flowguard.llm.queries import LLM_QUERIES

SF01 = "/root/testdata/sf0.01"


def rules_of(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 3)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_statistics_equal_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["a ", "b ", "c\n", "#", "é", "\t", "word "], k=rng.randint(0, 300))) for _ in range(200)]
    texts += [" ".join(f"x{i % n}" for i in range(400)) for n in (2, 3, 30, 70, 399, 400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in host_rules.text_statistics(df).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == rules_of(texts[r["doc_id"]])


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"h{i % 10}", good if i % 10 or i % 40 == 0 else "short") for i in range(1000)]
    rows += [(2000, "lonely", "short"), (2001, "lonely", good), (2002, None, good), (2003, None, "short")]
    got = {r["doc_id"]: r["kept"] for r in host_rules.host_rules(
        spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert not any(got[i] for i in range(0, 1000, 10)) and all(got[i] for i in range(1000) if i % 10)
    assert got[2001] and got[2002] and not got[2003] and not got[2000]


def test_host_rules_of_edge_rows(edge, empty):
    rows = host_rules.host_rules(edge).collect()
    assert len(rows) == edge.count() and host_rules.host_rules(empty).count() == 0
    assert not any(r["kept"] for r in rows if r["doc_id"] != 5)


def test_held_out_quality(spark):
    got = LLM_QUERIES["op5_quality"](spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and (r["predicted"] == 1) == (r["score"] >= 0.7) for r in got.collect())


def test_quality_of_edge_rows_and_without_labels(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1)], "doc_id long, quality int")
    keep = F.lit(True)
    ensemble = quality.fit_on(edge, labels, keep)
    rows = quality.score(edge, ensemble).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.kept(edge, ensemble).columns == edge.columns
    assert quality.score(empty, ensemble).count() == 0
    none = quality.fit_on(edge, labels.limit(0), keep)
    assert none.weights == () and quality.score(edge, none).where("predicted = 1").count() == edge.count()


def test_rules_compile_to_what_they_say(spark):
    texts = [(0, "Good words here, as one would write."), (1, "!!! ### |||"), (2, "")]
    stats = quality.statistics(spark.createDataFrame(texts, "doc_id long, text string"))
    rule = quality.Rule((("bangs", True, 0.1), ("words", False, 5.0)))
    got = {r["doc_id"]: (r["x"], r["_s"]["bangs"], r["_s"]["words"]) for r in stats.withColumn("x", rule.column()).collect()}
    assert all(x == (b > 0.1 and w <= 5) for x, b, w in got.values()) and got[1][0]


def base_of(docs, held):
    count, total = {}, 0
    tokens = {d: [*(t or "").encode().lower().split(), None] for d, t in docs}
    for d, ws in tokens.items():
        if d not in held:
            total += len(ws)
            for w in ws:
                count[w] = count.get(w, 0) + 1
    bottom = total + len(count) + 1
    return total, {d: (len(ws), sum(w in count for w in ws), sum(math.log10((count.get(w, 0) + 1) / bottom) for w in ws))
                   for d, ws in tokens.items()}


def test_base_scores_equal_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm, "HEAD", 20)
    rng = random.Random(3)
    docs = [(i, " ".join(f"W{int(rng.expovariate(0.05))}" + rng.choice(["", ".", ",", "é"]) for _ in range(rng.randint(0, 80))))
            for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = lm.score(df, F.col("doc_id") % 7 == 2).collect()
    total, want = base_of(docs, {i for i in range(150) if i % 7 == 2})
    assert len(rows) == 150
    for r in rows:
        n, known, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_the_model_is_normalised_and_learns_context():
    rng = np.random.default_rng(0)
    n = 12
    model = lm.LogBilinear(np.full(n, 1 / n))
    w = np.array([i % n for i in range(20_000)])
    u, v = np.r_[0, w[:-1]], np.r_[0, 0, w[:-2]]
    seen = {}
    for _ in range(3):
        model.train(u, v, w, rng, seen)
    parts, norm = model.tables()
    logs = parts[0][:, None, :] + parts[1][None, :, :] - norm[:, :, None]
    assert np.allclose(np.exp(logs).sum(axis=2), 1)
    assert logs[u, v, w].mean() > -0.5 > np.log(1 / n)


def test_the_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    row = lm.score(docs, crc_of_id("doc_id") % 7 == 2).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > 0.98 * row[1] and row[0] > row[1]


def test_the_second_level_is_normalised_and_learns_context():
    rng = np.random.default_rng(0)
    edges, far = np.array([0, 5, 11]), np.r_[np.full(5, 0.2), np.full(6, 1 / 6)]
    model = lm.LogBilinear(np.full(4, 0.25), edges, far)
    u = rng.integers(0, 4, 20_000)
    x = np.where(u < 2, u, 5 + u)
    seen = {}
    for _ in range(3):
        model.train_far(u, x, rng, seen)
    logs = model.near @ model.far.T + model.far_bias
    norm = model.far_norms()
    for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        assert np.allclose(np.exp(logs[:, a:b] - norm[:, [c]]).sum(axis=1), 1, atol=1e-5)
    cluster = np.searchsorted(edges, x, side="right") - 1
    assert (logs[u, x] - norm[u, cluster]).mean() > -0.3 > np.log(1 / 5)


def zipf_texts(n, seed=5):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{int(3 * rng.paretovariate(0.9))}" + rng.choice(["", "", ".", "é"]) for _ in range(rng.randint(0, 60))))
            for i in range(n)]


def test_model_scores_equal_brute_force_from_its_parameters(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lm, "HEAD", 12)
    made = {}
    of, norms = lm.Vocabulary.of, lm.LogBilinear.far_norms
    monkeypatch.setattr(lm.Vocabulary, "of", staticmethod(lambda c: made.setdefault("vocabulary", of(c))))
    monkeypatch.setattr(lm.LogBilinear, "far_norms", lambda self: (made.update(model=self), norms(self))[1])
    docs = zipf_texts(120)
    rows = lm.score(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") % 7 == 2).collect()
    voc, model = made["vocabulary"], made["model"]
    assert len(voc.edges) > 2 and len(voc.keys) > 12
    keys_of = lm.ShapedKeys()
    tokens = {d: [keys_of[w] for w in lm.words_of(t)] + [int(lm.END)] for d, t in docs}
    count = {}
    for d, ws in tokens.items():
        for k in ws if d % 7 != 2 else ():
            count[k] = count.get(k, 0) + 1
    known = voc.keys.tolist()
    place = {k: i for i, k in enumerate(known)}
    rare = [k for k in count if k not in place]

    def p(k, u, v):
        z = [math.exp((model.one[u] + model.two[v]) @ model.out[c] + model.bias[c]) for c in range(len(model.bias))]
        i = place.get(k, len(known) + k % 8)
        c, x = int(voc.classes[i]), int(voc.places[i])
        out = z[c] / sum(z)
        if x >= 0:
            a = next(a for a in range(len(voc.edges) - 1) if voc.edges[a] <= x < voc.edges[a + 1])
            y = [math.exp(model.near[u] @ model.far[j] + model.far_bias[j]) for j in range(voc.edges[a], voc.edges[a + 1])]
            out *= y[x - voc.edges[a]] / sum(y)
        elif k not in place:
            out *= (count.get(k, 0) + 1) / (sum(count[r] + 1 for r in rare if r % 8 == k % 8) + 1)
        return c, out

    end = p(int(lm.END), 0, 0)[0]
    for r in rows[::4]:
        u, v, total = end, end, 0.0
        for k in tokens[r["doc_id"]]:
            c, one = p(k, u, v)
            u, v, total = c, u, total + math.log10(one)
        assert r["score"] == pytest.approx(total, rel=1e-4)


def test_the_vocabulary_grows_with_the_corpus(spark, monkeypatch):
    sizes = []
    of = lm.Vocabulary.of
    monkeypatch.setattr(lm.Vocabulary, "of", staticmethod(lambda c: (sizes.append(of(c)), sizes[-1])[1]))
    for n in (60, 600, 6000):
        lm.score(spark.createDataFrame(zipf_texts(n), "doc_id long, text string"), F.lit(False))
    words = [len(v.keys) for v in sizes]
    assert words[0] < words[1] < words[2]


def test_equal_and_null_ids_are_scored_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    df = spark.createDataFrame([(None if i % 2 else 7, f"one two three {i % 3}.") for i in range(300)], "doc_id long, text string")
    rows = lm.score(df, F.col("doc_id").isNull() & F.lit(None)).collect()
    assert len(rows) == 300 and {r["doc_id"] for r in rows} == {None, 7} and not any(r["held_out"] for r in rows)
    assert len({r["score"] for r in rows}) <= 3


def test_lm_of_edge_rows(edge, empty):
    rows = lm.score(edge, F.lit(False)).collect()
    assert len(rows) == edge.count()
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (2, 3, 4))
    nothing = lm.score(edge, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in nothing)
    assert lm.score(empty, F.lit(False)).count() == 0


def test_statistics_are_computed_once_for_all_rules(spark):
    """A filter by a score moves below the statistics: each count stays in the plan once, however many rules look at it."""
    texts = [(0, None), (1, ""), (2, " "), (3, "\t\x0b a\x1fb  Ca!|A. \u00c9? \u00e99 #{}\\ \r\n\nab\nab\n"), (4, "[b Z[ A"), (5, "a ")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rules = tuple((quality.Rule((("digits", True, i / 10), ("words", False, 9.0 + i))), 0.5) for i in range(6))
    ensemble = quality.Ensemble(0.1, rules)
    for made in (quality.kept(df, ensemble), quality.score(df, ensemble)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("[0-9]") == 1 and "[A-Z]" not in plan
    few, every = [
        quality.statistics(df.where("doc_id = 3"), names=names).first()["_s"].asDict()
        for names in (("digits", "same_lines"), quality.STATISTICS)]
    assert list(every) == list(quality.STATISTICS) and few == {k: every[k] for k in few}
    assert every["words"] == 7 and every["short"] == 5 / 7 and every["first_upper"] == 1 / 7 and every["same_lines"] == 1 / 3
