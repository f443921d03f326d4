import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import merkle, phrases, toxicity
from tests.llm.conftest import DOCS

# --- manifest -----------------------------------------------------------------------


def brute_manifest(rows, tampered):
    """{(doc_id, leaf): sorted (proof_sha256, folded_root, subroot, root)} of (doc_id, source, lang, n_chars, text)."""
    def H(s):
        return hashlib.sha256(s.encode()).hexdigest()

    def leaf(r):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    trees = defaultdict(list)
    for r in rows:
        own = leaf(r)
        claimed = leaf((r[0], r[1], r[2], None if r[3] is None else r[3] + 1, r[4])) if tampered(r[0]) else own
        trees[r[2]].append((r[0] is not None, r[0] or 0, own, claimed))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {k: levels([x[2] for x in sorted(trees[k])]) for k in names}
    top = levels([built[k][-1][0] for k in names])
    out = defaultdict(list)
    for i, k in enumerate(names):
        for j, (known, doc_id, own, claimed) in enumerate(sorted(trees[k])):
            proof, at, value = "", j, claimed
            for table, start in ((built[k], j), (top, i)):
                at = start
                for nodes in table[:-1]:
                    other = nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
                    proof += other
                    value = H(other + value if at & 1 else value + other)
                    at >>= 1
            out[doc_id if known else None, own].append((H(proof), value, built[k][-1][0], top[-1][0]))
    return {k: sorted(v) for k, v in out.items()}


def run_manifest(df):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [*fields[:3], F.col("n_chars") + 1, fields[4]]
    leaf = merkle.leaf_digest(fields)
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = defaultdict(list)
    for r in merkle.manifest(df, "doc_id", "lang", leaf, F.when(bad, merkle.leaf_digest(more)).otherwise(leaf)).collect():
        assert r["verified"] == (r["folded_root"] == r["root"])
        got[r["doc_id"], r["leaf"]].append((r["proof_sha256"], r["folded_root"], r["subroot"], r["root"]))
    return {k: sorted(v) for k, v in got.items()}


def tampers(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def test_manifest_equals_brute_force_on_edges(spark, edge):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in edge.collect()]
    assert run_manifest(edge) == brute_manifest(rows, tampers)


@pytest.mark.parametrize("band", [2, 12])
def test_manifest_over_several_bands(spark, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    rng = random.Random(5)
    rows = [(i, "s", rng.choice(["en"] * 6 + ["de", "fr", None]), i, f"text {i}") for i in range(150)] + [(900, None, "xx", 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    want = brute_manifest(rows, tampers)
    assert run_manifest(df) == want
    assert any(v[0][1] != v[0][3] for v in want.values())


def test_manifest_of_nothing_and_of_one_row(spark, empty):
    assert run_manifest(empty) == {}
    one = spark.createDataFrame([(7, "x", "a", "en", 1, 0.0, "", "")], "doc_id long, text string, source string, "
                                "lang string, n_chars long, score double, size string, shard string")
    (key, [(proof, folded, subroot, root)]), = run_manifest(one).items()
    assert subroot == root == key[1] and proof == hashlib.sha256(b"").hexdigest()


# --- phrases ------------------------------------------------------------------------

def brute_phrases(rows, least, longest, top):
    f, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang or "und", (text or "")
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: n for p, n in counts.items() if len(p) > 1 and n >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((10 ** 6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, r, words[lang], -score))
    return sorted(out)


def mined(df, **kw):
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in cols) for r in phrases.mine_phrases(df, **kw).collect())


def babble(seed, n):
    rng = random.Random(seed)
    vocab = ["the", "of", "New", "york", "new", "état", "日本", "x", "ß", "the\x00", "a-b"]
    out = []
    for _ in range(n):
        words = rng.choices(vocab, k=rng.randint(0, 40))
        out.append((rng.choice(["en", "de", None]), "".join(w + rng.choice([" ", "  ", "\t", ", ", ".\n", " \r", "\x0b"]) for w in words)))
    return out


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_equal_brute_force(spark, longest):
    rows = babble(longest, 120)
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "lang string, text string").repartition(3)
    want = brute_phrases(rows, 4, longest, 25)
    assert want and mined(df, least=4, longest=longest, top=25) == want


def test_phrases_ranked_in_several_tasks(spark, monkeypatch):
    rows = babble(9, 150)
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(phrases, "RANKED", 40)
    assert mined(df, least=2, top=10) == brute_phrases(rows, 2, 3, 10)


def test_sums_of_phrases_do_not_hold_their_parts_twice():
    import tracemalloc

    rng = np.random.default_rng(2)
    want = {}
    tracemalloc.start()
    try:
        parts = [(rng.integers(0, 1 << 62, 20_000, dtype=np.uint64) >> np.uint64(42), np.ones(20_000, np.int64),
                  *(np.full(20_000, i) for _ in range(5))) for i in range(20)]
        for key, n, *_ in parts:
            for k in key.tolist()[:100]:
                want[k] = 0
        for key, n, *_ in parts:
            found, times = np.unique(key, return_counts=True)
            for k, m in zip(found.tolist(), times.tolist()):
                if k in want:
                    want[k] += m
        held = sum(c.nbytes for part in parts for c in part)
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        key, n, *more = phrases._summed(parts)
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert (np.diff(key.astype(np.int64)) > 0).all() and n.sum() == 400_000 and len(more) == 5
    got = dict(zip(key.tolist(), n.tolist()))
    assert all(got[k] == m for k, m in want.items())
    assert peak < held


def test_phrases_sent_in_several_parts(spark, monkeypatch):
    rng = random.Random(8)
    docs = [(i, rng.choice(["en", "de", None]), " ".join(rng.choices("abcdef", k=rng.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    want = sorted(phrases.mine_phrases(df).collect())
    assert len(want) > 100
    for name, value in (("BLOCK", 1000), ("HELD", 150), ("SENT", 40)):
        monkeypatch.setattr(phrases, name, value)
    assert sorted(phrases.mine_phrases(df).collect()) == want


def test_phrases_that_collide_stay_apart(spark, monkeypatch):
    """With the first fingerprint cut to four bits nearly all runs collide; the second still tells them apart."""
    rows = [("en", "a b c. " * 3 + "d e f. " * 4 + "g h. " * 5)]

    class Weak(phrases.Spans):
        def keys(self, at, size, which=0):
            return super().keys(at, size, which) & np.uint64(15 if which == 0 else (1 << 64) - 1)

    monkeypatch.setattr(phrases, "Spans", Weak)
    assert mined(spark.createDataFrame(rows, "lang string, text string"), least=2) == brute_phrases(rows, 2, 3, 2000)


@pytest.mark.parametrize("forgetful", [False, True])
def test_phrases_read_from_shares_of_the_rows(spark, monkeypatch, forgetful):
    """Phrases that a share of the rows does not hold are read from more rows, to the last one."""
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 1000)
    if forgetful:
        monkeypatch.setattr(phrases, "SEEN_BITS", 0)
        monkeypatch.setattr(phrases, "SENT", 20)
    rows = babble(21, 300) + [("en", "seldom seen. ")] * 2 + [("en", "often seen. ")] * 200
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert mined(df, least=2, top=50) == brute_phrases(rows, 2, 3, 50)


def test_tasks_send_few_rows_of_runs(spark, monkeypatch):
    """Every task holds the same frequent runs; what it sends are their sums by bucket, not a row for each."""
    frame = type(spark.range(1))
    plain, rows = frame.mapInArrow, []

    def observed(self, func, schema, *more, **options):
        sent = spark.sparkContext.accumulator(0)

        def run(batches):
            for batch in func(batches):
                sent.add(batch.num_rows)
                yield batch

        rows.append((str(schema), sent))
        return plain(self, run, schema, *more, **options)

    monkeypatch.setattr(frame, "mapInArrow", observed)
    text = " ".join(f"w{i}" for i in range(3000))
    df = spark.createDataFrame([("en", text)] * 12, "lang string, text string").repartition(6)
    got = phrases.frequent_phrases(df, "text", "lang").collect()
    assert len(got) == 3 * 3000 - 3 + 1 and {r["n"] for r in got} == {12, 36000}
    sent = [n.value for schema, n in rows if schema != "lang string, phrase string, size int, n long"]
    assert sent and max(sent) <= 6 * 300


def test_sums_tell_keys_of_different_checks_apart():
    key, n, check = phrases._summed([(np.array([5, 5, 5, 7], np.uint64), np.array([1, 2, 3, 4]), np.array([1, 2, 1, 1]))], 2)
    assert list(zip(key.tolist(), n.tolist(), check.tolist())) == [(5, 4, 1), (5, 2, 2), (7, 4, 1)]


def test_phrases_of_edges(spark, edge, empty):
    rows = [(r["lang"], r["text"]) for r in edge.collect()]
    assert mined(edge, least=2, top=50) == brute_phrases_long(rows)
    assert mined(empty) == []


def brute_phrases_long(rows):
    """The brute force without its quadratic containment step (for one long text): by sub-runs of three-word phrases."""
    f, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").lower()):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, n in f.items():
        longer = Counter()
        for p, a in n.items():
            if len(p) == 3 and a >= 2:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        kept = []
        for p, a in n.items():
            if len(p) > 1 and a >= 2 and not (len(p) == 2 and 100 * longer[p] >= 50 * a):
                score, k = min((10 ** 6 * a * a // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, words[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:50], 1)]
    return sorted(out)


# --- toxicity -----------------------------------------------------------------------

def test_block_max_neighbours_are_the_exact_ones():
    rng = np.random.default_rng(3)
    vectors = []
    for i in range(700):
        t = np.sort(rng.choice(60, size=rng.integers(0, 9), replace=False))
        w = rng.integers(1, 4, len(t)).astype(float)
        vectors.append((t, w / np.linalg.norm(w) if len(t) else w))
    dense = np.zeros((700, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vectors, 60)
    for _ in range(200):
        t = np.sort(rng.choice(60, size=rng.integers(0, 7), replace=False))
        w = rng.random(len(t)) + 0.1
        near, cos = index.nearest(t, w, 15)
        exact = dense[:, t] @ w
        hit = np.flatnonzero(exact > 0)
        want = hit[np.lexsort((hit, -np.round(exact[hit], 12)))][:15]
        assert near.tolist() == want.tolist()
        assert np.allclose(cos, exact[want])


def test_isotonic_votes():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert np.allclose(x, [0.1, 0.25, 0.4]) and np.allclose(y, [0.0, 0.5, 1.0])


def toxic_table(spark, n=400):
    rng = random.Random(1)
    common = [f"wort{i}" for i in range(80)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(20, 60))
        bad = i % 4 == 0
        if bad:
            words[5:5] = rng.choices(["schuftikus", "schuftige", "lumpenpack"], k=2)
        docs.append((i, " ".join(words), "de", "a", 1, 0.0, "", ""))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_of_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    rows = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert len(rows) == 400
    for i in range(0, 400, 5):
        assert rows[i]["predicted"] == (i % 4 == 0)
        assert rows[i]["predicted"] == (rows[i]["score"] >= 0.5)
    hit = rows[20]["evidence"][0]
    assert hit["toxic"] == 1 and 0 < hit["similarity"] <= 1 and int(hit["example"]) % 5 != 0
    assert [r["score"] for r in toxicity.scored(docs.repartition(3), model).orderBy("doc_id").collect()] == [
        rows[i]["score"] for i in range(400)]


def test_toxicity_of_edges(spark, edge, empty):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.scored(edge, model).collect()
    assert len(out) == edge.count() and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["evidence"] == [] for r in out)
    assert toxicity.scored(empty, model).collect() == []
    unlabelled = toxicity.fit(edge, labels.where("false"), F.lit(True))
    assert {r["score"] for r in toxicity.scored(edge, unlabelled).collect()} == {0.0}
    nulls = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (5, 9)], labels.schema))
    assert toxicity.fit(empty, nulls, F.lit(True)).terms == []
    one_class = toxicity.fit(docs, labels.where("toxic = 1"), F.lit(True))
    assert {r["score"] for r in toxicity.scored(docs, one_class).collect()} == {1.0}
