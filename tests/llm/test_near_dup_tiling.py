import collections
import random

import numpy as np

from flowguard.llm import decontaminate, near_dup


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(docs, percent):
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)}


def copies(rng, n=40):
    words = [f"w{i}" for i in range(500)]
    docs = []
    for _ in range(n):
        base = rng.choices(words, k=rng.randint(3, 120))
        docs.append(base)
        for _ in range(rng.randint(0, 6)):
            edit = list(base)
            for _ in range(rng.randint(0, 4)):
                edit[rng.randrange(len(edit))] = rng.choice(words)
            docs.append(edit)
    rng.shuffle(docs)
    return [(i, " ".join(d).upper() if i % 5 == 0 else "\n".join(d)) for i, d in enumerate(docs)]


def test_components_equal_brute_force(spark):
    docs = copies(random.Random(3))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (85, 60):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(df, percent=percent).collect()}
        want = brute(docs, percent)
        if percent == 85:
            assert got == want
        else:  # bands are laid out for 0.8 and more: below, no wrong link may be made
            assert all(want[c][1] == want[d][1] for d, (_, c) in got.items())


def test_chains_of_copies_join_and_pairs_below_stay_apart(spark):
    # each text differs from the next by a little; the ends share less than the limit
    words = [f"v{i}" for i in range(200)]
    docs = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(25)]
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in brute(docs, 85).items()}


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"u{i}" for i in range(150)]
    docs = [(0, " ".join(base))]
    for i in range(1, 300):
        edit = list(base)
        for _ in range(rng.randint(1, 3)):
            edit[rng.randrange(150)] = f"x{i}"
        docs.append((i, " ".join(edit)))
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in brute(docs, 85).items()}


def test_pairs_of_near_copies_below_the_limit_are_told_apart_by_their_lead(spark, monkeypatch):
    # copies that link with the text they come from but not, or hardly, with each other; the text itself is not there
    rng, opened, open_pairs = random.Random(6), [], near_dup.open_pairs
    base = [f"u{i}" for i in range(150)]
    docs = []
    for i in range(120):
        edit = list(base)
        for at in rng.sample(range(150), 2):
            edit[at] = f"x{i}"
        docs.append((i, " ".join(edit)))

    def counted(*args):
        pairs = near_dup.cut(open_pairs(*args))
        opened.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dup, "open_pairs", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = {d: c for d, (_, c) in brute(docs, 85).items()}
    assert got == want and len(set(want.values())) > 60
    assert opened[0] < 120


def test_estimate_of_circulant_signatures():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    c = near_dup.Circulant()
    a, b = c.signature(keys[:2000]), c.signature(keys[1000:])
    assert abs((a == b).mean() - 1000 / 3000) < 0.15
    assert (c.signature(keys[:2000][::-1].copy()) == a).all()


def test_edge_rows(edge, empty):
    rows = near_dup.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == {(6, 1, True)} and by[6] == {(6, 1, False)}
    assert by[2] == {(0, 2, True)} and by[3] == {(0, 3, True)} and by[4] == {(0, 4, True)}
    assert by[7] == {(1, 7, True)} and by[5] == {(4001, 5, True)}
    assert by[None] == {(1, 7, True), (0, None, True)}
    kept = near_dup.deduplicated(edge).collect()
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 5, 7, 8] and ids.count(None) == 2
    assert near_dup.deduplicated(edge).columns == edge.columns
    assert near_dup.near_duplicates(empty).count() == 0


def greedy(doc, item, least):
    """Greedy string tiling, word by word."""
    md, mi, out = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not md[a + n] and not mi[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return sorted(out)
        out.append((a, b, n))
        md[a:a + n], mi[b:b + n] = [True] * n, [True] * n


def test_tiles_equal_greedy_tiling_word_by_word():
    rng = random.Random(6)
    for _ in range(150):
        item = [rng.randint(0, 6) for _ in range(rng.randint(3, 30))]
        doc = [rng.randint(0, 6) for _ in range(20)] + item[10:] + item[:10] + [rng.randint(0, 6) for _ in range(10)]
        least = 3
        keys = {(a, b) for a in range(len(doc) - least + 1) for b in range(len(item) - least + 1)
                if doc[a:a + least] == item[b:b + least]}
        at = sorted(keys)
        got = decontaminate.tiles(np.array([a for a, _ in at], int), np.array([b for _, b in at], int), least)
        assert sorted(got) == greedy(doc, item, least)


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(8)
    items = [[f"q{rng.randint(0, 400)}" for _ in range(rng.randint(3, 40))] for _ in range(30)]
    docs = []
    for i in range(120):
        text = [f"z{rng.randint(0, 300)}" for _ in range(rng.randint(0, 60))]
        if i % 3:
            item = rng.choice(items)
            cut, part = rng.randint(0, len(item)), rng.randint(0, 6)
            moved = item[cut:] + ["z0"] * part + item[:cut]
            text = text[:20] + moved[:rng.randint(1, len(moved))] + text[20:]
        docs.append((i, " ".join(text).upper()))
    bench = [(i, " ".join(t)) for i, t in enumerate(items)]
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = {}
    for d, t in docs:
        for i, item in enumerate(items):
            n = sum(x[2] for x in greedy(t.lower().split(), item, min(5, len(item))))
            if 100 * n >= 80 * len(item):
                want[d, i] = n
    assert got == want and len(want) > 10


def test_decontamination_of_edge_rows(spark, edge, empty):
    bench = spark.createDataFrame([(1, "cat sat on the mat and"), (1, "cat sat on the mat and"), (2, None), (3, ""),
                                   (None, "word")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(edge, bench).collect()}
    assert got == {(1, 1), (6, 1), (7, None), (None, None)}
    left = decontaminate.decontaminate(edge, bench)
    assert left.columns == edge.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 2, 3, 4, 5, 8]
    assert decontaminate.overlaps(empty, bench).count() == 0
    assert decontaminate.decontaminate(edge, bench.limit(0)).count() == edge.count()


def test_short_items_take_out_only_texts_equal_to_them(spark):
    bench = spark.createDataFrame([(1, "yes"), (2, "forty two"), (3, "the cat sat on the mat")], "item_id long, text string")
    docs = [(1, "he said yes to that"), (2, "YES"), (3, "forty two sheep"), (4, " forty\ntwo "), (5, "no"),
            (6, "so the cat sat on the mat yes")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(df, bench).collect()) == [1, 3, 5]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(df, bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (4, 2), (6, 1), (6, 3)}
