import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tidemark.llm import bit_sliced, jaccard_join
from tidemark.llm.components import components


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(rng, groups, size, edits, vocabulary=300):
    rows, passage = [], " ".join(f"p{i}" for i in range(60))
    for _ in range(groups):
        base = [f"v{int(rng.paretovariate(0.5)) % vocabulary}" for _ in range(rng.choice(size))]
        for _ in range(rng.choice([1, 2, 9])):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                if w:
                    w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(w) + (" " + passage if rng.random() < 0.2 else ""))
    rows += ["", None, " \n", "one", "One", "two words", "a b c d", "A B C D", "a b c d e"]
    ids = rng.sample(range(10 * len(rows)), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("seed", "size", "edits", "k", "num"), [(1, [3, 5, 8, 11, 14, 17], 2, 4, 85), (2, [30, 80, 200], 6, 5, 80), (3, [9, 40], 3, 4, 85)])
def test_components_like_brute_force(spark, seed, size, edits, k, num):
    rows = corpus(random.Random(seed), 45, size, edits)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n long")
    got = jaccard_join.jaccard_components(df, words=k, num=num, den=100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, k, num, 100)
    assert Counter(r.component_id for r in got if r.kept) == Counter({r.component_id: 1 for r in got})
    kept = jaccard_join.drop_near_copies(df, words=k, num=num, den=100)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.component_id for r in got}


def test_large_clusters_go_through_blocks(spark, monkeypatch):
    """With tiny blocks and everything hot, results stay the same."""
    monkeypatch.setattr(jaccard_join, "CELL", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(9)
        base = [f"v{i}" for i in range(60)]
        rows = []
        for i in range(60):
            w = list(base)
            for _ in range(i % 7):
                w[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
            rows.append((1000 - i, " ".join(w)))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = jaccard_join.jaccard_components(df, words=4, num=85, den=100).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4, 85, 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def of_sets(sets):
    """Texts of one-word shingles, their nodes, and the bound on each two texts' overlap."""
    texts = [" ".join(s) for s in sets]
    found = [x for _, x, _ in jaccard_join.shingle_sets(texts, 1, jaccard_join.Hashes())]
    classes = jaccard_join.Classes([jaccard_join.classes_of(x) for x in found])
    return texts, [jaccard_join.node_of(x) for x in found], lambda i, j: int(classes.most_overlap(i, np.array([j]))[0])


def test_every_likely_pair_of_a_large_cluster_counts(spark, monkeypatch):
    """a and b are alike and meet in lists of three only; c and d, first in b's likely pairs, are not alike with it."""
    monkeypatch.setattr(jaccard_join, "CELL", 3)
    for seed in range(10000):
        w = [f"s{seed}w{i}" for i in range(100)]
        lacking = {"b": (0, 0), "a": (0, 11), "c": (11, 23), "d": (23, 35)}
        sets = [[*w[:x], *w[y:], *(f"s{seed}{name}{i}" for i in range(y - x))] for name, (x, y) in lacking.items()]
        texts, (b, a, c, d), bound = of_sets(sets)
        if max(c, d) < a < b and min(bound(0, j) for j in (1, 2, 3)) >= 89:
            break
    rows = list(enumerate(texts))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=1, num=80, den=100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 1, 80, 100) == [(0, 100, 0), (1, 100, 0), (2, 100, 2), (3, 100, 3)]


def test_salted_lists_of_three_sets(spark):
    """Two sets alike meet only in hot lists, in different salts; the third set there, the hub, is too large for both."""
    for seed in range(10000):
        w = [f"s{seed}w{i}" for i in range(190)]
        sets = [w, *([*w[:90], *(f"s{seed}{name}{i}" for i in range(10))] for name in "yz")]
        texts, (hub, y, z), _ = of_sets(sets)
        if hub < min(y, z) and len({x % jaccard_join.SALTS for x in (hub, y, z)}) == 3:
            break
    rows = list(enumerate([texts[0]] * 60 + texts[1:]))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=1, num=80, den=100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 1, 80, 100)
    assert {r.component_id for r in got if r.doc_id >= 60} == {60}


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_copies_that_make_shingles_hot(spark, seed):
    """Three texts, y and z alike and x with neither, in many copies: every shingle is hot though its list holds three sets."""
    rng, rows = random.Random(seed), []
    for f in range(40):
        w = [f"f{f}w{i}" for i in range(rng.choice([40, 60, 90]))]
        y = [*w, *(f"f{f}y{i}" for i in range(3))]
        z = list(y)
        z[rng.randrange(len(z))] = f"f{f}z"
        x = [*w[: len(w) * 2 // 3], *(f"f{f}x{i}" for i in range(len(w) // 2))]
        rows += [" ".join(t) for t in (x, y, z) for _ in range(60 if f % 2 else 2)]
    ids = rng.sample(range(10 * len(rows)), len(rows))
    rows = list(zip(ids, rows, strict=True))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=1, num=85, den=100).collect()
    # copies are one set: brute force over distinct texts gives the least id of each, then of each component
    least = {}
    for i, t in rows:
        least[t] = min(i, least.get(t, i))
    of = {i: c for i, _, c in brute([(i, t) for t, i in least.items()], 1, 85, 100)}
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, of[least[t]]) for i, t in rows)


def test_large_and_small_vectors(spark):
    """Vectors beyond 64-bit scores, like those with infinities, take no part; those within are exact."""
    rows = [(0, [1e18, 0.5]), (20, [0.5, -0.25]), (1, [3e5, 1.0]), (2, [float("inf"), 0.0]), (3, [1e308, 1e308]), (4, [-0.001, 0.0]), (40, [2e7, -2e7])]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in bit_sliced.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    part = {20: (32, -16), 1: (19200000, 64), 4: (-1, 0), 40: (1280000000, -1280000000)}
    for q in (20, 40):
        want = sorted(((-(a * part[q][0] + b * part[q][1]), i) for i, (a, b) in part.items() if i != q))
        assert [got[q, n + 1] for n in range(3)] == [(i, -s) for s, i in want]
    assert {q for q, _ in got} == {20, 40}


def test_rule_sizes_and_boundary():
    rule = jaccard_join.Rule(85, 100)
    for n in range(1, 40):
        for m in range(1, 40):
            for o in range(1, min(n, m) + 1):
                if 100 * o >= 85 * (n + m - o):
                    assert o >= rule.overlap(n, m) and min(n, m) >= rule.least_size(max(n, m)) and rule.overlap(n, m) in rule.subset_sizes(n)
    assert jaccard_join.choose_boundary({5: (10, 10, 10**6), 12: (10, 10, 0)}, rule) in (5, 6, 7, 8, 9, 10, 11)
    assert jaccard_join.choose_boundary({12: (1000, 2000, 0)}, rule) < 12


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert jaccard_join.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    text = "a b c d e f g h i j"
    got = jaccard_join.jaccard_components(spark.createDataFrame([(None, text), (5, text), (None, "x")], schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 5), (5, 5)]


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 120)] + [(500, 500 + i) for i in range(1, 40)] + [(700, 701), (701, 700), (9, 9)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(121), 0), **dict.fromkeys(range(500, 540), 500), 700: 700, 701: 700}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_few_edges_take_no_rounds_and_of_many_are_the_same(spark, monkeypatch):
    from tidemark.llm import components as module

    tags, kept = [], module.C.materialise
    monkeypatch.setattr(module.C, "materialise", lambda df, tag, **o: (tags.append(tag), kept(df, tag, **o))[1])
    path = [(i, i + 1) for i in range(120)] + [(500, 400), (400, 450), (7, 7), (900, 900)]
    edges = spark.createDataFrame(path, "a long, b long")
    want = {i: 0 for i in range(121)} | {400: 400, 450: 400, 500: 400}
    assert {r.node: r.label for r in components(edges).collect()} == want
    assert not any("star" in t for t in tags)
    monkeypatch.setattr(module, "PORTION", 10)
    assert {r.node: r.label for r in components(edges).collect()} == want
    assert any("star" in t for t in tags)


@pytest.mark.parametrize(("block", "queries"), [(64, 3), (100000, 256), (7, 1)])
def test_top_k_like_brute_force(spark, block, queries):
    rng = np.random.default_rng(block)
    n, dim = 150, 5
    v = np.round(rng.normal(size=(n, dim)) * 0.3, 1).astype(np.float32)  # many ties
    rows = [(i, v[i].tolist(), 0) for i in range(n)]
    rows += [(1000, None, 0), (1020, [None] * dim, 0), (1040, [float("nan")] * dim, 0), (1060, [float("inf")] * dim, 0), (20, v[20].tolist(), 1), (2000, [0.5, 0.5], 0), (2001, [1.0, -1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in bit_sliced.top_k(df, k=20, block_rows=block, query_rows=queries).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    q = np.floor(64 * v.astype(np.float64)).astype(int)
    for i in range(0, n, 20):
        want = sorted(((-int(q[i] @ q[j]), j) for j in range(n) if j != i))[:20]
        assert got[i] == [(j, -s) for s, j in want]
    assert got[2000] == [(2001, 32 * 64 - 32 * 64)] and set(got) == {*range(0, n, 20), 2000}
    assert bit_sliced.top_k(df.limit(0)).count() == 0


def test_texts_longer_than_a_portion(spark):
    """Sets are made of portions of text; a portion's end may fall anywhere."""
    long = " ".join(f"w{i}" for i in range(120_000))
    assert len(long) > jaccard_join.CUT
    rows = [(1, long), (2, "one two three four five"), (3, long.upper()), (4, None)]
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=4, num=85, den=100)
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2), (3, 1), (4, 4)]
