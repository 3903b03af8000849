"""Importance resampling, token counts and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from tidemark.llm import importance, ranked_search, token_counts
from tidemark.llm.words import words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, words int, score long, term string"


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.choice([0, 1, 5, 30, 200])
        rows.append((rng.randrange(10 * n) if i % 7 else i, " ".join(f"W{int(rng.paretovariate(0.6)) % 400}" for _ in range(size)) + rng.choice(["", ".", " Ünï-cödé", "\n\n"])))
    rows += [(3, None), (None, "w1 w2 w3 w1"), (5, ""), (7, "w1 w2"), (7, "w1 w2"), (None, None), (9, "w1 " * 30_000), (11, "hot " * 25), (12, "hot " * 25)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], DOCS).repartition(3)


def test_words_like_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(128), rng.randrange(0x250), 0x4E2D, 0x1F600])) for _ in range(40))
        assert [w.decode() for w in words_of(text.encode())] == words(text)
    assert words_of(None) == words_of(b"") == []


def ranking(docs, items, k):
    bags = [(d, Counter(words(t))) for d, t in docs]
    bags = [(d, c) for d, c in bags if c]
    n, total = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in bags:
            m = 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(words(text)) if c[t])
            if s > 0:
                found.append((-s, 1 << 62 if d is None else d))
        out += [(item, r + 1, None if d == 1 << 62 else d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize(("seed", "k", "shard"), [(1, 50, 65_536), (2, 3, 7), (3, 1, 40)])
def test_ranking_like_brute_force(spark, monkeypatch, seed, k, shard):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard)
    docs = corpus(seed, 120)
    items = [(i, t) for i, (_, t) in enumerate(corpus(seed + 10, 12))] + [(100, None), (101, "nowhere"), (102, "HOT w1"), (102, "w2"), (None, "w3")]
    found = ranked_search.rank_documents(frame(spark, docs), spark.createDataFrame([(i, t, 0, 0, "") for i, t in items], DOCS.replace("doc_id", "item_id")), k)
    order = lambda rows: sorted(rows, key=repr)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(map(tuple, found.collect())) == order(ranking(docs, items, k))


def test_ranking_in_blocks_and_over_all_terms(spark):
    docs = corpus(4, 60)
    items = [(i, t) for i, (_, t) in enumerate(corpus(5, 9))]
    queries = ranked_search.C.materialise(ranked_search.query_terms(spark.createDataFrame(items, "item_id long, text string")), "q")
    index = ranked_search.build(frame(spark, docs))
    want = sorted(ranking(docs, items, 5), key=repr)
    assert sorted(map(tuple, ranked_search.search(index, queries, 5, block_items=2).collect()), key=repr) == want
    narrow = ranked_search.build(frame(spark, docs), queries.selectExpr("explode(terms) term"), max_terms=3)
    assert narrow.terms.count() == index.terms.count()


def test_ranking_of_empty_tables(spark):
    none, some = frame(spark, []).limit(0), frame(spark, [(1, "a b")])
    asked = some.withColumnRenamed("doc_id", "item_id")
    assert ranked_search.rank_documents(none, asked).count() == 0 == ranked_search.rank_documents(some, asked.limit(0)).count()


def test_search_stops_and_completes(monkeypatch):
    """With rare and frequent terms a search stops before it has read all groups, and its result is exact."""
    rng, completed = np.random.default_rng(1), []
    real = ranked_search.Shard._complete
    monkeypatch.setattr(ranked_search.Shard, "_complete", lambda self, sums, near, impact, *rest: (completed.append(len(impact)), real(self, sums, near, impact, *rest))[1])
    n = 4000
    lens = rng.integers(20, 400, n)
    m = ranked_search.length_factors(lens, n, int(lens.sum()))
    held = [np.sort(rng.choice(n, size, replace=False)) for size in (40, 300, 2500, 3900)]
    tf = rng.integers(1, 9, sum(map(len, held)))
    dfs, at = np.array(list(map(len, held))), np.concatenate(held).astype(np.int32)
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in dfs]
    groups, impacts, ends, order = ranked_search.order_by_impact(dfs, at, tf, m)
    ids = rng.permutation(n).astype(np.int64)
    shard = ranked_search.Shard(ids.tobytes(), [b"a", b"b", b"c", b"d"], groups.astype(np.int64).tobytes(), impacts.astype(np.int64).tobytes(), ends.astype(np.int64).tobytes(), order.astype(np.int32).tobytes())
    sums = np.zeros(n, np.int64)
    np.add.at(sums, at, np.repeat(weights, dfs) * ((10**9 * tf) // (1000 * tf + 20 * m[at])))
    for k in (1, 10, 50, 5000):
        docs, scores = shard.search(list(zip([b"a", b"b", b"c", b"d", b"e"], [*weights, 9], strict=True)), k, first=64)
        best = np.lexsort((ids, -sums))
        best = best[sums[best] > 0][:k]
        assert docs.tolist() == ids[best].tolist() and scores.tolist() == sums[best].tolist()
    assert len(completed) >= 2 and max(completed) > 0


def resampled(docs, target, n, buckets, percent, least, seed):
    def grams(text):
        w = words(text)
        return Counter(" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1))

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    bags = [(d, len(words(t)), grams(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, b in bags:
        for g, c in b.items():
            s[bucket(g)] += c
    for _, text in target:
        for g, c in grams(text).items():
            t[bucket(g)] += c
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + float(buckets)) / ((s[b] + 1.0) * (t.total() + float(buckets)))))
    rows = []
    for d, size, b in bags:
        weight = sum(gain(bucket(g)) * c for g, c in b.items()) // b.total() if b else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, size, b.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], 1 << 62 if r[0] is None else r[0]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("n", "buckets", "percent", "least", "portion"), [(1, 10_000, 10, 20, 1_000_000), (1, 50, 60, 0, 40), (3, 97, 35, 2, 300)])
def test_resampling_like_brute_force(spark, n, buckets, percent, least, portion):
    docs, target = corpus(6, 90), [*corpus(7, 8), (1, None), (2, "hot hot")]
    found = importance.resample(frame(spark, docs), spark.createDataFrame(target, "item_id long, text string"), n=n, buckets=buckets, percent=percent, min_words=least, seed=7, portion_words=portion)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == resampled(docs, target, n, buckets, percent, least, 7)


def test_resampling_of_empty_tables(spark):
    some, none = frame(spark, [(1, "a b " * 20), (2, None)]), frame(spark, []).limit(0)
    target = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert importance.resample(none, target).count() == 0
    rows = importance.resample(some, target.limit(0), percent=100).collect()
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in rows) == [(1, 40, 1), (2, 0, None)]


def tokens(name, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path(name))
    return [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = ["the ", "Hello", "'s", "  \n\t", "<|endoftext|>", "<|endof", "text|>", "İ", "ΟΔΟΣ", "é", "́", "각", "각", "中文", "12345", "!?", "ﬁ", "a" * 40, " ", " ", "😀", "क़", "ñ", "'", "'l", "l "]
    return ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 40, 300]))) for _ in range(n)]


@pytest.mark.parametrize(("name", "piece", "overlap"), [("word_bpe_49k.json", 60, 20), ("word_bpe_49k.json", 200, 40), ("byte_bpe_50k.json", 90, 30)])
def test_counts_like_the_library(spark, name, piece, overlap):
    import public_tokenizers

    texts = [*odd_texts(3, 60), None, "", " " * 500, "x" * 700, "<|endoftext|>" * 40, "e" + "́" * 300, "word " * 5000]
    docs = frame(spark, [(i % 50 if i % 9 else None, t) for i, t in enumerate(texts)])
    found = token_counts.count_tokens(docs, vocabulary=public_tokenizers.path(name), piece_chars=piece, overlap=overlap)
    want = sorted((i % 50 if i % 9 else -1, len((t or "").encode()), n) for i, (t, n) in enumerate(zip(texts, tokens(name, texts), strict=True)))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()) == want
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_pieces_cover_texts_and_seams_are_needed(spark):
    text = "".join(map(chr, range(97, 122))) * 30
    for stride, overlap in ((50, 10), (50, 50), (1000, 10)):
        parts = list(token_counts.cut(text, stride, overlap))
        assert [p[1] for p in parts] == [False] * (len(parts) - 1) + [True]
        assert "".join(p[:stride] if not last else p for _, last, p in parts) == text
        assert all(a[2][stride:] == b[2][:overlap] for a, b in pairwise(parts))
    # a word longer than the overlap has no boundary in it, so overlaps are widened
    row = spark.createDataFrame([(1, "ab cd " * 20 + "z" * 400 + " end" * 30)], "row long, text string")
    config = spark.sparkContext.broadcast(open(token_counts.C.data_file(None, token_counts.VOCABULARY), encoding="utf-8").read())
    assert token_counts._seams(row, config, 64, 16).first().n_tokens is None
    assert token_counts._seams(row, config, 1024, 512).first().n_tokens == tokens(token_counts.VOCABULARY, [row.first().text])[0]


def test_only_provable_tokenizers_are_cut():
    import json

    import public_tokenizers

    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        config = json.load(open(public_tokenizers.path(name), encoding="utf-8"))
        assert token_counts.provable(config)
        assert not token_counts.provable(config | {"pre_tokenizer": {"type": "Whitespace"}})
        assert not token_counts.provable(config | {"normalizer": {"type": "Strip", "strip_left": True, "strip_right": True}})
