import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tidemark.llm import exact_dedup, line_dedup, mixing

BLANK = r"[\x20\x09-\x0D]"


def documents(rng, n):
    lines = ["", "short", "A common line of text", " a common LINE of text\t", "Ünïcode Zeile mit Text", "ünïcode Zeile mit Text", "x" * 9, "y" * 10, "  spaced   out  line ", *(f"line number {i} of many" for i in range(30))]
    return [(i, None if rng.random() < 0.05 else "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 12)))) for i in rng.sample(range(10 * n), n)]


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


@pytest.mark.parametrize(("batches", "fanout"), [(1, 3), (5, 2)])
def test_line_dedup_like_brute_force(spark, batches, fanout):
    docs = documents(random.Random(batches), 60)
    docs += [(docs[0][0], docs[0][1]), (docs[1][0], "A common line of text\nline number 1 of many")]  # repeated ids
    owner = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= 10:
                owner[key_of(line)] = min(i, owner.get(key_of(line), i))
    want = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 10 or owner[key_of(x)] == i]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n_dropped int")
    got = [tuple(r) for r in line_dedup.dedup_lines(df, batches=batches, fanout=fanout, buckets=3).collect()]
    assert sorted(got) == sorted(want)


def test_line_dedup_of_empty_and_null(spark):
    schema = "doc_id long, text string"
    assert line_dedup.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    got = line_dedup.dedup_lines(spark.createDataFrame([(None, "a line that repeats"), (3, "a line that repeats\n"), (4, None)], schema)).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.text) for r in got) == [(0, 1, 1, ""), (3, 2, 0, "a line that repeats\n"), (4, 1, 0, "")]


@pytest.mark.parametrize("bits", [256, 8])
def test_exact_dedup_like_brute_force(spark, bits):
    rng = random.Random(bits)
    texts = [f"{a}{s}{b}" for a in ("one", "two", "three") for b in ("x", "y z") for s in (" ", "  ", "\t\n", " ")] + [None, "", " ", "\n"]
    rows = [(i, rng.choice(texts)) for i in rng.sample(range(1000), 80)] + [(5000, "once")] * 2
    groups = defaultdict(list)
    norm = lambda t: re.sub(f"{BLANK}+", " ", t or "")
    for i, t in rows:
        groups[norm(t)].append(i)
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, keep_id string")
    got = exact_dedup.dedup_exact(df, digest_bits=bits, batches=3, fanout=2, segment_rows=16).collect()
    assert len(got) == len(rows)
    for r in got:
        t = next(t for t, ids in groups.items() if r.doc_id in ids)
        assert (r.keep_id, r.group_size) == (min(groups[t]), len(groups[t])) and r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert sum(r.kept for r in got) == len(groups) and all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id != 5000)


def test_drop_copies_keeps_columns_and_one_row(spark):
    schema = "doc_id long, text string, keep_id string"
    df = spark.createDataFrame([(2, "a b", "p"), (1, "a  b", "q"), (1, "a  b", "q"), (None, "a b", "r"), (None, "z", None), (7, None, "s"), (8, "", "t")], schema)
    got = exact_dedup.drop_copies(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.keep_id) for r in got.collect()) == [(0, None), (1, "q"), (7, "s")]
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, target = share * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in full]
        rest = left - sum(cap * sizes[s] for s in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        full |= over


def test_targets_like_rounds_of_resharing(spark):
    rng = random.Random(1)
    for n in (1, 2, 7, 20):
        sizes = {(None if i == n - 1 and n > 2 else f"s{i}"): rng.choice([0, 1, 10, 1000, 12345]) for i in range(n)}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        want = targets_by_rounds(sizes)
        for r in mixing.source_targets(df).collect():
            assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, f"s{i % 3}" if i % 50 else None, " ".join(["w"] * rng.randrange(0, 60)) if i % 17 else None, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size string")
    plan = {r.doc_id: r for r in mixing.plan_mix(df).collect()}
    assert len(plan) == 3000 and all(r.size == len((t or "").split()) and 0 <= r.taken <= 2 * r.size for (i, _, t, _) in rows if (r := plan[i]))
    taken, target = defaultdict(int), {}
    for i, s, _, _ in rows:
        taken[s] += plan[i].taken
        target[s] = plan[i].target
    assert all(abs(taken[s] - target[s]) < 0.15 * target[s] for s in taken)
    again = {r.doc_id: r.taken for r in mixing.plan_mix(df.repartition(7)).collect()}
    assert again == {i: r.taken for i, r in plan.items()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    n = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(n.get(i, 0) == r.copies for i, r in plan.items())
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.plan_mix(df.limit(0)).count() == 0


def test_native_operators_have_no_python_in_their_plans(spark):
    df = spark.createDataFrame([(1, "s", "a b"), (2, "t", "a b c")], "doc_id long, source string, text string")
    for out in (mixing.plan_mix(df), mixing.mix(df), line_dedup.dedup_lines(df)):
        assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
    assert F is not None
