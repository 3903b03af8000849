import random

from pyspark.sql import functions as F

from tidemark.operators import dedup, pairs


def test_similar_pairs_of_many_blocks_and_rounds_are_those_of_brute_force(spark, monkeypatch):
    """Copies, sets within others, words that most have, and several days."""
    monkeypatch.setattr(pairs, "BLOCK", (150, 150))
    monkeypatch.setattr(pairs, "PORTION", 40)
    monkeypatch.setattr(pairs, "ROUND", 30)
    rng = random.Random(8)
    base = [rng.sample(range(90), rng.randrange(1, 40)) for _ in range(14)]
    sets = [sorted({str(x if rng.random() > 0.05 else rng.randrange(200)) for x in b} | {"the"}) for b in base for _ in range(4)]
    sets += [sets[3]] * 5 + [["the"]] * 3 + [sorted(set(sets[5]) | set(sets[9])), []]
    rows = [(f"d{i % 2}", f"r{i:03}", s) for i, s in enumerate(sets)] + [(None, "n", sets[3])]
    df = spark.createDataFrame(rows, "event_date string, raw_id string, tokens array<string>")
    for least in (0.6, 0.9):
        got = {(r.event_date, r.a, r.b, r.both) for r in dedup.similar_pairs(df, least).collect()}
        day = lambda d: [r for r in rows if r[0] == d]
        want = {(d, a, b, len(set(s) & set(t))) for d in ("d0", "d1") for _, a, s in day(d) for _, b, t in day(d) if a < b and dedup._similar(set(s), set(t)) >= least}
        assert got == want and len(want) > 20


def test_similar_pairs_that_share_one_rare_word_are_no_candidates(spark, monkeypatch):
    """The list of likely pairs does not hold them, however many there are."""
    seen, kept = {}, pairs.shared.kept

    def noted(df, tag, **options):
        table = kept(df, tag, **options)
        seen[tag] = table.count()
        return table

    monkeypatch.setattr(pairs.shared, "kept", noted)
    tokens = F.concat(F.array(F.concat(F.lit("g"), F.col("id") % 5)), F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: (i * 1000 + F.col("id") % 100 * (i % 2)).cast("string")))
    df = spark.range(200).select(F.lit("d").alias("event_date"), F.concat(F.lit("r"), "id").alias("raw_id"), tokens.alias("tokens"))
    got = dedup.similar_pairs(df, 0.9).count()
    assert got == 100 and seen["token-sets"] == 200 and seen["likely-pairs"] <= 100
