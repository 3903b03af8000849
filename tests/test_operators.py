import argparse
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tidemark import cli, schemas
from tidemark.functions import time as T
from tidemark.operators import backtest, dedup, evidence, graphs, rules
from tidemark.plans import analysis, normalize, report, review
from tidemark.sources import backfill, feeds, series, tables


def docs(spark, rows):
    """rows: raw_id, source_id, title, body, url, day."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "raw_id string, source_id string, title string, body string, url string, d string, i int")
    at = F.to_timestamp("d")
    return dedup.keyed(df.withColumns({"event_at": at, "observed_at": F.timestamp_seconds(at.cast("long") + F.col("i"))}), F.lit("p"))


LONG = "the ministry announced a large new programme to build transmission lines and substations across several regions by next year"
OTHER = "the ministry announced a large programme to build transmission lines and substations across several regions before next year ends"


@pytest.mark.parametrize(
    ("second", "merged", "method"),
    [
        (("b", "s2", "u", OTHER, "https://x/2", "2026-08-13"), True, "token_similarity"), (("b", "s2", "u", OTHER, "https://x/2", "2026-08-14"), False, "event_key"), (("b", "s2", "t", LONG, "https://x/2", "2026-08-13"), True, "content_hash"),
        (("b", "s1", "t", LONG, "https://x/2", "2026-08-13"), False, "event_key"), (("b", "s1", "v", "edited words", "https://x/1", "2026-08-13"), True, "canonical_url"), (("b", "s1", "u", OTHER, "https://x/2", "2026-08-13"), False, "event_key"),
        (("b", "s2", "T", "quite different words about fish", "https://x/2", "2026-08-13"), True, "event_key"),
    ],
)
def test_clusters(spark, second, merged, method):
    got = {r.raw_id: r for r in dedup.assign_clusters(docs(spark, [("a", "s1", "t", LONG, "https://x/1", "2026-08-13"), second])).collect()}
    assert got["a"].is_cluster_primary and got["b"].is_cluster_primary is not merged
    assert (got["b"].cluster_id == got["a"].cluster_id) is merged and got["b"].method == method
    assert got["b"].duplicate_of == ("a" if merged else None)


def test_similar_pairs_are_those_of_brute_force(spark):
    rng = random.Random(5)
    base = [rng.sample(range(60), rng.randrange(1, 25)) for _ in range(12)]
    sets = [sorted({str(x if rng.random() > 0.15 else rng.randrange(60)) for x in b}) for b in base for _ in range(4)]
    df = spark.createDataFrame([(f"r{i:02}", s) for i, s in enumerate(sets)], "raw_id string, tokens array<string>").withColumn("event_date", F.lit("d"))
    got = {(r.a, r.b) for r in dedup.similar_pairs(df).collect()}
    want = {(f"r{i:02}", f"r{j:02}") for i in range(len(sets)) for j in range(i + 1, len(sets)) if dedup._similar(set(sets[i]), set(sets[j])) >= 0.6}
    assert got == want


def test_evidence_is_diversified_only_beyond_the_limit(spark):
    rows = [(f"e{i}", "A", T.instant("2026-08-10T00:00:00Z").replace(tzinfo=None), [("s1" if i < 8 else f"s{i}",)]) for i in range(12)]
    df = spark.createDataFrame(rows, "event_id string, max_reliability string, event_at timestamp, sources array<struct<source_id:string>>")
    order = [F.col("event_id")]
    assert evidence.diversify(df, order, 20).count() == 12
    kept = [r.event_id for r in evidence.diversify(df, order, 6).orderBy("position").collect()]
    assert len(kept) == 6 and sum(int(e[1:]) < 8 for e in kept) == 4


def test_evidence_positions_against_a_plain_ranking(spark):
    rng = random.Random(3)
    rows = [(f"e{i:03}", rng.choice("AAB"), T.instant(f"2026-08-{rng.randrange(10, 13)}T00:00:00Z").replace(tzinfo=None), [(rng.choice(["hot", "hot", "hot", "a", "b", None]),)], rng.choice(["k1", "k2", None])) for i in range(150)]
    df = spark.createDataFrame(rows, "event_id string, max_reliability string, event_at timestamp, sources array<struct<source_id:string>>, k string")
    order = [F.col("max_reliability"), F.col("event_id")]
    n = {k: sum(r[4] == k for r in rows) for k in ("k1", "k2", None)}
    for keys, limits in (((), (7, 40, 149, 150, 151)), (("k",), (1, 7, n["k1"] - 1, n["k1"], n["k1"] + 1))):
        for limit in limits:
            want = set()
            for k in n if keys else [0]:
                group = sorted((r for r in rows if not keys or r[4] == k), key=lambda r: (r[1], r[0]))
                seen, late = {}, []
                for r in group:
                    at = (r[3][0][0], r[2])
                    seen[at] = seen.get(at, 0) + 1
                    late.append(len(group) > limit and seen[at] > 4)
                ranked = [r for flag in (False, True) for r, x in zip(group, late, strict=True) if x == flag]
                want |= {(r[0], p) for p, r in enumerate(ranked[:limit], 1)}
            assert {(r.event_id, r.position) for r in evidence.diversify(df, order, limit, keys, 4).collect()} == want, (keys, limit)


def test_rules(spark):
    wave = spark.createDataFrame([("c", 1, "m", "observed", "low", None, None), ("c", 2, "m", "inferred", "high", "f", ["e"]), ("c", 4, "", "inferred", "high", None, None)], "chain_id string, wave int, mechanism string, claim_type string, causal_confidence string, falsifier string, evidence array<string>")
    assert sorted((r.rule, r.detail) for r in rules.waves(wave).collect()) == [("inferred_without_evidence", "wave 4"), ("inferred_without_falsifier", "wave 4"), ("no_mechanism", "wave 4"), ("surer_than_the_wave_before", "2")]
    profile = "sector_id string, scenarios array<struct<scenario:string,falsifier:string,projections:array<struct<year:int,amount:double>>>>, growth_probability double, growth_magnitude double, score double, internal_only boolean, consensus string, independent string, newest_evidence_at timestamp, as_of timestamp, tam double, sam double, som double, market_evidence array<string>"
    good = [(s, "f", [(2030, a)]) for s, a in (("bear", 1.0), ("base", 2.0), ("bull", 3.0))]
    t = T.instant("2026-08-13T00:00:00Z").replace(tzinfo=None)
    rows = [("ok", good, 0.5, 0.5, 1.0, True, "c", "i", t, t, 0.0, None, None, None), ("bad", [("bear", None, [(2030, 5.0)]), ("base", "f", [(2030, 2.0)])], None, 0.5, 1.0, None, "c", "", t, t, 10.0, None, None, None)]
    found = rules.sectors(spark.createDataFrame(rows, profile)).collect()
    assert {r.key for r in found} == {"bad"}
    assert {r.rule for r in found} == {"scenarios", "no_falsifier", "growth", "score_not_internal", "views", "tam_without_evidence", "bear_above_base"}
    ids = spark.createDataFrame([("evt_20260813_0123456789", "A"), ("evt_1", "E")], "event_id string, max_reliability string")
    assert {(r.key, r.rule) for r in schemas.ill_formed(ids, "event_id").collect()} == {("evt_1", "event_id_pattern"), ("evt_1", "max_reliability_domain")}


def test_report_shape(spark):
    rows = [("r", n, k, "x", False, False) for n, k in schemas.fixed.SECTIONS]
    schema = "report_id string, no int, section string, body string, contains_ticker_recommendation boolean, contains_ranking boolean"
    assert rules.reports(spark.createDataFrame(rows, schema)).count() == 0
    assert {r.rule for r in rules.reports(spark.createDataFrame(rows[:-1], schema)).collect()} == {"section_count", "section_numbers"}
    with pytest.raises(report.Prohibited):
        report.guard("buy $AAPL", "x")


def test_report_counts_all_new_concepts(spark):
    events = spark.createDataFrame([], schemas.EVENT + ", quantities array<struct<label:string,unit:string,scale:string,period:string,value:double>>")
    windows = spark.createDataFrame([(f"w{i:02}", f"topic {i}", True, True, True, 3, 3) for i in range(11)], "window_id string, label string, threshold_met boolean, is_new_concept boolean, baseline_covered boolean, distinct_signal_types long, distinct_sources long")
    body = report.build(events, windows, "2026-07-02T00:00:00Z", "2026-07-01")["sections"][8]["body"]
    assert body.split("\n") == ["11 件の新概念候補を検出。", *(f"- topic {i}" for i in range(8))]


def predictions(spark):
    t = T.instant("2026-01-01T00:00:00Z").replace(tzinfo=None)
    return spark.createDataFrame([("grid capacity", t, "2026-06-30", "gw", ">=", 24.0, None, "f"), ("prices", t, "2026-06-30", "eur", "between", 1.0, 2.0, "f")], "statement string, issued_at timestamp, due_date string, metric string, operator string, value double, value_upper double, falsifier string").withColumn("due_date", F.to_date("due_date"))


def test_prediction_loop(spark):
    issued = review.issue(predictions(spark))
    ids = {r.statement: r.prediction_id for r in issued.collect()}
    measured = spark.createDataFrame([(ids["grid capacity"], 24.0, "none", ""), (ids["prices"], None, "data", "")], "prediction_id string, actual double, cause_category string, narrative string")
    none = review.record(issued, measured.limit(0), "2026-07-01T00:00:00Z")
    assert backtest.due(issued, none, "2026-07-01T00:00:00Z").count() == 2 and backtest.due(issued, none, "2026-06-29T23:59:59Z").count() == 0
    results = review.record(issued, measured, "2026-07-01T00:00:00Z")
    assert {r.prediction_id: r.verdict for r in results.collect()} == {ids["grid capacity"]: "hit", ids["prices"]: "unresolvable"}
    a = backtest.accuracy(issued, results, "2026-07-02T00:00:00Z").first()
    assert (a.total, a.hit, a.miss, a.unresolvable, a.pending, a.hit_rate) == (2, 1, 0, 1, 0, 1.0)
    assert backtest.accuracy(issued, results, "2026-06-30T00:00:00Z").first().hit_rate is None
    assert "的中率: 1.0" in review.monthly(issued, results, "2026-07-02T00:00:00Z")
    with pytest.raises(review.Refused):
        review.issue(predictions(spark).withColumn("falsifier", F.lit("")))


def test_review_and_validation_list_everything(spark, tmp_path, capsys):
    many = spark.range(205)
    issued = many.select(F.format_string("prd_%03d", "id").alias("prediction_id"), F.lit("2026-01-01").cast("timestamp").alias("issued_at"), F.lit("2026-06-30").cast("date").alias("due_date"))
    results = many.select(F.format_string("res_%03d", "id").alias("result_id"), F.format_string("old_%03d", "id").alias("prediction_id"), F.lit("2026-01-01").cast("timestamp").alias("evaluated_at"), F.lit("hit").alias("verdict"), F.lit("none").alias("cause_category"), F.struct(F.lit("open").alias("status"), F.format_string("do %03d", "id").alias("action")).alias("improvement"))
    lines = review.monthly(issued, results, "2026-07-02T00:00:00Z").split("\n")
    assert [x for x in lines if "prd_" in x] == [f"- prd_{i:03} 期限 2026-06-30" for i in range(205)]
    assert [x for x in lines if "[open]" in x] == [f"- [open] do {i:03}" for i in range(205)]
    claims = F.array().cast("array<struct<claim_id:string,type:string,basis:array<string>>>").alias("claims")
    many.select(F.format_string("evt_%03d", "id").alias("event_id"), claims, F.array().cast("array<string>").alias("sources"), F.lit("2026-01-01").cast("timestamp").alias("observed_at")).write.parquet(str(tmp_path / "events"))
    with pytest.raises(SystemExit) as stopped:
        cli.do_validate(spark, argparse.Namespace(data=str(tmp_path), as_of="2026-07-02T00:00:00Z"))
    printed = capsys.readouterr().out.split("\n")
    assert stopped.value.code == 1 and [x.split()[0] for x in printed[:205]] == [f"evt_{i:03}" for i in range(205)] and printed[205] == "205 violations"


def test_landing_twice_adds_nothing(spark, tmp_path):
    t = T.instant("2026-08-13T00:00:00Z").replace(tzinfo=None)
    df = spark.createDataFrame([("a", t), ("b", t), ("a", t), ("c", t)], "raw_id string, observed_at timestamp")
    path = str(tmp_path / "raw")
    assert tables.append_absent(df, path, "raw_id", [F.col("observed_at")]) == 3
    assert tables.append_absent(df, path, "raw_id", [F.col("observed_at")]) == 0
    assert tables.read(spark, path, "2026-08-13T00:00:00Z").count() == 3 and tables.read(spark, path, "2026-08-12T23:00:00Z").count() == 0
    tables.archive(df.withColumn("source_id", F.lit("s")), str(tmp_path / "gz"))
    assert tables.read_archive(spark, str(tmp_path / "gz"), "raw_id string, observed_at timestamp").count() == 4


def test_backfill(spark):
    s = spark.createDataFrame([("src_a", 3)], "source_id string, chunk_days int")
    got = [(str(r.start), str(r.end)) for r in backfill.plan(spark, s, 10, "2026-08-14T00:00:00Z").collect()]
    assert got == [("2026-08-05", "2026-08-07"), ("2026-08-08", "2026-08-10"), ("2026-08-11", "2026-08-13"), ("2026-08-14", "2026-08-14")]
    done = spark.createDataFrame([("src_a", a, b, 1, e) for (a, b), e in zip(got, [None, None, "x", None], strict=True)], "source_id string, s string, t string, n int, error string").select("source_id", F.to_date("s").alias("start"), F.to_date("t").alias("end"), "n", "error")
    assert [str(x) for x in backfill.covered(done).first()[1:3]] == ["2026-08-05", "2026-08-10"]


def test_series(spark):
    def payload(text):
        return spark.createDataFrame([("src_a", text)], "source_id string, payload string").withColumn("observed_at", T.at("2026-08-13T00:00:00Z"))

    listed = '{"label":"L","id":["geo","time"],"size":[1,2],"value":[7,null],"dimension":{"geo":{"category":{"index":["JP"]}},"time":{"category":{"index":["2024","2025"]}}}}'
    p = series.jsonstat(payload(listed), {}, {"unit": "u"})
    assert [(r.period, r.value, r.label) for r in p.collect()] == [("2024", 7.0, "L（JP）")]
    raw = series.point_documents(p, {"sectors": ["sec_x"]}, "https://s.org/{geo}/{period}").first()
    assert raw.url == "https://s.org/JP/2024" and raw.sector_ids == ["sec_x"] and raw.quantities[0].value == 7.0
    revised = series.point_documents(p.withColumn("value", F.lit(8.0)), {}, "https://s.org/{geo}/{period}").first()
    assert revised.raw_id != raw.raw_id and revised.canonical_url == raw.canonical_url
    failed = payload('{"status":"REQUEST_NOT_PROCESSED","message":"limit"}')
    with pytest.raises(Exception, match="REQUEST_NOT_PROCESSED"):
        series.records(failed, {"status_path": "status", "status_ok": ["OK"]}, {}).collect()
    assert [r[0] for r in failed.select(feeds.problem(F.lit("<!DOCTYPE html><p>"))).collect()] == ["html"]
    assert [r[0] for r in spark.createDataFrame([('{"a":[1,2,3]}',)], "j string").select(feeds.dig(F.col("j"), "a.-1")).collect()] == ["3"]


def test_normalising(spark):
    t = "2026-08-13T01:00:00Z"
    rows = spark.createDataFrame([("src_a", "https://x.org/1", "New fab announced", LONG), ("src_b", "https://x.org/2", "New fab announced", LONG), ("src_z", "https://x.org/3", "unknown", "")], "source_id string, link string, title string, body string")
    raw = feeds.raw_documents(rows.withColumns({"observed_at": T.at(t), "published_at": F.lit(None).cast("timestamp")}))
    reg = tables.registry(spark, [{"source_id": s, "name": "Federal Office", "kind": "rss", "tier": "tier1", "reliability": "A", "country": "JP", "categories": ["macro"]} for s in ("src_a", "src_b")])
    made = normalize.events(raw, reg)
    got = made.collect()
    assert len(got) == 2 and sorted(r.is_cluster_primary for r in got) == [False, True] and len({r.cluster_id for r in got}) == 1
    assert all(r.signal_types == ["new_facility"] and r.category == "capex" and r.actors[0].kind == "government" and r.claims[0].confidence == "high" for r in got)
    assert tuple(normalize.progress(raw, made, reg).first()) == (3, 1, 1, 1)
    assert rules.events(made, t).count() == 0


def test_generated_answers_are_grounded(spark):
    rows = [("e1", "A", T.instant("2026-08-10T00:00:00Z").replace(tzinfo=None), "t", "s", "report", 1, None)]
    bundle = spark.createDataFrame(rows, "event_id string, max_reliability string, event_at timestamp, title string, summary string, kind string, position int, quantities array<struct<label:string,unit:string,scale:string,period:string,value:double>>").withColumn("observed_at", F.col("event_at"))
    answer = '```json\n{"independent": "i", "phase": "early", "scenarios": [{"basis": ["e1", "e9"]}]}\n```'
    made = analysis.draft_profile(bundle, "sec_x", "X", "2026-08-13T00:00:00Z", lambda prompt, schema: answer)
    assert made["problems"] == ["$.scenarios[0].basis[1]: e9"] and made["reliability_counts"]["A"] == 1
    links = analysis.draft_links({"links": [{"wave": 1, "from": "a", "to": "b"}]}, "c")
    assert links[0]["source"] == "a"
    nodes, edges = analysis.draft_map({"nodes": [{"name": "Fab One"}], "edges": [{"from": "Fab One", "to": "Grid"}]}, "m")
    n = spark.createDataFrame([("m", "Fab One", "nd_1")], "map_id string, name string, node_id string")
    e = spark.createDataFrame([(x["map_id"], x["source_name"], x["target_name"]) for x in edges], "map_id string, source_name string, target_name string")
    assert graphs.resolve_names(e, n).select("source", "target").first() == ("nd_1", "nd_grid") and len(nodes) == 1


def test_stream_lands_once(spark, tmp_path):
    from tidemark.streaming import increment

    source = tmp_path / "in"
    t = T.instant("2026-08-13T00:00:00Z").replace(tzinfo=None)
    schema = "raw_id string, observed_at timestamp"
    for _ in range(2):
        spark.createDataFrame([("a", t), ("b", t)], schema).write.mode("append").parquet(str(source))
        increment.land(spark.readStream.schema(schema).parquet(str(source)), str(tmp_path / "raw"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_few_clusters_are_compared_and_none_is_missed():
    """A document meets few clusters besides those that are similar, also after clusters have changed and with tokens that the day's frequencies lack."""
    rng = random.Random(11)
    draw = lambda: {f"w{int(rng.random() ** 2 * 400)}" for _ in range(60)}
    sets = [draw() for _ in range(600)]
    sets += [set(list(rng.choice(sets))[: rng.randrange(3, 40)]) | {f"new{i}"} for i in range(300)] + [set(), {"w1"}, {"w1", "w2"}]
    index = dedup._Index(Counter(t for s in sets[:600] for t in s))
    held, compared, similar = {}, 0, 0
    for i, s in enumerate(sets):
        near = index.near(s)
        want = [c for c, x in held.items() if dedup._similar(s, x) >= 0.6]
        assert near == sorted(near) and set(want) <= set(near)
        compared, similar = compared + len(near), similar + len(want)
        c = i if i % 3 else i // 2
        held[c] = s | (held.get(c, set()) if i % 2 else set())
        index.put(c, held[c])
    # sharing one of the rarest tokens was enough before: that were most clusters
    assert similar and compared < 0.2 * len(sets) * len(held) / 2


def test_the_most_alike_cluster_of_another_source_is_that_of_brute_force(monkeypatch):
    """Short, long and very long documents, ties, lists that become rows, clusters that grow out of the short ones and are written anew."""
    monkeypatch.setattr(dedup, "LISTED", 8)
    rng = random.Random(5)
    draw = lambda n: {f"w{int(rng.random() ** 3 * 1500)}" for _ in range(n)}
    sets = [draw(rng.choice((2, 6, 9, 20, 60, 100, 300, 900))) for _ in range(500)]
    sets += [set(rng.sample(sorted(s), max(1, len(s) * 4 // 5))) | draw(3) for s in rng.choices(sets, k=500)] + [set()]
    rng.shuffle(sets)
    index, held, sources, found = dedup._Index(Counter(t for s in sets[:800] for t in s)), {}, {}, 0
    for i, s in enumerate(sets):
        source = f"s{rng.randrange(3)}"
        alike = {c: dedup._similar(s, x) for c, x in held.items() if not sources[c] <= {source}}
        want = max((c for c in alike if alike[c] >= 0.6), key=lambda c: (alike[c], -c), default=None)
        assert index.best(s, source) == (want, alike.get(want, 0.0))
        found += want is not None
        c = i if want is None else want
        held[c] = set(sorted(held.get(c, set()) | s)[:400])
        sources[c] = sources.get(c, set()) | {source}
        index.put(c, held[c])
        index.sources(c, sources[c])
    assert 300 < found < 900 and index.long.any.rows and index.short.any.rows


def test_latest_points_of_a_long_series_meet_in_no_task(spark):
    rows = [(f"e{i}", i % 50, [("a" if i % 3 else None, "u", None if i % 5 == 0 else f"2024-0{1 + i % 4}", float(i))]) for i in range(1, 400)]
    rows += [("z1", 1, [("only", "u", None, 7.0)]), ("z0", 0, [("only", "u", None, 8.0)])]
    events = spark.createDataFrame(rows, "event_id string, at int, quantities array<struct<label string, unit string, period string, value double>>").withColumn("observed_at", F.timestamp_seconds("at")).drop("at")
    found = evidence.latest_points(events)
    flat = [(e, at, q) for e, at, qs in rows for q in qs]
    want = []
    for label in (None, "a", "only"):
        mine = [(q[2] or "", at, e, q[3]) for e, at, q in flat if q[0] == label]
        last = max(m[0] for m in mine)
        want.append((label, "u", last or None, min(m[1:] for m in mine if m[0] == last)[2], len(mine)))
    assert [tuple(r) for r in found.collect()] == want
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.label for r in evidence.latest_points(events, 2).collect()] == [None, "a"]


def test_references_are_the_same_in_portions(spark, monkeypatch):
    """Each portion is a walk of its own, so what a task reads of it is bounded."""
    docs = spark.createDataFrame([(str(i), '{"basis":["e%d",{"event_id":"f%d"}],"x":{"y":[{"event_ids":["g%d"]}]}}' % (i, i, i)) for i in range(12)] + [("12", "no JSON"), ("13", None), (None, '{"event_id":"h"}')], "k string, t string")
    rows = lambda df: sorted((r.k or "", r.path, r.event_id) for r in df.collect())
    whole = rows(evidence.cited(docs, "k", "t"))
    monkeypatch.setattr(evidence, "PORTION", 300)
    parts = evidence.cited(docs, "k", "t")
    assert rows(parts) == whole and len(whole) == 37
    assert parts._jdf.queryExecution().analyzed().toString().count("UnionLoop ") + parts._jdf.queryExecution().analyzed().toString().count("WithCTE") >= 3
