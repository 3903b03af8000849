import argparse
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from tidemark import cli
from tidemark.functions import time as T
from tidemark.operators import evidence
from tidemark.plans import analysis, review
from tidemark.sources import backfill

AS_OF = "2026-08-13T00:00:00Z"
PROFILE = {"sector_id": "sec_power_grid", "name": "Grid", "views": {"independent": {"summary": "tight", "divergence": "earlier"}}}
WAVE = {"trigger": {"description": "load"}, "links": [
    {"wave": 1, "from": "load", "to": "transformers", "mechanism": "m", "claim_type": "inferred", "causal_confidence": "low", "falsifier": "f", "basis": ["e1"]},
    {"wave": 2, "from": "transformers", "to": "steel", "mechanism": "m", "claim_type": "inferred", "causal_confidence": "high", "falsifier": "f", "basis": ["e1", "e9"]},
]}
MAP = {"nodes": [{"name": "Core Steel", "is_bottleneck": True, "trigger_condition": "t", "monetizer_type": ""}, {"name": "Grid", "is_bottleneck": False}], "edges": [{"from": "Core Steel", "to": "Grid"}, {"from": "Core Steel", "to": "Copper"}]}


def bundle_of(spark, n=1):
    at = T.instant("2026-08-10T00:00:00Z").replace(tzinfo=None)
    rows = [(f"e{i + 1}", "A", at, "Title", "report", i + 1) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, max_reliability string, event_at timestamp, title string, kind string, position int")


def test_chain(spark):
    b = bundle_of(spark)
    asked = analysis.chain_prompt(b, PROFILE, AS_OF, "wave")
    assert "- [e1] (A) 2026-08-10 Title" in asked and "tight" in asked and "earlier" in asked
    assert "- none" in analysis.chain_prompt(b.limit(0), PROFILE, AS_OF, "supply_chain")
    with pytest.raises(ValueError, match="no such"):
        analysis.chain_prompt(b, PROFILE, AS_OF, "ranking")
    head, links = analysis.draft_wave(b, PROFILE, AS_OF, lambda p, s: json.dumps(WAVE))
    assert head["chain_id"] == "wav_power_grid" and head["trigger"] == "load" and links.count() == 2
    assert {(r.rule, r.detail) for r in analysis.review_wave(links, b).collect()} == {("surer_than_the_wave_before", "2"), ("not_in_evidence", "e9")}


def test_supply_chain(spark):
    head, nodes, edges = analysis.draft_supply_chain(bundle_of(spark), PROFILE, AS_OF, lambda p, s: json.dumps(MAP))
    assert head["map_id"] == "scm_power_grid" and {r.node_id for r in nodes.collect()} == {"nd_core_steel", "nd_grid"}
    assert {(r.rule, r.detail) for r in analysis.review_supply_chain(nodes, edges).collect()} == {("unknown_to", "nd_copper"), ("no_monetizer", "")}


def test_chain_needs_a_profile(tmp_path):
    with pytest.raises(SystemExit, match="no profile"):
        cli.do_chain(None, argparse.Namespace(data=str(tmp_path), sector="sec_x"))


def test_record_keeps_only_signals_that_could_be_seen(spark):
    at = lambda x: T.instant(x).replace(tzinfo=None)
    p = spark.createDataFrame([("p1", "grid", at("2026-01-01T00:00:00Z"), "2026-06-30", ">=", 24.0, None), ("p2", "late", at("2026-01-01T00:00:00Z"), "2026-06-30", ">=", 1.0, None)], "prediction_id string, statement string, issued_at timestamp, due_date string, operator string, value double, value_upper double").withColumn("due_date", F.to_date("due_date"))
    events = spark.createDataFrame([("e1", at("2025-12-31T00:00:00Z")), ("e2", at("2026-01-02T00:00:00Z")), ("e3", at("2025-11-01T00:00:00Z"))], "event_id string, observed_at timestamp")
    measured = spark.createDataFrame([("p1", 20.0, "partial", "data", "", ["e3", "e2", "e1", "e8"])], "prediction_id string, actual double, given string, cause_category string, narrative string, missed_signals array<string>")
    got = review.record(p, measured, "2026-07-01T00:00:00Z", events)
    r = got.first()
    assert r.missed_signals == ["e3", "e1"] and r.verdict == "partial" and r.error_absolute == -4.0
    with pytest.raises(ValueError, match="events"):
        review.record(p, measured, "2026-07-01T00:00:00Z")
    text = review.monthly(p, got, "2026-07-02T00:00:00Z")
    assert "as_of: 2026-07-02T00:00:00Z" in text and review.WARNING in text and "- p2 期限 2026-06-30: late" in text and text.endswith("(§43)\n\n- 該当なし\n")


def test_review_is_saved(spark, tmp_path):
    p = spark.createDataFrame([], "prediction_id string, statement string, issued_at timestamp, due_date date")
    r = spark.createDataFrame([], "result_id string, prediction_id string, evaluated_at timestamp, verdict string, cause_category string")
    path = review.save_monthly(p, r, "2026-07-02T00:00:00Z", tmp_path / "monthly")
    assert path.name == "review_2026-07.md" and path.read_text(encoding="utf-8") == review.monthly(p, r, "2026-07-02T00:00:00Z") and len(list(path.parent.iterdir())) == 1


def test_backfill_sources():
    by_address = {"source_id": "src_a", "kind": "rss", "endpoint": "x", "backfill": {"kind": "json", "endpoint_template": "https://x.org/?f={start_compact}&t={end_date}"}}
    by_body = {"source_id": "src_b", "kind": "json", "endpoint": "y", "http_method": "post", "backfill": {"chunk_days": 3}}
    feed = {"source_id": "src_c", "kind": "rss", "endpoint": "z", "backfill": {"chunk_days": 1}}
    assert [backfill.supported(s) for s in (by_address, by_body, feed, {"source_id": "d"})] == [True, True, False, False]
    assert backfill.unsupported(["src_c", "src_a", "src_z"], [by_address, by_body, feed]) == ["src_c", "src_z"]
    made = backfill.chunk_source(by_address, dt.date(2026, 1, 2), dt.date(2026, 1, 5))
    assert (made["kind"], made["endpoint"]) == ("json", "https://x.org/?f=20260102&t=2026-01-05") and by_address["endpoint"] == "x"
    assert backfill.chunk_source(by_body, dt.date(2026, 1, 2), dt.date(2026, 1, 5))["date_range"] == {"start": "2026-01-02", "end": "2026-01-05"}


def test_references_in_the_plan_like_those_of_one_answer(spark):
    rng = random.Random(3)

    def made(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["e1", "e2", 3, None, True, [], {}])
        if rng.random() < 0.4:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return {k: made(depth - 1) for k in rng.sample(["event_id", "event_ids", "basis", "x", "y"], rng.randrange(4))}

    answers = [{"r": made(7)} for _ in range(60)] + [{"event_id": "e9"}]
    rows = [(i, json.dumps(a)) for i, a in enumerate(answers)] + [(99, "no json"), (100, None)]
    found = evidence.cited(spark.createDataFrame(rows, "id int, doc string"), "id", "doc")
    assert found.columns == ["id", "path", "event_id"]
    assert sorted(map(tuple, found.collect())) == sorted((i, *r) for i, a in enumerate(answers) for r in analysis.references(a))
