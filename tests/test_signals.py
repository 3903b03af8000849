from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from tidemark.functions import time as T
from tidemark.operators import signals

AS_OF = "2026-08-13T23:59:59Z"
WINDOW = T.Window.ending(T.instant(AS_OF).date(), 7, 4)
TOPIC = signals.Topic("Power Grid", ("power grid",), "sec_power_grid")
SCHEMA = "event_id string, observed_at timestamp, event_at timestamp, title string, summary string, signal_types array<string>, regions array<string>, sector_links array<struct<sector_id:string>>, sources array<struct<source_id:string>>"


def stamp(text):
    return T.instant(text).replace(tzinfo=None)


def event(n, day, kind, source, observed="2026-01-01T00:00:00Z", linked=True, title="x"):
    return (f"e{n}", stamp(observed), stamp(f"{day}T00:00:00Z"), title, "", [kind], ["JP"], [("sec_power_grid",)] if linked else [], [(source,)])


def run(spark, rows, spans=None, topics=(TOPIC,)):
    return signals.windows(spark.createDataFrame(rows, SCHEMA), list(topics), WINDOW, AS_OF, spans)


def rising(kinds, sources, observed="2026-01-01T00:00:00Z"):
    rows, n = [], 0
    for kind in kinds:
        rows.append(event(n := n + 1, "2026-07-20", kind, sources[0], observed))
        for i in range(2):
            rows.append(event(n := n + 1, "2026-08-10", kind, sources[i % len(sources)], observed))
    return rows


def test_co_occurrence_fires(spark):
    r = run(spark, rising(["paper", "patent"], ["src_a", "src_b"])).first()
    assert (r.distinct_signal_types, r.distinct_sources, r.baseline_covered, r.threshold_met) == (2, 2, True, True)
    assert r.window_id == "sig_power_grid_20260813"


def test_one_type_or_one_source_does_not_fire(spark):
    assert not run(spark, rising(["paper"], ["src_a", "src_b"])).first().threshold_met
    r = run(spark, rising(["paper", "patent"], ["src_a"])).first()
    assert r.distinct_sources == 1 and not r.threshold_met


def test_cold_start_is_held(spark):
    r = run(spark, rising(["paper", "patent"], ["src_a", "src_b"], "2026-08-13T00:00:00Z")).first()
    assert (r.distinct_signal_types, r.baseline_covered, r.threshold_met) == (2, False, False)


def test_spans_extend_coverage_only_without_a_gap(spark):
    rows = rising(["paper", "patent"], ["src_a", "src_b"], "2026-08-13T00:00:00Z")
    spans = lambda to: spark.createDataFrame([("src_a", "2026-07-01", to), ("src_b", "2026-07-01", to)], "source_id string, f string, t string").select("source_id", F.to_date("f").alias("from_day"), F.to_date("t").alias("to_day"))
    assert run(spark, rows, spans("2026-08-12")).first().threshold_met
    assert not run(spark, rows, spans("2026-08-01")).first().baseline_covered


def test_baseline_is_scaled_and_zero_baseline_has_no_ratio(spark):
    counts = run(spark, [event(i, "2026-07-20", "paper", "src_a") for i in range(4)]).first().counts[0]
    assert (counts["count"], counts.baseline_count) == (0, 1.0)
    counts = run(spark, [event(1, "2026-08-10", "paper", "src_a")]).first().counts[0]
    assert counts.baseline_count == 0 and counts.delta_ratio is None


def test_keywords_match_without_a_link_and_topics_without_events_stay(spark):
    rows = [event(i, "2026-08-10", "paper", "src_a", linked=False, title="New power grids planned") for i in range(2)]
    found = {r.topic: r for r in run(spark, rows, topics=[TOPIC, signals.Topic("新概念", ("nothing",), None, True)]).collect()}
    assert found["power_grid"].distinct_signal_types == 1
    assert len(found) == 2 and all(not r.threshold_met for r in found.values())


def test_window_refuses_times_without_zone():
    with pytest.raises(ValueError):
        T.instant("2026-08-13T00:00:00")
    assert T.instant(datetime(2026, 1, 1, tzinfo=timezone.utc)).year == 2026
    assert (WINDOW.days, WINDOW.baseline_days, WINDOW.scale) == (7, 28, 0.25)
