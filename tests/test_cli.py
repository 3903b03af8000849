"""The commands over a folder, from collecting to validating."""

import json

import pytest
from tidemark import cli, config, schemas
from tidemark.sources import collect, tables

RSS = "<rss>{}</rss>"
ITEM = "<item><title>{0}</title><link>https://x.org/{1}</link><description>{2}</description><pubDate>{3}</pubDate></item>"
SOURCES = [
    {"source_id": "src_a", "name": "A", "kind": "rss", "tier": "tier1", "reliability": "A", "endpoint": "https://a.org/feed", "country": "JP", "publisher": "Ministry of A", "categories": ["macro"], "default_signal_types": ["subsidy"], "poll_interval_minutes": 60},
    {"source_id": "src_b", "name": "B", "kind": "rss", "tier": "tier2", "reliability": "B", "endpoint": "https://b.org/feed", "country": "US", "publisher": "B", "categories": ["technology"], "default_signal_types": [], "poll_interval_minutes": 60,
     "backfill": {"endpoint_template": "https://b.org/{start_date}", "chunk_days": 2, "delay_seconds": 0}},
    {"source_id": "src_s", "name": "S", "kind": "json_series", "tier": "tier1", "reliability": "A", "endpoint": "https://s.org/{code}", "country": "JP", "publisher": "S", "categories": ["macro"], "default_signal_types": [], "poll_interval_minutes": 60,
     "series_request": {"format": "records", "points_path": "rows", "point_url_template": "https://s.org/{code}/{period}"}, "series": [{"code": "x", "label": "Output", "unit": "t", "sectors": ["sec_power_grid"]}]},
]


def answer(url, agent, body):
    if "s.org" in url:
        return json.dumps({"rows": [{"date": "2026-01", "value": 5.5}]})
    day = "Thu, 01 Jan 2026 00:00:00 +0000"
    if url.endswith("feed"):
        story = "grid operator to invest $5 billion in new transformers and power lines across the country"
        return RSS.format("".join(ITEM.format(t, f"{url[8]}{i}", story, day) for i, t in enumerate((f"Grid plan {url[8]}", f"Subsidy {url[8]} for chips"))))
    return RSS.format(ITEM.format(f"Past {url[-10:]}", url[-10:], "patent", f"{url[-2:]} Jan 2026 00:00:00 +0000"))


def run(spark, *words, **how):
    a = cli.parse(list(words))
    return a.run(spark, a, **how)


def test_daily_cycle(spark, tmp_path, capsys):
    data = str(tmp_path / "d")
    run(spark, "init", "--data", data)
    (tmp_path / "d" / "sources.json").write_text(json.dumps(SOURCES))
    with pytest.raises(SystemExit) as e:
        run(spark, "daily", "--data", data, fetch=answer)
    out = capsys.readouterr().out
    assert e.value.code == 0 and "5 new documents" in out and "0 violations" in out, out
    events = spark.read.parquet(f"{data}/events")
    assert events.count() == 5 and {r.category for r in events.collect()} >= {"capex"}
    # what was just collected is known at the report's time
    report = json.loads(next((tmp_path / "d" / "reports").glob("rpt_*.json")).read_text())
    assert len(report["sections"]) == 16 and report["as_of"] >= events.agg({"observed_at": "max"}).first()[0].isoformat()
    assert not list((tmp_path / "d" / "reports").glob(".*"))
    run(spark, "backfill", "--data", data, "--days", "4", "--as-of", "2026-01-09T00:00:00Z", "--source", "src_b", "--source", "src_a", fetch=answer)
    out = capsys.readouterr().out
    assert "skipped src_a" in out and "covered src_b 2026-01-06..2026-01-09" in out and "0 pieces failed" in out
    assert spark.read.parquet(f"{data}/raw").count() == 7
    run(spark, "sector", "--data", data, "--list", "--window-days", "40000")
    assert "sec_power_grid A=" in capsys.readouterr().out


def test_backtest_commands(spark, tmp_path, capsys):
    data = str(tmp_path / "d")
    made = [(f"prd_20260101_0000000{i}", "s", "2026-01-01 00:00:00", "2026-02-01", "m", "u", ">=", 10.0, None, "f", "sec_x") for i in range(2)]
    rows = spark.createDataFrame(made, "prediction_id string, statement string, issued_at string, due_date string, metric string, unit string, operator string, value double, value_upper double, falsifier string, sector_id string")
    rows = rows.selectExpr("prediction_id", "statement", "cast(issued_at as timestamp) issued_at", "cast(due_date as date) due_date", "metric", "unit", "operator", "value", "value_upper", "falsifier", "sector_id")
    tables.upsert(rows, f"{data}/predictions", "prediction_id", rows.issued_at)
    at = ("--data", data, "--as-of", "2026-03-01T00:00:00Z")
    run(spark, "backtest", *at)
    assert "2 predictions are due" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        run(spark, "backtest", *at, "--record", made[0][0])
    with pytest.raises(SystemExit):
        run(spark, "backtest", *at, "--record", "prd_20260101_ffffffff", "--cause", "c", "--narrative", "n")
    run(spark, "backtest", *at, "--record", made[0][0], "--actual", "12", "--cause", "demand", "--narrative", "as told")
    assert "hit 12.0" in capsys.readouterr().out
    run(spark, "backtest", *at, "--due", "--summary")
    out = capsys.readouterr().out
    assert "1 predictions are due" in out and "issued 2, resolved 1 (hit 1, miss 0, partial 0), unresolvable 0, pending 1" in out and "hit rate 1.0" in out
    assert schemas.check_rows(tables.latest(spark, f"{data}/results"), "result_id", "result").count() == 0 and schemas.check_rows(tables.latest(spark, f"{data}/predictions"), "prediction_id", "prediction").count() == 0
    assert collect.KINDS


def test_rules_of_a_folder(tmp_path):
    assert config.load(str(tmp_path)) == config.Rules()
    (tmp_path / "rules.json").write_text(json.dumps({"signal_types": {"boats": ["Ship Yard", "Hull"]}, "sectors": [{"sector_id": "sec_sea", "name": "Sea", "keywords": ["Hull"]}]}))
    made = config.load(str(tmp_path))
    assert made == config.Rules({"boats": ("ship yard", "hull")}, (("sec_sea", "Sea", ("hull",)),))
    for bad in ({"x": 1}, {"sectors": [{"sector_id": "sea", "name": "s"}]}, {"sectors": [{"sector_id": "sec_a", "name": "s"}] * 2}):
        with pytest.raises(ValueError, match="rules|sectors"):
            config.parse(json.dumps(bad))


def test_normalizing_and_detecting_by_the_rules_of_a_folder(spark, tmp_path, capsys):
    data = str(tmp_path / "d")
    run(spark, "init", "--data", data)
    (tmp_path / "d" / "sources.json").write_text(json.dumps(SOURCES[:1]))
    (tmp_path / "d" / "rules.json").write_text(json.dumps({"signal_types": {"wires": ["power lines"]}, "sectors": [{"sector_id": "sec_wires", "name": "Wires", "keywords": ["transformers"]}]}))
    run(spark, "collect", "--data", data, fetch=answer)
    run(spark, "normalize", "--data", data)
    events = spark.read.parquet(f"{data}/events").collect()
    assert {tuple(r.signal_types) for r in events} == {("subsidy", "wires")} and {s.sector_id for r in events for s in r.sector_links} == {"sec_wires"}
    run(spark, "detect", "--data", data, "--as-of", "2026-01-02T00:00:00Z", "--show-all")
    assert "Wires: types" in capsys.readouterr().out
