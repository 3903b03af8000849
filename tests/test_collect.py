import json

import pytest
from tidemark import cli
from tidemark.plans import analysis
from tidemark.sources import collect, feeds, tables

ATOM = '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>One</a:title><a:link href="https://x.org/1"/><a:summary>About &amp; more</a:summary></a:entry></a:feed>'
BOTH = "<rss><item><title>Item</title><link>https://x.org/2</link></item><entry><title>Entry</title><link>https://x.org/3</link></entry></rss>"
RDF = '<r:RDF xmlns:r="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"><item><title>Two</title><link>https://x.org/4</link></item></r:RDF>'


def test_feeds_by_namespace(spark):
    df = spark.createDataFrame([("a", ATOM, "2026-01-01"), ("b", BOTH, "2026-01-01"), ("c", RDF, "2026-01-01"), ("d", None, None), ("e", "<html>", None)], "source_id string, payload string, observed_at string")
    got = sorted((r.source_id, r.link, r.title, r.body) for r in feeds.feed_entries(df).collect())
    assert got == [("a", "https://x.org/1", "One", "About & more"), ("b", "https://x.org/2", "Item", ""), ("c", "https://x.org/4", "Two", "")]


def test_failing_sources_keep_no_other_from_landing(spark, monkeypatch):
    monkeypatch.setenv("TIDEMARK_AGENT", "me@x.org")

    def fetch(url, agent, body):
        if "down" in url:
            raise OSError("refused")
        if "json" in url:
            return json.dumps({"status": "ok" if "good" in url else "BAD", "message": "no key", "rows": [{"t": f"{url} {agent} {(body or b'').decode()}", "u": "https://x.org/j"}]})
        return BOTH

    rows = [
        {"source_id": "feed", "kind": "rss", "endpoint": "https://x.org/feed"}, {"source_id": "down", "kind": "rss", "endpoint": "https://down.org"}, {"source_id": "off", "kind": "rss", "endpoint": "x", "enabled": False},
        {"source_id": "unset", "kind": "rss", "endpoint": "https://x.org/${TIDEMARK_NOT_SET}"}, {"source_id": "bad", "kind": "json", "endpoint": "https://x.org/json/bad"},
        {"source_id": "good", "kind": "json", "endpoint": "https://x.org/json/good?from={{start_date}}", "user_agent": "bot ${TIDEMARK_AGENT}", "body": '{"to": "{{end_date}}"}', "lookback_days": 3},
    ]
    mapping = {"items_path": "rows", "title": "t", "url": "u", "status_path": "status", "status_ok": ["ok"]}
    got = collect.fetch_sources(collect.sources_table(spark, rows), "2026-02-10T00:00:00Z", fetch=fetch, parallel=2)
    found, failed = collect.entries(got, {"good": mapping, "bad": mapping})
    assert {r.source_id: r.title for r in found.collect()} == {"feed": "Item", "good": 'https://x.org/json/good?from=2026-02-07 bot me@x.org {"to": "2026-02-10"}'}
    assert {r.source_id: r.error for r in failed.collect()} == {"down": "refused", "unset": "not set: TIDEMARK_NOT_SET", "bad": "BAD: no key"}
    ranged = collect.fetch_sources(collect.sources_table(spark, rows[-1:]), "2026-02-10T00:00:00Z", start="2026-01-01", end="2026-01-31", fetch=fetch).first()
    assert "2026-01-01" in ranged.payload and "2026-01-31" in ranged.payload


def test_drafts_that_name_tickers_are_refused():
    plain = {"nodes": [{"name": "ticker tape maker"}], "edges": [], "links": [{"from": "a", "to": "b"}]}
    assert analysis.draft_map(plain, "m")[0][0]["name"] == "ticker tape maker" and len(analysis.draft_links(plain, "c")) == 1
    for text in ("$AAPL", "NASDAQ: X", "証券コード 1"):
        for draft in (lambda a: analysis.draft_map(a, "m"), lambda a: analysis.draft_links(a, "c")):
            with pytest.raises(ValueError, match="tickers"):
                draft({**plain, "nodes": [{"name": text}]})


def test_upsert_publishes_whole_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "id string, v int, x string")
    from pyspark.sql import functions as F

    tables.upsert(make([("a", 1, "old"), ("b", 1, "b")]), path, "id", F.col("v"))
    tables.upsert(make([("a", 2, "new"), ("b", 0, "late"), ("c", 1, "c")]), path, "id", F.col("v"))
    want = {"a": "new", "b": "b", "c": "c"}
    assert {r.id: r.x for r in tables.latest(spark, path).collect()} == want
    # a writer that dies before it publishes changes nothing
    make([("a", 9, "half")]).write.parquet(f"{path}/data-dead")
    assert {r.id: r.x for r in tables.latest(spark, path).collect()} == want


def test_init(tmp_path, capsys):
    a = type("A", (), {"data": str(tmp_path / "d"), "check": True})
    with pytest.raises(SystemExit):
        cli.do_init(None, a)
    a.check = False
    cli.do_init(None, a)
    a.check = True
    cli.do_init(None, a)
    assert "missing raw" in capsys.readouterr().out
