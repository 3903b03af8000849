"""Sources as a data source, observation times, statistics and the past."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from tidemark import cli
from tidemark.operators import signals
from tidemark.sources import backfill, collect, connector, feeds, series, tables

RSS = "<rss><item><title>%s</title><link>https://x.org/%s</link></item></rss>"
SPEC = {"format": "records", "endpoint_template": "https://s.org/{code}?from={start_year}", "points_path": "1", "label": "name", "key_fields": {"geo": "g"}, "updated_path": "0.updated", "status_path": "0.status", "status_ok": ["ok"]}
SOURCES = [
    {"source_id": "feed", "kind": "rss", "endpoint": "https://x.org/feed"}, {"source_id": "html", "kind": "rss", "endpoint": "https://x.org/html"}, {"source_id": "odd", "kind": "gopher", "endpoint": "x"},
    {"source_id": "api", "kind": "json_api", "endpoint": "https://x.org/api", "mapping": {"items_path": "a.-1.rows", "url_template": "https://y.org/{id}", "title": ["none", "t"], "body": ["t", "id"], "published_at": "when"}},
    {"source_id": "bare", "kind": "json_api", "endpoint": "https://x.org/api"}, {"source_id": "list", "kind": "json_api", "endpoint": "https://x.org/none", "mapping": {}},
    {"source_id": "stat", "kind": "json_series", "series_request": SPEC, "series": [{"code": "good", "unit": "t", "sectors": ["sec_a"]}, {"code": "text"}, {"code": "late"}, {"x": 1}]},
    {"source_id": "gone", "kind": "json_series", "series_request": SPEC, "series": [{"code": c} for c in ("text", "late", "down", "text2")]},
    {"source_id": "form", "kind": "json_series", "series_request": {"format": "csv"}, "endpoint": "https://s.org/good", "series": [{"code": "q"}]},
]


def answer(url, agent, body):
    if "down" in url:
        raise OSError("refused")
    if "/api" in url:
        return json.dumps({"a": [{}, {"rows": [{"id": 7, "t": " T ", "when": "2026-01-02"}, {"t": "no id"}]}]})
    if "good" in url:
        return json.dumps([{"status": "ok", "updated": "2026-03-01"}, [{"date": "2025", "value": "1,000", "name": "N", "g": "JP"}, {"date": "2026", "value": None}]])
    if "late" in url:
        return json.dumps([{"status": "WAIT"}, []])
    return {"https://x.org/feed": RSS % ("F", "f"), "https://x.org/html": "<html></html>", "https://x.org/none": "[]"}.get(url, "plain text")


ERRORS = {
    "html": "html", "odd": "no collector for kind 'gopher'; there are: atom, json, json_api, json_series, rss", "bare": "no mapping: the source doesn't say how it is read", "list": "empty",
    "gone": "down: refused; late: WAIT; text: not JSON", "form": "q: unknown format of series: csv",
}


def test_data_source_lands_all_kinds(spark):
    connector.register(spark, answer)
    before = dt.datetime.now()
    got = spark.read.format("tidemark").option("sources", json.dumps(SOURCES)).option("as_of", "2020-01-01T00:00:00Z").load().persist()
    assert got.rdd.getNumPartitions() == len(SOURCES)
    assert all(r.observed_at >= before.replace(microsecond=0) for r in got.collect())
    raw, failed = collect.documents(got)
    rows = {r.source_id: r for r in raw.collect()}
    assert set(rows) == {"feed", "api", "stat"}
    assert (rows["api"].url, rows["api"].title, rows["api"].body, str(rows["api"].published_at)) == ("https://y.org/7", "T", "T\n\n7", "2026-01-02 00:00:00")
    stat = rows["stat"]
    assert (stat.title, stat.quantities[0].value, stat.sector_ids, str(stat.published_at), stat.url) == ("N（JP） 2025: 1,000 t", 1000.0, ["sec_a"], "2026-03-01 00:00:00", "https://s.org/good?from=2019")
    assert "取得元: https://s.org/good?from=2019" in stat.body
    errors = {}
    for r in failed.collect():
        errors.setdefault(r.source_id, []).append(r.error)
    assert {k: v for k, v in errors.items() if k != "stat"} == {k: [v] for k, v in ERRORS.items()}
    assert sorted(errors["stat"]) == ["WAIT", "no value for: code", "not JSON"]
    got.unpersist()
    assert spark.read.format("tidemark").option("sources", "[]").load().count() == 0


def test_stream_polls_once_an_interval(spark, tmp_path):
    connector.register(spark, answer)
    for _ in range(2):
        stream = spark.readStream.format("tidemark").option("sources", json.dumps(SOURCES[:1])).option("interval_seconds", 10**6).load()
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema(collect.PAYLOAD).parquet(str(tmp_path / "out")).count() == 1


def test_a_replay_never_sees_a_later_fetch(spark, tmp_path, capsys):
    data = tmp_path / "d"
    (data / "raw").mkdir(parents=True)
    known = [{**s, "name": s["source_id"], "tier": "tier1", "reliability": "A", "poll_interval_minutes": 1440} for s in SOURCES]
    (data / "sources.json").write_text(json.dumps(known))
    args = lambda *more: cli.parse(["collect", "--data", str(data), "--as-of", "2020-01-01T00:00:00Z", *more])
    assert cli.do_collect(spark, args("--dry-run"), fetch=answer) == 3 and not any((data / "raw").iterdir())
    assert cli.do_collect(spark, args(), fetch=answer) == 3
    assert tables.read(spark, str(data / "raw"), "2020-06-01T00:00:00Z").count() == 0
    assert tables.read(spark, str(data / "raw"), "2999-01-01T00:00:00Z").count() == 3
    # polled a moment ago: only those that failed are asked again
    capsys.readouterr()
    assert cli.do_collect(spark, args(), fetch=answer) == 0
    assert "3 sources are not due" in capsys.readouterr().out
    assert cli.do_collect(spark, args("--source", "feed"), fetch=answer) == 0
    assert "not due" not in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.do_collect(spark, args("--tier", "tier4"), fetch=answer)


def past(source_id="src_a", **more):
    return {"source_id": source_id, "kind": "rss", "endpoint": "https://x.org/now", "backfill": {"endpoint_template": "https://x.org/{start_date}_{end_date}", "chunk_days": 1, **more}}


class Days:
    """Answers a day a request; counts what it was asked in a file, as tasks do the asking."""

    def __init__(self, log, empty=(), failing=()):
        self.log, self.empty, self.failing = str(log), set(empty), set(failing)

    def __call__(self, url, agent, body):
        day = url.rsplit("/", 1)[1].split("_")[0]
        with open(self.log, "a") as f:
            f.write(url + "\n")
        if day in self.failing:
            raise OSError("HTTP 500")
        return "<rss></rss>" if day in self.empty else RSS % (day, url.rsplit("/", 1)[1])


def asked(log):
    return sorted(x.rsplit("/", 1)[1] for x in log.read_text().split()) if log.exists() else []


def test_backfill_is_resumed_and_covers_the_prefix_without_errors(spark, tmp_path):
    root, log = str(tmp_path / "root"), tmp_path / "log"
    run = lambda fetch, **k: {(r.source_id, str(r.start)): (r.n, r.error) for r in backfill.run(spark, [past(), past("src_b", chunk_days=7), {"source_id": "src_c", "kind": "rss", "endpoint": "x"}], root, 10, "2026-08-14T00:00:00Z", fetch=fetch, delay_seconds=0, **k).collect()}
    spans = lambda: {r.source_id: (str(r.from_day), str(r.to_day)) for r in tables.latest(spark, f"{root}/backfill/spans").collect()}
    first = run(Days(log, empty={"2026-08-08", "2026-08-09"}, failing={"2026-08-10"}))
    assert len(first) == 12 and len(asked(log)) == 12
    assert first["src_a", "2026-08-08"] == (0, None) and first["src_a", "2026-08-10"] == (0, "HTTP 500") and first["src_a", "2026-08-11"] == (1, None)
    assert spans() == {"src_a": ("2026-08-05", "2026-08-09"), "src_b": ("2026-08-05", "2026-08-14")}
    assert spark.read.parquet(f"{root}/raw").count() == 9
    log.unlink()
    again = run(Days(log))
    assert asked(log) == ["2026-08-10_2026-08-10"] and again["src_a", "2026-08-10"] == (1, None)
    assert spans()["src_a"] == ("2026-08-05", "2026-08-14") and spark.read.parquet(f"{root}/raw").count() == 10
    log.unlink()
    assert len(run(Days(log))) == 12 and asked(log) == []
    # what was taken in was seen today, whatever day it tells of
    assert tables.read(spark, f"{root}/raw", "2026-08-20T00:00:00Z").count() == spark.read.parquet(f"{root}/raw").filter(F.col("observed_at") <= F.lit("2026-08-20T00:00:00Z").cast("timestamp")).count()
    dry = {(r.source_id, str(r.start)): r.n for r in backfill.run(spark, [past("src_d")], root, 3, "2026-08-14T00:00:00Z", fetch=Days(log), delay_seconds=0, dry_run=True).collect()}
    assert len(dry) == 3 and "src_d" not in spans()
    assert signals  # the spans are what observation_coverage takes


def test_a_cube_is_parsed_once_a_payload(spark):
    """What a cube says of its dimensions isn't read again for each of its values; lists, maps and missing captions come out alike."""
    cube = {"label": "Output", "id": ["siec", "time"], "size": [2, 2], "dimension": {"siec": {"category": {"index": ["A", "B"], "label": {"A": "Gas"}}}, "time": {"category": {"index": {"2025": 1, "2024": 0}}}}}
    rows = [("src_map", json.dumps(cube | {"value": {"0": 1, "3": "2,000"}})), ("src_list", json.dumps(cube | {"value": [1, None, None, 2000]})), ("src_odd", json.dumps([cube])), ("src_none", json.dumps(cube | {"value": [], "size": [2]}))]
    found = series.jsonstat(spark.createDataFrame(rows, "source_id string, payload string").withColumn("observed_at", F.current_timestamp()), {}, {"unit": "TJ"})
    points = [("2024", 1.0, "Output（Gas）", "TJ", {"siec": "A"}), ("2025", 2000.0, "Output（B）", "TJ", {"siec": "B"})]
    got = sorted(((r.source_id, r.period, r.value, r.label, r.unit, r["keys"]) for r in found.collect()), key=lambda r: r[:2])
    assert got == [(s, *p) for s in ("src_list", "src_map") for p in points]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("StructField(category") == 1


def test_cells_of_odata_are_found_once_an_entry(spark):
    """The first cell of a name counts; a missing column and one without text give no point, nor do entries without a period."""
    row = "<entry><d:NEW_DATE>2026-01-0%dT00:00:00</d:NEW_DATE><d:A>%s</d:A><d:A>9</d:A><d:B m:type='x'>%s</d:B></entry>"
    feed = "<feed>" + row % (1, "1,000", "") + row % (2, " 2 ", "3\n") + "<entry><d:A>5</d:A></entry></feed>"
    rows = spark.createDataFrame([("src_a", feed)], "source_id string, payload string").withColumn("observed_at", F.current_timestamp())
    found = series.odata(rows, {}, {"label": "Yield", "unit": "%", "fields": {"a": "A", "b": "B", "c": "C"}})
    assert sorted((r.period, r.value, r.label, r["keys"]["tenor"]) for r in found.collect()) == [("2026-01-01", 1000.0, "Yield a", "a"), ("2026-01-02", 2.0, "Yield a", "a"), ("2026-01-02", 3.0, "Yield b", "b")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position") == 2 and plan.count("regexp_extract_all") == 3


def test_tags_of_feeds_are_read_once_an_entry(spark):
    """The first tag with text counts, CDATA isn't unescaped before its markup goes, a link may be an attribute or the guid; entries lack neither title nor link."""
    item = "<item>%s</item>"
    feed = "<rss>" + "".join(item % x for x in (
        "<title>A &amp;amp; b</title><link> </link><guid>http://x.org/g</guid><description></description><content:encoded><![CDATA[<p>one &lt;two</p>]]></content:encoded><pubDate>Mon, 5 Jan 2026 10:00:00 GMT</pubDate>",
        "<title>B</title><link rel='self' href='http://x.org/self'/><link href='http://x.org/?a=1&amp;b=2'/><published>2026-01-06T00:00:00Z</published><updated>5 Jan 2026 11:00 +0100</updated>",
        "<title>C</title><guid>urn:c</guid>", "<title> </title><link>http://x.org/d</link>", "<title>E</title><link>http://x.org/e</link><dc:date>5 Jan 2026 11:00 +0100</dc:date>",
    )) + "</rss>"
    rows = spark.createDataFrame([("src_a", feed)], "source_id string, payload string").withColumn("observed_at", F.current_timestamp())
    found = feeds.feed_entries(rows)
    got = sorted((r.title, r.link, r.body, f"{r.published_at:%d %H}") for r in found.select("title", "link", "body", "published_at").collect())
    assert got == [("A & b", "http://x.org/g", "one <two", "05 10"), ("B", "http://x.org/?a=1&b=2", "", "06 00"), ("E", "http://x.org/e", "", "05 10")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("<title") == 1


def test_entries_of_feeds_pass_two_python_nodes(spark):
    """Three nodes stood above one another, each with a worker of its own in every task."""
    item = "<item>{}<title>{}</title><description>{}</description></item>"
    items = [
        ("<link>https://x.org/1?a=1&amp;b=2</link>", "A &amp;amp; &lt;b&gt;B&lt;/b&gt;", "<![CDATA[<i>c</i> &amp;lt; d]]>"), ('<link rel="alternate" href="https://x.org/2?a=&lt;b&amp;c"/>', "plain", "a < b > c"),
        ("<link>https://x.org/3</link>", "<![CDATA[ R&D ]]>", "&nbsp;x&nbsp;"), ("<link>https://x.org/4</link>", "<![CDATA[]]>t", "<![CDATA[e &lt;g&gt; f]]>"),
    ]
    rows = spark.createDataFrame([("s", "<rss>" + "".join(item.format(*i) for i in items) + "</rss>", None)], "source_id string, payload string, observed_at timestamp")
    found = feeds.feed_entries(rows)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") <= 2
    assert {(r.link, r.title, r.body) for r in found.collect()} == {
        ("https://x.org/1?a=1&b=2", "A &  B", "c  &lt; d"), ("https://x.org/3", "R&D", "x"), ("https://x.org/4", "t", "e <g> f"), ("https://x.org/2?a=<b&c", "plain", "a   c"),
    }
