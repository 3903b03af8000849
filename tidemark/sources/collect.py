"""Fetching: requests of sources, sent where the tasks run, each source by itself.

A source is a row of source_id, kind, endpoint, and perhaps user_agent, body and lookback_days; `spec` (JSON) tells how its payload is
read, `series` (a JSON list) names the series of a source of statistics, each a request of its own. Endpoint, agent and body may
hold ${NAME} from the environment, {{start_date}} and {{end_date}} of the range that is asked for, and the endpoint of
a series also {name} from the series and {start_year}, {end_year}, {start_date}, {end_date}.

What goes wrong with a request, be it a kind that nobody knows, a name that isn't set, an address that can't be reached or a payload that tells of a
failure, is its row's error and nobody else's. Rows are stamped with the time at which they were fetched: that, and not the time
that is asked about, is when they were observed.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import feeds, series

Fetch = Callable[[str, str | None, bytes | None], str]
SOURCE = "source_id string, kind string, endpoint string, user_agent string, body string, lookback_days int, spec string, series string, part string, start string, end string, delay_seconds double"
PAYLOAD = "source_id string, kind string, spec string, part string, requested string, payload string, error string, observed_at timestamp"
AGENT = "tidemark/1.0"
#: Kinds of sources, and whether each series is a request of its own.
KINDS = {"rss": False, "atom": False, "json": False, "json_api": False, "json_series": True}
#: The error of a payload that is well-formed and holds nothing.
EMPTY = "empty"


class FetchError(Exception):
    """Why a source gave no payload."""


def expand(text: str, environment: Mapping[str, str]) -> str:
    """text with ${NAME} from the environment; an error that lists all names that aren't set or are empty."""
    missing = sorted({n for n in re.findall(r"\$\{(\w+)\}", text) if not environment.get(n)})
    if missing:
        raise FetchError("not set: " + ", ".join(missing))
    return re.sub(r"\$\{(\w+)\}", lambda m: environment[m.group(1)], text)


def days_of(as_of: dt.date, lookback_days: int | None, start: dt.date | None = None, end: dt.date | None = None, default: int = 7) -> tuple[dt.date, dt.date]:
    """An explicit range, else the days up to as_of, as many as the source says."""
    last = end or as_of
    return start or last - dt.timedelta(days=default if lookback_days is None else lookback_days), last


def dated(text: str, as_of: dt.date, lookback_days: int | None, start: dt.date | None = None, end: dt.date | None = None) -> str:
    """text with its dates, seven days unless the source says otherwise."""
    first, last = days_of(as_of, lookback_days, start, end)
    return text.replace("{{start_date}}", first.isoformat()).replace("{{end_date}}", last.isoformat())


def http_fetch(url: str, agent: str | None, body: bytes | None, timeout: int = 30) -> str:
    """GET, or POST of JSON where there is a body."""
    headers = {"User-Agent": agent or AGENT, "Accept": "*/*"} | ({"Content-Type": "application/json"} if body is not None else {})
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers, data=body), timeout=timeout) as answer:
            return answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        raise FetchError(f"HTTP {e.code}") from e
    except (urllib.error.URLError, TimeoutError, ValueError) as e:
        raise FetchError(f"{type(e).__name__}: {getattr(e, 'reason', e)}") from e


def series_url(endpoint: str, entry: dict, as_of: dt.date, lookback_days: int | None) -> str:
    """A series' address: {name} from the series or the range; a name that is neither is an error."""
    first, last = days_of(as_of, lookback_days, default=365)
    known = {"start_year": first.year, "end_year": last.year, "start_date": first.isoformat(), "end_date": last.isoformat(), **entry}
    unknown = sorted({n for n in re.findall(r"\{(\w+)\}", endpoint) if n not in known})
    if unknown:
        raise FetchError("no value for: " + ", ".join(unknown))
    return re.sub(r"\{(\w+)\}", lambda m: str(known[m.group(1)]), endpoint)


def requests_of(source: dict) -> list[dict]:
    """The parts of a source that are asked for: each series, the piece of time that it names, or the source as a whole."""
    entries = json.loads(source["series"]) if source.get("series") else []
    return [{"part": json.dumps(e, ensure_ascii=False), "entry": e} for e in entries] or [{"part": source.get("part"), "entry": {}}]


def fetch_source(source: dict, as_of: str, fetch: Fetch, environment: Mapping[str, str], start: str | None = None, end: str | None = None) -> Iterator[tuple]:
    """The rows of PAYLOAD of one source, a row a request; failures are rows."""
    day, first, last = (dt.date.fromisoformat(x[:10]) if x else None for x in (as_of, source.get("start") or start, source.get("end") or end))
    kind, spec = source.get("kind"), source.get("spec")
    about = (source.get("source_id"), kind, spec)
    now = lambda: dt.datetime.now(dt.timezone.utc)
    if kind not in KINDS:
        yield (*about, None, None, None, f"no collector for kind {kind!r}; there are: {', '.join(sorted(KINDS))}", now())
        return
    try:
        asked = requests_of(source)
    except ValueError as e:
        yield (*about, None, None, None, f"series: {e}", now())
        return
    for request in asked:
        url = None
        try:
            back = source.get("lookback_days")
            url, agent, body = (expand(x, environment) if x else None for x in (source.get("endpoint"), source.get("user_agent"), source.get("body")))
            if not url:
                raise FetchError("no endpoint")
            if KINDS[kind]:
                url = series_url(url, request["entry"], day, back)
            url, agent, body = (dated(x, day, back, first, last) if x else None for x in (url, agent, body))
            yield (*about, request["part"], url, fetch(url, agent, body.encode() if body else None), None, now())
        except Exception as e:  # a request's failure is data
            yield (*about, request["part"], url, None, str(e) or type(e).__name__, now())


def fetch_sources(sources: DataFrame, as_of: str, *, start: str | None = None, end: str | None = None, fetch: Fetch = http_fetch, parallel: int = 16) -> DataFrame:
    """The payloads of every source (see PAYLOAD), fetched in up to `parallel` tasks; rows of one source follow one another, delay_seconds apart. as_of only bounds what is asked for."""
    environment = dict(os.environ)
    names = [c.split()[0] for c in PAYLOAD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked: str | None = None
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                source = {k: None if v is None or v != v or v == "" else v for k, v in r.items()}
                source["lookback_days"] = None if source["lookback_days"] is None else int(source["lookback_days"])
                if source["source_id"] == asked and source["delay_seconds"]:
                    time.sleep(source["delay_seconds"])
                asked = source["source_id"]
                rows += fetch_source(source, as_of, fetch, environment, start, end)
            yield pd.DataFrame(rows, columns=names)

    asked = sources.select(*[F.col(c) if c in sources.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in SOURCE.split(", "))])
    return asked.repartition(parallel, "source_id").sortWithinPartitions("source_id", "start").mapInPandas(run, PAYLOAD)


def status_error(payload: Column, spec: dict) -> Column:
    """Why a payload's body tells of a failure; null where it doesn't."""
    if not spec.get("status_path") or not spec.get("status_ok"):
        return F.lit(None).cast("string")
    status = F.coalesce(feeds.dig(payload, spec["status_path"]), F.lit(""))
    return F.when(~status.isin(*spec["status_ok"]), F.concat_ws(": ", F.nullif(status, F.lit("")), feeds.dig(payload, spec.get("status_message_path", "message"))))


def split_failures(payloads: DataFrame, spec: dict) -> tuple[DataFrame, DataFrame]:
    """The payloads that are fine, and source_id and error of the others."""
    judged = payloads.withColumn("_why", F.coalesce(F.col("error") if "error" in payloads.columns else F.lit(None).cast("string"), F.when(F.col("payload").isNull(), "no payload"), status_error(F.col("payload"), spec)))
    return judged.filter("_why is null").drop("_why"), judged.filter("_why is not null").select("source_id", F.col("_why").alias("error"))


def _with_specs(payloads: DataFrame, mappings: dict[str, dict]) -> DataFrame:
    """payloads with the columns of PAYLOAD; a mapping stands in for a spec that isn't given."""
    rows = payloads.withColumns({c: F.lit(None).cast(t) for c, t in (x.split() for x in PAYLOAD.split(", ")) if c not in payloads.columns})
    if not mappings:
        return rows
    # a row a source of the registry, which is read from one file
    known = payloads.sparkSession.createDataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in mappings.items()], "source_id string, _spec string")
    return rows.join(F.broadcast(known), "source_id", "left").withColumn("spec", F.coalesce("spec", "_spec")).drop("_spec")


def judge(payloads: DataFrame) -> DataFrame:
    """payloads with what is wrong with each in `error`: the fetch, the body's status, a form that isn't the kind's, or nothing in it ("empty")."""
    kind, payload, spec = F.col("kind"), F.col("payload"), F.col("spec")
    wrong = F.coalesce(
        F.col("error"), F.when(payload.isNull(), "no payload"), F.when(~kind.isin(*KINDS), F.concat(F.lit("no collector for kind "), kind)),
        F.when(kind.isin("rss", "atom"), feeds.problem(payload)), F.when(~kind.isin("rss", "atom") & spec.isNull(), "no mapping: the source doesn't say how it is read"),
        F.when(kind.isin("json", "json_api"), feeds.json_problem(payload, spec)), F.when(kind == "json_series", series.problem(payload, spec, F.col("part"))),
    )
    return payloads.withColumn("error", wrong)


def entries(payloads: DataFrame, mappings: dict[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Entries of all feeds and JSON lists, and source_id and error of the sources that gave none. mappings: specs by source_id, where payloads bring none.

    One plan whatever the number of sources: a JSON list is read by the paths that its row brings. Every row of another kind than statistics (see
    `statistics`) is in one of the two results.
    """
    judged = judge(_with_specs(payloads, mappings or {})).filter(F.col("kind").isNull() | (F.col("kind") != "json_series"))
    good = judged.filter("error is null")
    keep = ["source_id", "part", "requested"]
    found = feeds.feed_entries(good.filter(F.col("kind").isin("rss", "atom")), keep).unionByName(feeds.mapped_entries(good.filter(F.col("kind").isin("json", "json_api")), keep))
    return found, judged.filter("error is not null").select("source_id", "error")


def statistics(payloads: DataFrame, mappings: dict[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw documents of the data points of all series, and source_id, error, whole of what failed.

    A series that fails keeps the others; where all of a source's fail, with no point at all, it is one row, `whole`, of the first three errors.
    """
    judged = judge(_with_specs(payloads, mappings or {}).filter("kind = 'json_series'"))
    good, bad = judged.filter("error is null"), judged.filter("error is not null")
    points = series.points(good)
    alive = points.select("source_id").distinct()
    errors = bad.join(alive.withColumn("_some", F.lit(True)), "source_id", "left")
    named = F.struct(F.col("part"), F.concat_ws(": ", F.coalesce(F.get_json_object("part", "$.code"), F.get_json_object("part", "$.dataset")), "error").alias("why"))
    partly = errors.filter("_some").select("source_id", F.col("error"), F.lit(False).alias("whole"))
    # a source has few series
    wholly = errors.filter("_some is null").groupBy("source_id").agg(F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(named)), 1, 3), lambda x: x["why"]), "; ").alias("error")).withColumn("whole", F.lit(True))
    return series.documents(points), partly.unionByName(wholly)


def documents(payloads: DataFrame, mappings: dict[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw documents of payloads of any kind, and source_id, error, whole of what failed; a source that failed as a whole gave nothing."""
    found, failed = entries(payloads, mappings)
    points, broken = statistics(payloads, mappings)
    return feeds.raw_documents(found).unionByName(points), failed.withColumn("whole", F.lit(True)).unionByName(broken)


def source_row(source: dict) -> dict:
    """A source of the registry as a row of SOURCE: mappings and requests of series become its spec."""
    spec = next((source[k] for k in ("spec", "mapping", "series_request") if source.get(k) is not None), None)
    text = lambda x: x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    endpoint = source.get("endpoint") or (spec.get("endpoint_template") if isinstance(spec, dict) else None)
    return {**source, "endpoint": endpoint, "spec": text(spec), "series": text(source.get("series")), "body": text(source.get("body"))}


def sources_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Sources as a table, those switched off left out."""
    names = [x.split()[0] for x in SOURCE.split(", ")]
    made = [source_row(r) for r in rows if r.get("enabled", True)]
    return spark.createDataFrame([tuple(float(r[n]) if n == "delay_seconds" and r.get(n) is not None else r.get(n) for n in names) for r in made], SOURCE)
