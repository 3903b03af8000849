"""Commands over a data folder: raw, events, windows, predictions and results as tables under it."""

from __future__ import annotations

import argparse
import datetime as dt
import json
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config, fixed, schemas, session
from tidemark.functions import time as T
from tidemark.operators import backtest, evidence, rules, signals
from tidemark.plans import analysis, normalize, report, review
from tidemark.sources import backfill, collect, history, shared, tables


def _registry(spark: SparkSession, root: str):
    return tables.registry(spark, json.loads(Path(root, "sources.json").read_text(encoding="utf-8")), enabled_only=False)


def _write(path: Path, text: str) -> None:
    """A file as a whole or not at all: written beside and renamed."""
    part = path.with_name(f".{path.name}.part")
    part.write_text(text, encoding="utf-8")
    part.replace(path)


def _history(spark: SparkSession, root: str, name: str, key: str | list[str]) -> history.History:
    return history.History(spark, f"{root}/history/{name}", key, buckets=4)


FOLDERS = ("raw", "events", "windows", "predictions", "results", "reports", "analyses")


def do_init(spark: SparkSession, a: argparse.Namespace) -> None:
    """The folders and an empty registry; with --check only tells what isn't there."""
    root = Path(a.data)
    missing = [x for x in FOLDERS if not (root / x).is_dir()] + [x for x in ("sources.json",) if not (root / x).is_file()]
    for x in missing:
        print("missing" if a.check else "made", x)
        if not a.check:
            (root / x).write_text("[]", encoding="utf-8") if x.endswith(".json") else (root / x).mkdir(parents=True)
    if a.check and missing:
        raise SystemExit(1)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _chosen(a: argparse.Namespace) -> list[dict]:
    """The sources of the registry that the flags name; without --all those that are switched on."""
    rows = json.loads(Path(a.data, "sources.json").read_text(encoding="utf-8"))
    named, tiers = getattr(a, "source", None), getattr(a, "tier", None)
    return [{**r, "enabled": True} for r in rows if (getattr(a, "all", False) or r.get("enabled", True)) and (not named or r["source_id"] in named) and (not tiers or r.get("tier") in tiers)]


def _due(spark: SparkSession, sources: list[dict], polls: str, now: str) -> list[dict]:
    """The sources whose interval has passed since they last gave something."""
    if not tables.published(spark, polls):
        return sources
    asked = spark.createDataFrame([(r["source_id"], int(r.get("poll_interval_minutes") or r.get("interval_minutes") or 0)) for r in sources], "source_id string, minutes int")
    # a row a source of the registry
    due = {r.source_id for r in asked.join(tables.latest(spark, polls), "source_id", "left").filter(T.due(F.col("minutes"), F.col("at"), now)).select("source_id").collect()}
    return [r for r in sources if r["source_id"] in due]


def do_collect(spark: SparkSession, a: argparse.Namespace, fetch: collect.Fetch = collect.http_fetch) -> int:
    """Fetches the sources that are due; one that fails is reported and keeps no other from landing. The number of new documents."""
    now, polls = _now(), f"{a.data}/polls"
    sources = _chosen(a)
    if not sources:
        raise SystemExit("no source matches")
    due = sources if a.source or a.force else _due(spark, sources, polls, now)
    if len(due) < len(sources):
        print(len(sources) - len(due), "sources are not due")
    answers = shared.folder(spark, "answers")
    collect.fetch_sources(collect.sources_table(spark, due), a.as_of or now, fetch=fetch).write.parquet(answers)
    found, failed = collect.documents(spark.read.schema(collect.PAYLOAD).parquet(answers))
    wrong = set()
    for r in failed.orderBy("source_id", "error").toLocalIterator():
        print("failed" if r.whole else "failed in part", r.source_id, r.error)
        wrong |= {r.source_id} if r.whole else set()
    if a.dry_run:
        n = found.count()
        print(n, "documents")
        return n
    added = tables.append_absent(found, f"{a.data}/raw", "raw_id", [F.col("observed_at"), F.col("url")])
    fine = [(r["source_id"], now) for r in due if r["source_id"] not in wrong]
    if fine:
        tables.upsert(spark.createDataFrame(fine, "source_id string, at string").withColumn("at", F.col("at").cast("timestamp")), polls, "source_id", F.col("at"))
    print(added, "new documents")
    return added


def do_backfill(spark: SparkSession, a: argparse.Namespace, fetch: collect.Fetch = collect.http_fetch) -> None:
    """Takes in the past of the sources that can be asked for a range of days."""
    a.all = True
    sources = _chosen(a)
    for name in backfill.unsupported(a.source or [], sources):
        print("skipped", name, "can't be asked for a range of days")
    if not any(map(backfill.supported, sources)):
        raise SystemExit("no source can be asked for the past")
    pieces = backfill.run(spark, sources, a.data, a.days, a.as_of or _now(), fetch=fetch, delay_seconds=a.delay, dry_run=a.dry_run)
    failed = 0
    for r in pieces.orderBy("source_id", "start").toLocalIterator():
        print("failed" if r.error else "done", r.source_id, f"{r.start}..{r.end}", r.error or f"{r.n} items")
        failed += r.error is not None
    if not a.dry_run:
        for r in tables.latest(spark, f"{a.data}/backfill/spans").orderBy("source_id").toLocalIterator():
            print("covered", r.source_id, f"{r.from_day}..{r.to_day}")
    print(failed, "pieces failed")


def do_daily(spark: SparkSession, a: argparse.Namespace, fetch: collect.Fetch = collect.http_fetch) -> None:
    """Collects, normalizes, detects, reports and validates, in this order. What is known is settled once collecting is over, so as_of is taken then."""
    defaults = {"limit": None, "rebuild": False, "topic": None, "keywords": None, "window_days": 7, "baseline_multiplier": 4, "dry_run": False, "date": None, "stdout": False, "source": None, "tier": None, "all": False, "force": False, "schemas": True}
    a = argparse.Namespace(**defaults | vars(a))
    if not a.skip_collect:
        do_collect(spark, a, fetch)
    a.as_of = a.as_of or _now()
    for step in (do_normalize, do_detect, do_report, do_validate):
        step(spark, a)


def do_normalize(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = tables._existing(spark, f"{a.data}/raw")
    if raw is None:
        print("nothing has landed")
        return
    done = None if a.rebuild else tables._existing(spark, f"{a.data}/events")
    # a day is clustered as a whole, so days with new rows are redone; which they are is settled before the table they come from is written
    fresh = normalize.pending(raw, done, a.limit)
    days = shared.kept(fresh.select(F.to_date(F.coalesce("published_at", "observed_at")).alias("_d")).distinct(), "days")
    rows = raw.withColumn("_d", F.to_date(F.coalesce("published_at", "observed_at"))).join(tables.small(days), "_d", "left_semi").drop("_d")
    made = normalize.events(rows, _registry(spark, a.data), config.load(a.data)).withColumn("event_day", F.to_date("event_at"))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_day").parquet(f"{a.data}/events")


def do_detect(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.topic and not a.keywords:
        raise SystemExit("a topic needs --keywords")
    events = tables.known(spark.read.parquet(f"{a.data}/events"), a.as_of, primary_only=True)
    topics = [signals.Topic(a.topic, tuple(k.lower() for k in a.keywords), None, True)] if a.topic else signals.watched(config.load(a.data).sectors)
    window = T.Window.ending(T.instant(a.as_of).date(), a.window_days, a.baseline_multiplier)
    found = shared.kept(signals.windows(events, topics, window, a.as_of), "windows")
    if not a.dry_run:
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{a.data}/windows/{window.end}")
    print(f"window {window.start}..{window.end}, baseline {window.baseline_start}..{window.baseline_end}")
    for r in signals.overview(found, getattr(a, "show_all", False)).orderBy("label").collect():  # a row a topic
        print(f"{r.mark or ' '} {r.label}: types {r.distinct_signal_types}, sources {r.distinct_sources}, regions {r.distinct_regions}, score {r.score}: {r.detail or 'nothing'}")
    print(found.filter("threshold_met").count(), "of", len(topics), "topics met the threshold")


def do_report(spark: SparkSession, a: argparse.Namespace) -> None:
    day = a.date or str(T.instant(a.as_of).date())
    # analyses as they stood at as_of, not as they were revised later
    extra = {name: table.read(a.as_of).drop("valid_from", "valid_to") for name, key in (("profiles", "sector_id"), ("links", "chain_id"), ("nodes", "map_id"), ("edges", "map_id")) if (table := _history(spark, a.data, name, key)).manifest()}
    if tables.published(spark, f"{a.data}/predictions"):
        none = spark.createDataFrame([], schemas.RESULT)
        extra |= {"predictions": tables.latest(spark, f"{a.data}/predictions"), "results": tables.latest(spark, f"{a.data}/results") if tables.published(spark, f"{a.data}/results") else none}
    made = report.build(spark.read.parquet(f"{a.data}/events"), spark.read.parquet(f"{a.data}/windows/{day}"), a.as_of, day, extra=extra, watched=config.load(a.data).sectors)
    if a.stdout:
        print(report.markdown(made))
    else:
        out = Path(a.data, "reports")
        out.mkdir(exist_ok=True)
        _write(out / f"{made['report_id']}.json", json.dumps(made, ensure_ascii=False, default=str))
        _write(out / f"{made['report_id']}.md", report.markdown(made))


def do_review(spark: SparkSession, a: argparse.Namespace) -> None:
    made = (tables.latest(spark, f"{a.data}/predictions"), tables.latest(spark, f"{a.data}/results"), a.as_of)
    if a.save:
        print(review.save_monthly(*made, Path(a.data, "reports", "monthly")))
    else:
        for line in review.monthly_lines(*made):
            print(line)


def do_backtest(spark: SparkSession, a: argparse.Namespace) -> None:
    """Predictions that are due (what is shown if nothing is asked), how good they were, or the result of one."""
    as_of = a.as_of or _now()
    predictions = tables.latest(spark, f"{a.data}/predictions")
    results = tables.latest(spark, f"{a.data}/results") if tables.published(spark, f"{a.data}/results") else spark.createDataFrame([], schemas.RESULT)
    if a.record:
        if not (a.cause and a.narrative):
            raise SystemExit("a result needs --cause and --narrative")
        if predictions.filter(F.col("prediction_id") == a.record).isEmpty():
            raise SystemExit(f"no prediction {a.record}")
        measured = spark.createDataFrame([(a.record, a.actual, a.cause, a.narrative)], "prediction_id string, actual double, cause_category string, narrative string")
        made = review.record(predictions, measured, as_of)
        tables.upsert(made, f"{a.data}/results", "result_id", F.col("evaluated_at"))
        for r in made.toLocalIterator():
            print(r.result_id, r.verdict, r.actual)
        return
    if a.due or not a.summary:
        n = 0
        for r in backtest.due(predictions, results, as_of).orderBy("due_date", "prediction_id").toLocalIterator():
            print(r.prediction_id, r.due_date, r.metric, r.operator, r.value)
            n += 1
        print(n, "predictions are due")
    if a.summary:
        s = backtest.accuracy(predictions, results, as_of).first()
        print(f"issued {s.total}, resolved {s.resolved} (hit {s.hit}, miss {s.miss}, partial {s.partial}), unresolvable {s.unresolvable}, pending {s.pending}")
        print("hit rate", "none is resolved yet" if s.hit_rate is None else s.hit_rate)
        for r in backtest.causes(predictions, results, as_of).toLocalIterator():
            print("cause", r.cause_category, r.n)


def do_sector(spark: SparkSession, a: argparse.Namespace) -> None:
    """How much evidence each sector has; for one sector its best evidence, the prompts, or the review of an answer, which is saved if nothing is wrong with it."""
    as_of = a.as_of or _now()
    events = spark.read.parquet(f"{a.data}/events")
    watched = [t for t in signals.watched(config.load(a.data).sectors) if t.sector_id]
    if a.list or not a.sector:
        counts = {t.sector_id: evidence.reliability_counts(evidence.bundle(events, t, as_of, a.window_days, a.max_events).filter("kind = 'report'")).withColumn("sector_id", F.lit(t.sector_id)) for t in watched}
        for r in reduce(DataFrame.unionByName, counts.values()).orderBy("sector_id").collect():
            print(r.sector_id, *(f"{k}={r[k]}" for k in fixed.RELIABILITY))
        return
    topic = next((t for t in watched if t.sector_id == a.sector), None)
    if topic is None:
        raise SystemExit(f"no sector {a.sector}")
    bundle = evidence.bundle(events, topic, as_of, a.window_days, a.max_events).persist()
    top = bundle.orderBy("kind", "position").limit(10).collect()
    if not top:
        print("no event tells of it; nothing can be said without evidence")
        return
    for r in top:
        print(f"[{r.max_reliability}] {r.event_at:%Y-%m-%d} {r.title}")
    if a.show_prompt:
        for view in ("consensus", "independent"):
            print(analysis.prompt(bundle, topic.label, view))
    if a.answer:
        profile = analysis.draft_profile(bundle, a.sector, topic.label, as_of, analysis.replay(a.answer))
        for line in profile["problems"]:
            print("not in evidence", line)
        if profile["problems"]:
            raise SystemExit(1)
        Path(a.data, "analyses").mkdir(exist_ok=True)
        _write(Path(a.data, "analyses", f"{a.sector}.json"), json.dumps(profile, ensure_ascii=False, default=str))
        _history(spark, a.data, "profiles", "sector_id").put(analysis.profile_row(spark, profile), as_of)
        print("saved", a.sector)
    bundle.unpersist()


def do_chain(spark: SparkSession, a: argparse.Namespace) -> None:
    """A chain or supply map of a sector that has a profile: prints the question, or reviews and saves the answer of a file."""
    path = Path(a.data, "analyses", f"{a.sector}.json")
    if not path.is_file():
        raise SystemExit(f"{a.sector} has no profile yet")
    profile = json.loads(path.read_text(encoding="utf-8"))
    topic = next((t for t in signals.watched(config.load(a.data).sectors) if t.sector_id == a.sector), signals.Topic(profile["name"], (), a.sector))
    bundle = evidence.bundle(spark.read.parquet(f"{a.data}/events"), topic, a.as_of).persist()
    if not a.answer:
        print(analysis.chain_prompt(bundle, profile, a.as_of, a.kind))
        return
    generate = lambda prompt, schema: Path(a.answer).read_text(encoding="utf-8")
    if a.kind == "wave":
        head, links = analysis.draft_wave(bundle, profile, a.as_of, generate)
        parts, problems, name = {"links": links}, analysis.review_wave(links, bundle), head["chain_id"]
    else:
        head, nodes, edges = analysis.draft_supply_chain(bundle, profile, a.as_of, generate)
        parts, problems, name = {"nodes": nodes, "edges": edges}, analysis.review_supply_chain(nodes, edges), head["map_id"]
    found = problems.orderBy("key", "rule", "detail").collect()
    for r in found:
        print(r.key, r.rule, r.detail)
    if found:
        raise SystemExit(1)
    # one answer of a generator: a few dozen rows
    whole = head | {k: [r.asDict(recursive=True) for r in df.collect()] for k, df in parts.items()}
    _write(Path(a.data, "analyses", f"{name}.json"), json.dumps(whole, ensure_ascii=False, default=str))
    for part, rows in parts.items():
        key = {"links": ["chain_id", "position"], "nodes": ["map_id", "node_id"], "edges": ["map_id", "source_name", "target_name", "flow"]}[part]
        _history(spark, a.data, part, key).put(rows.withColumn("as_of", F.lit(a.as_of).cast("timestamp")).fillna("", [c for c in key if c != "position"]), a.as_of)


#: What is validated: kind of schema, folder, key, and the rules beyond the schema.
VALIDATED = (
    ("raw", "raw", "raw_id", None), ("event", "events", "event_id", rules.events), ("signal", "windows", "window_id", rules.windows), ("prediction", "predictions", "prediction_id", rules.predictions), ("result", "results", "result_id", None),
)
FILED = (("report", "reports", "rpt_*.json", "report_id"), ("sector", "analyses", "sec_*.json", "sector_id"))


def _violations(spark: SparkSession, a: argparse.Namespace) -> list[DataFrame]:
    """The rules' violations; with a.schemas those of the schemas too."""
    found, whole = [], getattr(a, "schemas", False)
    for kind, folder, key, rule in VALIDATED:
        path = Path(a.data, folder)
        parts = sorted(str(p) for p in path.iterdir() if p.is_dir()) if kind == "signal" and path.is_dir() else [str(path)] if any(path.glob("*")) else []
        for part in parts:
            rows = tables.latest(spark, part)
            if whole:
                found.append(schemas.check_rows(rows, key, kind))
            elif kind in ("prediction", "result"):
                found.append(schemas.ill_formed(rows, key))
            if rule:
                found.append(rule(rows, a.as_of) if kind == "event" else rule(rows))
    for kind, folder, files, key in FILED if whole else ():
        if any(Path(a.data, folder).glob(files)):
            texts = spark.read.text(str(Path(a.data, folder, files)), wholetext=True)
            found.append(schemas.check(texts.select(F.coalesce(F.get_json_object("value", f"$.{key}"), F.lit(kind)).alias("key"), "value"), "key", "value", kind))
    registry = Path(a.data, "sources.json")
    listed = json.loads(registry.read_text(encoding="utf-8")) if registry.is_file() else []
    if listed and whole:
        texts = spark.createDataFrame([(str(r.get("source_id")), json.dumps(r, ensure_ascii=False)) for r in listed], "key string, value string")
        found.append(schemas.check(texts, "key", "value", "source"))
    return found


def do_validate(spark: SparkSession, a: argparse.Namespace) -> None:
    """Schemas and rules of all that is stored."""
    n = 0
    for found in _violations(spark, a):
        for r in found.orderBy("key", "rule", "detail").toLocalIterator():
            print(r.key, r.rule, r.detail)
            n += 1
    print(n, "violations")
    raise SystemExit(int(n > 0))


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    sub = parser.add_subparsers(required=True)
    yes, many, number = {"action": "store_true"}, {"action": "append"}, {"type": int}
    for name, f, flags in (
        ("init", do_init, {"--check": yes}), ("collect", do_collect, {"--source": many, "--tier": many, "--dry-run": yes, "--all": yes, "--force": yes}), ("daily", do_daily, {"--skip-collect": yes, "--window-days": {**number, "default": 7}}),
        ("backfill", do_backfill, {"--days": {**number, "default": 35}, "--source": many, "--dry-run": yes, "--delay": {"type": float}}), ("normalize", do_normalize, {"--limit": number, "--rebuild": yes}),
        ("detect", do_detect, {"--window-days": {**number, "default": 7}, "--baseline-multiplier": {**number, "default": 4}, "--topic": {}, "--keywords": {"nargs": "*"}, "--dry-run": yes, "--show-all": yes}),
        ("sector", do_sector, {"--sector": {}, "--list": yes, "--show-prompt": yes, "--answer": {}, "--window-days": {**number, "default": fixed.EVIDENCE_DAYS}, "--max-events": {**number, "default": fixed.EVIDENCE_LIMIT}}),
        ("report", do_report, {"--date": {}, "--stdout": yes}), ("review", do_review, {"--save": yes}), ("chain", do_chain, {"--sector": {"required": True}, "--kind": {"choices": ["wave", "supply_chain"], "default": "wave"}, "--answer": {}}),
        ("backtest", do_backtest, {"--due": yes, "--summary": yes, "--record": {}, "--actual": {"type": float}, "--cause": {}, "--narrative": {}}), ("validate", do_validate, {"--rules-only": {"action": "store_false", "dest": "schemas"}}),
    ):
        p = sub.add_parser(name)
        p.add_argument("--data", required=True)
        p.add_argument("--as-of", required=name in ("detect", "report", "review", "chain", "validate"))
        for flag, how in flags.items():
            p.add_argument(flag, **how)
        p.set_defaults(run=f)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = parse(argv)
    a.run(session.build(), a)


if __name__ == "__main__":
    main()
