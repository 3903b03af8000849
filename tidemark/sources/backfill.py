"""Taking in the past: pieces of time, what was covered, how spans merge, and the run itself.

A run asks each source for its days in pieces of chunk_days. Pieces of one source follow one another, delay_seconds apart, in one task;
sources run beside one another. What came of each piece is kept, so a run that is repeated asks only for what is missing. A source's span is what was taken in
without an error from its first day on; a piece with nothing in it is no error. Documents keep the time at which they were fetched.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import time as T
from tidemark.sources import collect, feeds, tables

DELAY_SECONDS = 3.0
RESULT = "source_id string, start date, end date, n long, error string"


def plan(spark: SparkSession, sources: DataFrame, days: int, until: str) -> DataFrame:
    """source_id, start, end: each source's days until then in pieces of its chunk_days, oldest first."""
    last = T.instant(until).date()
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.lit(days - 1) / F.col("chunk_days")).cast("int")), lambda i: F.date_add(F.lit(last - timedelta(days=days - 1)), (i * F.col("chunk_days")).cast("int")))
    rows = sources.select("source_id", "chunk_days", F.explode(pieces).alias("start"))
    return rows.select("source_id", "start", F.least(F.date_add("start", F.col("chunk_days") - 1), F.lit(last)).alias("end")).orderBy("source_id", "start")


def covered(results: DataFrame) -> DataFrame:
    """source_id, from_day, to_day, n: the pieces up to the first error. results: source_id, start, end, n, error."""
    failed = F.max(F.col("error").isNotNull().cast("int")).over(Window.partitionBy("source_id").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return results.withColumn("_failed", failed).filter("_failed = 0").groupBy("source_id").agg(F.min("start").alias("from_day"), F.max("end").alias("to_day"), F.sum("n").alias("n"))


def merge_spans(old: DataFrame, new: DataFrame) -> DataFrame:
    """Spans that touch become one; a new span apart from the old one replaces it."""
    o = old.select("source_id", F.col("from_day").alias("_f"), F.col("to_day").alias("_t"))
    joined = o.join(new, "source_id", "full")
    touches = (F.col("from_day") <= F.date_add("_t", 1)) & (F.col("_f") <= F.date_add("to_day", 1))
    return joined.select("source_id", F.when(F.col("_f").isNotNull() & (F.col("from_day").isNull() | touches), F.least("_f", "from_day")).otherwise(F.col("from_day")).alias("from_day"), F.when(F.col("_t").isNotNull() & (F.col("to_day").isNull() | touches), F.greatest("_t", "to_day")).otherwise(F.col("to_day")).alias("to_day"))


def supported(source: dict) -> bool:
    """Whether a source can be asked for a range of days: by a template of its address, or by a body that is posted."""
    spec = source.get("backfill")
    return bool(spec) and (bool(spec.get("endpoint_template")) or source.get("http_method", "GET").upper() == "POST")


def unsupported(requested: Iterable[str], sources: Iterable[dict]) -> list[str]:
    """Those requested that can't be asked for a range, or aren't there."""
    return sorted(set(requested) - {s["source_id"] for s in sources if supported(s)})


def chunk_source(source: dict, start: date, end: date) -> dict:
    """A copy of a source that asks for the days from start to end."""
    spec = source["backfill"]
    out = {**source, "kind": spec.get("kind", source["kind"]), "date_range": {"start": start.isoformat(), "end": end.isoformat()}}
    if spec.get("endpoint_template"):
        out["endpoint"] = spec["endpoint_template"].format(start_date=start.isoformat(), end_date=end.isoformat(), start_compact=f"{start:%Y%m%d}", end_compact=f"{end:%Y%m%d}")
    return out


def requests(spark: SparkSession, sources: list[dict], days: int, until: str, delay_seconds: float | None = None) -> DataFrame:
    """Rows of collect.SOURCE, one for each piece of each source that can be asked for a range. Sources and pieces come from the registry's settings."""
    known = {s["source_id"]: s for s in sources if supported(s)}
    sizes = spark.createDataFrame([(k, max(1, int(s["backfill"].get("chunk_days", 1)))) for k, s in known.items()], "source_id string, chunk_days int")
    rows = []
    for r in plan(spark, sizes, days, until).toLocalIterator():
        asked = chunk_source(known[r.source_id], r.start, r.end)
        delay = asked["backfill"].get("delay_seconds", DELAY_SECONDS) if delay_seconds is None else delay_seconds
        piece = {"start": r.start.isoformat(), "end": r.end.isoformat()}
        rows.append({**asked, **piece, "enabled": True, "delay_seconds": float(delay), "part": json.dumps(piece)})
    return collect.sources_table(spark, rows)


def outcome(asked: DataFrame, payloads: DataFrame, found: DataFrame) -> DataFrame:
    """RESULT of the pieces that were asked for: the entries found (source_id, part) and the first error; an empty answer is none."""
    piece = lambda name: F.to_date(F.get_json_object("part", f"$.{name}"))
    wrong = collect.judge(payloads).groupBy("source_id", "part").agg(F.min(F.when(F.col("error") != collect.EMPTY, F.col("error"))).alias("error"))
    counts = found.groupBy("source_id", "part").agg(F.count("*").alias("n"))
    rows = asked.select("source_id", "part").join(wrong, ["source_id", "part"], "left").join(counts, ["source_id", "part"], "left")
    return rows.select("source_id", piece("start").alias("start"), piece("end").alias("end"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), "error")


def run(spark: SparkSession, sources: list[dict], root: str, days: int, until: str, *, fetch: collect.Fetch = collect.http_fetch, delay_seconds: float | None = None, parallel: int = 16, dry_run: bool = False) -> DataFrame:
    """Takes in the days up to until of all sources that can be asked for them; RESULT of the pieces of this range, those of earlier runs too.

    Under root: raw (documents), backfill/payloads (answers as they came), backfill/results and backfill/spans (source_id, from_day, to_day).
    """
    results, spans = f"{root}/backfill/results", f"{root}/backfill/spans"
    asked = requests(spark, sources, days, until, delay_seconds)
    done = tables._existing(spark, results)
    piece = [F.to_date("start").alias("start"), F.to_date("end").alias("end")]
    before = None if done is None else asked.select("source_id", *piece).join(done.filter("error is null"), ["source_id", "start", "end"]).select("source_id", "start", "end", "n", "error").distinct()
    missing = asked if before is None else asked.join(before.select("source_id", F.col("start").cast("string"), F.col("end").cast("string")), ["source_id", "start", "end"], "left_anti")
    answers = f"{root}/backfill/payloads/{T.instant(until):%Y%m%d}-{tables.uuid.uuid4().hex}"
    # answers are written once, so nothing is asked twice
    collect.fetch_sources(missing, until, fetch=fetch, parallel=parallel).write.parquet(answers)
    payloads = spark.read.schema(collect.PAYLOAD).parquet(answers)
    found, _ = collect.entries(payloads)
    now = outcome(missing, payloads, found)
    if dry_run:
        return now if before is None else now.unionByName(before)
    # documents land before their pieces count as done: a run that dies in between asks again and lands nothing twice
    tables.append_absent(feeds.raw_documents(found), f"{root}/raw", "raw_id", [F.col("observed_at"), F.col("url")])
    now.write.mode("append").parquet(results)
    # a piece that failed and was taken in later is no error any more
    latest = spark.read.schema(RESULT).parquet(results).join(asked.select("source_id", *piece), ["source_id", "start", "end"], "left_semi").groupBy("source_id", "start", "end").agg(F.max("n").alias("n"), F.when(F.count_if(F.col("error").isNull()) == 0, F.min("error")).alias("error"))
    made = covered(latest).select("source_id", "from_day", "to_day")
    if tables.published(spark, spans):
        old = tables.latest(spark, spans)
        made = merge_spans(old.select("source_id", "from_day", "to_day"), made)
    tables.upsert(made.withColumn("at", F.current_timestamp()), spans, "source_id", F.col("at"))
    return latest
