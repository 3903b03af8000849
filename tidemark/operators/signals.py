"""Weak signals: counts in a calendar window against a scaled baseline, gated by observation coverage.

All topics are evaluated in one plan: events are matched to topics where they are read, exploded by signal
type and aggregated twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import text as X
from tidemark.functions import time as T
from tidemark.sources import shared


@dataclass(frozen=True)
class Topic:
    """A sector, or a concept known by keywords only."""

    label: str
    keywords: tuple[str, ...] = ()
    sector_id: str | None = None
    is_new_concept: bool = False


def watched(sectors: Iterable[tuple[str, str, tuple[str, ...]]] = fixed.SECTORS) -> list[Topic]:
    return [Topic(name, words, sector) for sector, name, words in sectors]


def topic_name(t: Topic) -> str:
    """What a topic's window ids are made of: its sector's id, or the slug of its label."""
    return t.sector_id.removeprefix("sec_") if t.sector_id else X.slug_of(t.label)


def topic_table(spark, topics: Iterable[Topic]) -> DataFrame:
    """topic, label, keywords, sector_id, is_new_concept."""
    rows = [(topic_name(t), t.label, list(t.keywords), t.sector_id, t.is_new_concept) for t in topics]
    return spark.createDataFrame(rows, "topic string, label string, keywords array<string>, sector_id string, is_new_concept boolean")


def match_topics(events: DataFrame, specs: Sequence[Topic]) -> DataFrame:
    """events with the topic of each match, by sector or by keyword, once for each topic.

    Topics are constants of the plan: events are matched where they are read, without a join or a shuffle.
    """
    return _topics_of(events, specs).withColumn("topic", F.explode("topics")).drop("topics")


def _topics_of(events: DataFrame, specs: Sequence[Topic]) -> DataFrame:
    """events with the topics that each matches, as a list; none of the topics is looked for twice."""
    none = F.array().cast("array<string>")
    by_sector: dict[str, list[str]] = {}
    for t in specs:
        if t.sector_id:
            by_sector.setdefault(t.sector_id, []).append(topic_name(t))
    found = none
    if by_sector:
        topics = F.create_map(*[x for s, names in by_sector.items() for x in (F.lit(s), F.array(*map(F.lit, names)))])
        found = F.coalesce(F.flatten(F.transform("sector_links", lambda s: F.coalesce(F.try_element_at(topics, s["sector_id"]), none))), none)
    named = [t for t in specs if t.keywords]
    if not named:
        return events.withColumn("topics", F.array_distinct(found))
    normal = X.normalize_text(F.concat_ws("\n", "title", F.coalesce("summary", F.lit(""))))
    hits = F.array_compact(F.array(*[F.when(F.rlike("_text", F.lit(X.topic_pattern(t.keywords))), F.lit(topic_name(t))) for t in named]))
    return events.withColumn("_text", normal).withColumn("topics", F.array_distinct(F.concat(found, hits))).drop("_text")


def facts(events: DataFrame, specs: Sequence[Topic], window: T.Window) -> DataFrame:
    """All that windows are made of, from one scan of the events and one shuffle of sums: for each topic and type how many events lie in the
    window and the baseline and which (kind count), the sources and regions of those in the window, and since when each source is observed (live)."""
    inside, before = window.inside(F.col("event_at")), window.before(F.col("event_at"))
    rows = _topics_of(events, specs).select("topics", "event_id", "event_at", "observed_at", "signal_types", "regions", F.transform("sources", lambda s: s["source_id"]).alias("_sources"), F.coalesce(inside, F.lit(False)).alias("_in"), F.coalesce(before, F.lit(False)).alias("_before"))
    text = F.lit(None).cast("string")
    fact = lambda kind, value, topic=text, signal_type=text: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), topic.alias("topic"), signal_type.alias("signal_type"))
    empty = F.array().cast("array<struct<kind:string,value:string,topic:string,signal_type:string>>")
    each = lambda values, make: F.coalesce(F.transform(values, make), empty)

    def of(topic: Column, kind: Column) -> Column:
        here = F.array(fact("count", text, topic, kind))
        return F.when(F.col("_in"), F.concat(here, each("_sources", lambda x: fact("source", x, topic, kind)), each("regions", lambda x: fact("region", x, topic, kind)))).when(F.col("_before"), here).otherwise(empty)

    told = F.flatten(F.transform("topics", lambda t: F.flatten(F.transform(F.coalesce("signal_types", F.array().cast("array<string>")), lambda y: of(t, y)))))
    live = F.coalesce(F.transform("_sources", lambda x: fact("live", x)), empty)
    dealt = rows.select("event_id", "event_at", "observed_at", "_in", "_before", F.explode(F.concat(told, live)).alias("f")).select("*", "f.*")
    counted = F.col("kind") == "count"
    found = dealt.groupBy("topic", "signal_type", "kind", "value").agg(
        F.count_if(counted & F.col("_in")).alias("n"), F.count_if(counted & F.col("_before")).alias("before"), F.min(F.when(F.col("kind") == "live", F.col("observed_at"))).alias("first"),
        F.transform(F.array_sort(F.collect_list(F.when(counted & F.col("_in"), F.struct("event_at", "event_id")))), lambda e: e["event_id"]).alias("event_ids"),
    )
    # read several times below, and as small as there are topics, types and sources
    return shared.kept(found, "signal-facts")


def coverage_starts(events: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """source_id, starts: since when a source has been observed without a gap.

    spans: source_id, from_day, to_day of what was taken in later; it counts if it reaches the day before live observation.
    """
    live = events.select(F.explode("sources").alias("s"), "observed_at").groupBy(F.col("s.source_id").alias("source_id")).agg(F.min("observed_at").alias("live"))
    return starts_of(live, spans)


def starts_of(live: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """coverage_starts from source_id, live."""
    if spans is None:
        return live.withColumnRenamed("live", "starts")
    joined = live.join(spans, "source_id", "left")
    reaches = F.col("to_day") >= F.date_sub(F.to_date("live"), 1)
    return joined.select("source_id", F.when(reaches, F.least("live", F.col("from_day").cast("timestamp"))).otherwise(F.col("live")).alias("starts"))


def rounded(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def type_counts(matched: DataFrame, window: T.Window, keys: Sequence[str] = ("topic",)) -> DataFrame:
    """keys, signal_type, count, baseline_count, delta_ratio, rising, event_ids of matched events."""
    inside, before = window.inside(F.col("event_at")), window.before(F.col("event_at"))
    rows = matched.withColumns({"_in": inside, "_before": before}).filter("_in or _before").select(*keys, "event_id", "event_at", "_in", "_before", F.explode("signal_types").alias("signal_type"))
    counts = rows.groupBy(*keys, "signal_type").agg(
        F.count_if("_in").alias("count"), F.count_if("_before").alias("_raw"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_in"), F.struct("event_at", "event_id")))), lambda e: e["event_id"]).alias("event_ids"),
    )
    return rates(counts, window)


def rates(counts: DataFrame, window: T.Window) -> DataFrame:
    """counts (count, _raw) with the scaled baseline, the change against it and whether it rises."""
    baseline = rounded(F.col("_raw") * F.lit(window.scale), 3)
    counts = counts.withColumn("baseline_count", baseline).drop("_raw")
    return counts.withColumn("delta_ratio", F.when(F.col("baseline_count") > 0, rounded(F.col("count") / F.col("baseline_count") - 1, 3))).withColumn(
        "rising", (F.col("count") >= fixed.LEAST_COUNT) & (F.col("count") > F.col("baseline_count"))
    )


def score(types: Column, sources: Column, regions: Column) -> Column:
    """Capped and weighted: half by types, the rest by sources and regions."""
    parts = [F.least(c, F.lit(cap)) / cap * weight for c, (weight, cap) in zip((types, sources, regions), (fixed.SCORE["types"], fixed.SCORE["sources"], fixed.SCORE["regions"]), strict=True)]
    return rounded(parts[0] + parts[1] + parts[2], 1)


def windows(events: DataFrame, specs: Sequence[Topic], window: T.Window, as_of: str | datetime, spans: DataFrame | None = None) -> DataFrame:
    """A row for each topic: what rises, by how many sources and regions, whether the baseline is covered, whether the signal fires.

    events: visible primary events with event_id, event_at, observed_at, title, summary, signal_types, regions, sector_links, sources.
    """
    spark = events.sparkSession
    topics = topic_table(spark, specs)
    told = facts(events, specs, window)
    kind = lambda name: told.filter(F.col("kind") == name)
    counts = rates(kind("count").select("topic", "signal_type", F.col("n").alias("count"), F.col("before").alias("_raw"), "event_ids"), window)
    rising = counts.filter("rising").select("topic", "signal_type")
    of_rising = lambda name: kind(name).join(rising, ["topic", "signal_type"], "left_semi").select("topic", F.col("value")).distinct()
    sources = of_rising("source").withColumnRenamed("value", "source_id")
    regions = of_rising("region").groupBy("topic").agg(F.count("*").alias("distinct_regions"))
    covers = F.coalesce("starts", T.at(as_of)) <= F.lit(window.baseline_start).cast("timestamp")
    starts = starts_of(kind("live").select(F.col("value").alias("source_id"), F.col("first").alias("live")), spans)
    covered = sources.join(starts, "source_id", "left").groupBy("topic").agg(F.count("*").alias("distinct_sources"), F.bool_and(covers).alias("baseline_covered"))
    types = counts.groupBy("topic").agg(F.count_if("rising").alias("distinct_signal_types"), F.array_sort(F.collect_list(F.struct("signal_type", "count", "baseline_count", "delta_ratio", "event_ids"))).alias("counts"))
    out = topics.join(types, "topic", "left").join(covered, "topic", "left").join(regions, "topic", "left")
    n = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = out.select(
        F.concat(F.lit("sig_"), "topic", F.lit(f"_{window.end:%Y%m%d}")).alias("window_id"), "topic", "label", "sector_id", "is_new_concept",
        F.coalesce("counts", F.array().cast(types.schema["counts"].dataType)).alias("counts"), n("distinct_signal_types").alias("distinct_signal_types"), n("distinct_sources").alias("distinct_sources"),
        n("distinct_regions").alias("distinct_regions"), F.coalesce("baseline_covered", F.lit(False)).alias("baseline_covered"),
    )
    out = out.withColumn("score", score(F.col("distinct_signal_types"), F.col("distinct_sources"), F.col("distinct_regions")))
    fires = F.col("baseline_covered") & (F.col("distinct_signal_types") >= fixed.LEAST_TYPES) & (F.col("distinct_sources") >= fixed.LEAST_SOURCES)
    rationale = F.when(~F.col("baseline_covered"), "held: the baseline isn't covered by observation").when(fires, "to be evaluated: the threshold is met").otherwise("the threshold is not met")
    return out.withColumns({
        "threshold_met": fires, "promoted": F.lit(False), "rationale": rationale, "as_of": F.lit(T.instant(as_of)), "window_start": F.lit(window.start), "window_end": F.lit(window.end),
        "baseline_start": F.lit(window.baseline_start), "baseline_end": F.lit(window.baseline_end),
    })


def overview(rows: DataFrame, everything: bool = False, most: int = 4) -> DataFrame:
    """label, mark, distinct_signal_types, distinct_sources, distinct_regions, score, detail of windows that fire (*) or are held for lack of coverage though something rises (!); with everything also the others.

    detail: the most frequent types with their counts, and the scaled baseline behind each.
    """
    number = lambda c: F.regexp_replace(c.cast("string"), r"\.0$", "")
    first = F.slice(F.array_sort(F.transform("counts", lambda c: F.struct((-c["count"]).alias("n"), c["signal_type"].alias("t"), F.concat(c["signal_type"], F.lit("="), c["count"].cast("string"), F.lit(" ("), number(c["baseline_count"]), F.lit(")")).alias("shown")))), 1, most)
    mark = F.when(F.col("threshold_met"), "*").when(~F.col("baseline_covered") & (F.col("distinct_signal_types") >= 1), "!").otherwise("")
    out = rows.select("label", mark.alias("mark"), "distinct_signal_types", "distinct_sources", "distinct_regions", "score", F.array_join(F.transform(first, lambda x: x["shown"]), ", ").alias("detail"))
    return out if everything else out.filter("mark <> ''")
