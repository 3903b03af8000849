"""Raw documents to events: unknown sources skipped, texts classified, reports of the same thing clustered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import ids
from tidemark.functions import text as X
from tidemark.operators import classify, dedup
from tidemark.sources import tables


def pending(raw: DataFrame, done: DataFrame | None, limit: int | None = None) -> DataFrame:
    """Raw rows that aren't normalised yet, in the order of observation."""
    rows = raw if done is None else raw.join(done.select("raw_id"), "raw_id", "left_anti")
    return rows.orderBy("observed_at", "raw_id").limit(limit) if limit is not None else rows


def events(raw: DataFrame, registry: DataFrame, by: config.Rules | None = None) -> DataFrame:
    """Events of raw documents (see sources.feeds.RAW) of known sources, classified by the given rules or the library's own."""
    by = by or config.Rules()
    rows = tables.with_sources(raw, tables.small(registry)).filter("status = 'normalized'")
    publisher = F.coalesce("src.publisher", "src.name")
    rows = rows.withColumn("event_at", F.coalesce("published_at", "observed_at"))
    keyed = dedup.keyed(rows, publisher)
    clusters = dedup.assign_clusters(keyed)
    normal = X.normalize_text(F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))))
    types = classify.signal_types(F.col("_text"), F.col("src.default_signal_types"), F.col("src.kind") == "json_series", by.signal_types)
    named = keyed.drop("tokens").withColumn("_text", normal).withColumns({"signal_types": types, "sector_links": classify.sector_links(classify.sector_ids(F.col("_text"), F.col("sector_ids"), by.sectors))})
    event_id = ids.event_id(F.col("observed_at"), F.col("content_hash"))
    actor = F.struct(publisher.alias("name"), classify.actor_kind(F.col("src.tier"), F.col("src.reliability"), F.col("src.publisher"), F.col("src.name")).alias("kind"), F.col("src.country").alias("country"), F.lit("initiator").alias("role"))
    source = F.struct("source_id", "raw_id", F.col("canonical_url").alias("url"), F.col("src.reliability").alias("reliability"), "observed_at")
    claim = F.struct(F.concat(event_id, F.lit("#c1")).alias("claim_id"), F.lit("observed").alias("type"), F.col("title").alias("statement"), classify.confidence(F.col("src.reliability")).alias("confidence"), F.array().cast("array<string>").alias("basis"))
    out = named.join(clusters, "raw_id")
    return out.select(
        "raw_id", event_id.alias("event_id"), "cluster_id", "is_cluster_primary", classify.category(F.col("signal_types"), F.col("src.categories")).alias("category"), "title",
        X.summarize(F.coalesce(F.nullif("body", F.lit("")), "title")).alias("summary"), "observed_at", "event_at", F.lit("day").alias("event_at_precision"), "published_at",
        F.when(F.col("src.country").isNotNull(), F.array("src.country")).otherwise(F.array().cast("array<string>")).alias("regions"), F.array(actor).alias("actors"), "signal_types", "sector_links",
        F.array(source).alias("sources"), F.col("src.reliability").alias("max_reliability"), F.array(claim).alias("claims"), "quantities", F.struct("method", "similarity", "duplicate_of").alias("dedup"),
    )


def progress(raw: DataFrame, made: DataFrame, registry: DataFrame) -> DataFrame:
    """processed, created, duplicates, skipped."""
    status = tables.with_sources(raw, tables.small(registry)).agg(F.count("*").alias("processed"), F.count_if(F.col("status") == "skipped").alias("skipped"))
    made = made.agg(F.count_if("is_cluster_primary").alias("created"), F.count_if(~F.col("is_cluster_primary")).alias("duplicates"))
    return status.join(made, F.lit(True))
