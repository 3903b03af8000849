"""Causal chains and supply maps as tables of links, nodes and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ids


def resolve_names(edges: DataFrame, nodes: DataFrame, key: str = "map_id") -> DataFrame:
    """edges (key, source_name, target_name) with the ids of the nodes so named, else ids made of the names."""
    out = edges
    for side in ("source", "target"):
        known = nodes.select(key, F.col("name").alias(f"{side}_name"), F.col("node_id").alias(f"_{side}")).dropDuplicates([key, f"{side}_name"])
        out = out.join(known, [key, f"{side}_name"], "left").withColumn(side, F.coalesce(f"_{side}", ids.named("nd_", F.col(f"{side}_name")))).drop(f"_{side}")
    return out


def slug_collisions(nodes: DataFrame, key: str = "map_id") -> DataFrame:
    """Nodes of a map whose different names lead to the same id."""
    return nodes.groupBy(key, "node_id").agg(F.count_distinct("name").alias("n"), F.array_sort(F.collect_set("name")).alias("names")).filter("n > 1")


def bottleneck_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.filter("is_bottleneck")


def map_sizes(nodes: DataFrame, edges: DataFrame, key: str = "map_id") -> DataFrame:
    n = nodes.groupBy(key).agg(F.count("*").alias("nodes"))
    return n.join(edges.groupBy(key).agg(F.count("*").alias("edges")), key, "left").withColumn("edges", F.coalesce("edges", F.lit(0).cast("long")))


def chain_links(chains: DataFrame) -> DataFrame:
    """chains (chain_id, links: array of structs) as rows with the link's position."""
    return chains.select("chain_id", F.posexplode("links").alias("position", "link")).select("chain_id", "position", "link.*")
