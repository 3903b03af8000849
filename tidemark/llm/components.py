"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Edges that one task contracts at once, at most.
PORTION = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of edges but the smallest of each component, and that smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        # hook the larger root of an edge under the smaller, then let every node point to its root
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
        x, y = label[x], label[y]
        apart = x != y
        x, y = x[apart], y[apart]
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) as stars with the same components, PORTION at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def stars() -> pa.RecordBatch:
        a, b = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for at in range(0, batch.num_rows, PORTION):
            part = batch.slice(at, PORTION)
            held.append((part.column(0).to_numpy(), part.column(1).to_numpy()))
            n += part.num_rows
            if n >= PORTION:
                yield stars()
                held, n = [], 0
    if held:
        yield stars()


def components(edges: DataFrame) -> DataFrame:
    """node, label: for each node of edges (a, b: long) the smallest node of its component.

    Tasks first make stars of what edges they have, a bounded number each. If that was one task's, it is all. Else rounds follow:
    each rewires every node to the smallest it knows of; their number grows with
    the logarithm of the longest path. Rounds are written to the shared folder.
    """
    def tidy(pairs: DataFrame) -> DataFrame:
        return C.materialise(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")

    def settled(pairs: DataFrame) -> bool:
        """Whether every node that points somewhere points to one node, which itself points nowhere."""
        ends = pairs.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(pairs.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        return ends.groupBy("n").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).filter("out > 1 or (out > 0 and into > 0)").limit(1).count() == 0

    found = C.materialise(edges.select("a", "b").filter("a is not null and b is not null"), "found-links")
    parts = -(-found.count() // PORTION) or 1
    links = C.materialise(found.repartition(parts).mapInArrow(contracted, "a long, b long"), "contracted")
    C.discard(found)
    if parts > 1:
        links, first = tidy(links), links
        C.discard(first)
    while parts > 1 and not settled(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = C.materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large-star")
        large = tidy(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        C.discard(links, least)
        least = C.materialise(large.groupBy("a").agg(F.min("b").alias("m")), "small-star")
        links = tidy(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
        C.discard(large, least)
    # every node but the smallest now points to the smallest of its component
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
