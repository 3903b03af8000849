"""Clusters of event days that are carried from run to run.

A day's clusters are keyed state: the first row, sources and words of each cluster, and the cluster of each URL, hash and key. A batch
that brings documents of a day, today's or one long past, continues that day where it was left; days it has none of aren't touched.
Batches that arrive in the order of observation give the clusters that one batch would.

Of the keys only the buckets of the batch's own rows are looked up; the clusters of a day that the batch touches are read, as the rule
compares a document with all of them, and only entries with changed ones are written back. A row that comes again with the same id joins the cluster of its URL.
Rows without an event day, which no day can hold, are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions import ids
from tidemark.operators import dedup

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Clusters of one entry of the state, and the entries that a day's keys are dealt to: a batch that brings many documents asks for each entry once, not for each key.
CHUNK, BUCKETS = 32, 4096
_AT = T.StructType([T.StructField("n", T.IntegerType())])
_WORDS = T.ArrayType(T.StringType())
_CLUSTERS = T.StructType([T.StructField("first", _WORDS), T.StructField("sources", T.ArrayType(_WORDS)), T.StructField("tokens", T.ArrayType(_WORDS))])
_KEYS = T.StructType([T.StructField("kind", _WORDS), T.StructField("key", _WORDS), T.StructField("n", T.ArrayType(T.IntegerType()))])


def _bucket(kind: str, key: str) -> int:
    return zlib.crc32(f"{kind} {key}".encode("utf-8", "surrogatepass")) % BUCKETS


class DayClusters(StatefulProcessor):
    """One event day: clusters by number, CHUNK an entry, and the number of the cluster of each key, by bucket."""

    def __init__(self, methods: Sequence[str] = dedup.METHODS):
        self.methods = tuple(methods)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clusters = handle.getMapState("clusters", _AT, _CLUSTERS)
        self.keys = handle.getMapState("keys", _AT, _KEYS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows), ignore_index=True)
        chunks = {at[0]: [dedup.Cluster(f, set(s or ()), set(t or ())) for f, s, t in zip(*c, strict=True)] for at, c in self.clusters.iterator()}
        buckets: dict[int, dict[tuple[str, str], int]] = {}

        def bucket(at: int) -> dict[tuple[str, str], int]:
            if at not in buckets:
                found = self.keys.getValue((at,))
                buckets[at] = {(k, v): n for k, v, n in zip(*found, strict=True)} if found else {}
            return buckets[at]

        day = dedup.Day(dedup.frequencies(batch), [c for i in range(len(chunks)) for c in chunks[i]], lambda kind, value: bucket(_bucket(kind, value)).get((kind, value)), self.methods)
        made = day.put_all(batch)
        for i in sorted({n // CHUNK for n in day.changed}):
            cs = day.clusters[i * CHUNK : (i + 1) * CHUNK]
            self.clusters.updateValue((i,), ([c.first for c in cs], [sorted(c.sources) for c in cs], [sorted(c.tokens) for c in cs]))
        changed = set()
        for k, n in day.keys.items():
            at = _bucket(*k)
            bucket(at)[k] = n
            changed.add(at)
        for at in sorted(changed):
            held = buckets[at]
            self.keys.updateValue((at,), ([k for k, _ in held], [v for _, v in held], list(held.values())))
        yield made

    def close(self) -> None:
        pass


def assign(docs: DataFrame, methods: Sequence[str] = dedup.METHODS) -> DataFrame:
    """Like dedup.assign_clusters, for a stream: one row a document, by the clusters of its day so far."""
    rows = docs.filter("event_date is not null").select("event_date", "observed_at", "raw_id", "source_id", "canonical_url", "content_hash", "event_key", "tokens")
    made = rows.groupBy("event_date").transformWithStateInPandas(DayClusters(methods), outputStructType=dedup.ASSIGNED, outputMode="Append", timeMode="None")
    return made.withColumn("cluster_id", ids.cluster_id(F.col("cluster_id")))


def follow(docs: DataFrame, path: str, checkpoint: str, methods: Sequence[str] = dedup.METHODS) -> StreamingQuery:
    """Clusters what is there of a stream of keyed documents and adds it to the table at path; the state lives under checkpoint."""
    spark: SparkSession = docs.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        return assign(docs, methods).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
