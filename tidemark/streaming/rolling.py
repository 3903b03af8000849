"""Signal windows that are kept up to date: counts of topics and types, moved on day by day.

Arriving events are added up once, by topic, type and day of the event, and lie by batch and day. The counts of a window and its baseline are a
state. To move the window on, the days that enter or leave it are added and subtracted, and what has arrived since, however late, is added where the
window now is; the days between are not read again. State and the batches in it are published together, so a run that dies is simply run again, and
a batch that is added twice (under the same number) counts once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed
from tidemark.functions import time as T
from tidemark.operators import signals
from tidemark.sources import tables

DAILY = "topic string, signal_type string, n long, batch long, day date"
STATE = "topic string, signal_type string, count long, before long"


def daily(matched: DataFrame) -> DataFrame:
    """topic, signal_type, day, n of events that are matched to topics."""
    rows = matched.select("topic", F.explode("signal_types").alias("signal_type"), F.to_date("event_at").alias("day")).filter("day is not null")
    return rows.groupBy("topic", "signal_type", "day").agg(F.count("*").alias("n"))


class Rolling:
    """The counts at path, for windows of so many days before a baseline of multiplier times as many."""

    def __init__(self, spark: SparkSession, path: str, days: int = 7, multiplier: int = 4):
        self.spark, self.path, self.days, self.multiplier = spark, path, days, multiplier

    def window(self, end: date) -> T.Window:
        return T.Window.ending(end, self.days, self.multiplier)

    def add(self, matched: DataFrame, batch: int) -> None:
        """Adds a batch of events (topic, signal_types, event_at), once whatever is repeated."""
        daily(matched).write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/daily/batch={batch}")

    def follow(self, matched: DataFrame, checkpoint: str) -> StreamingQuery:
        """Adds what is there of a stream of matched events."""
        return matched.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def _batches(self) -> list[int]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/daily")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def _published(self) -> dict | None:
        versions = tables._versions(self.spark, f"{self.path}/state")[2]
        return json.loads(tables.version_text(self.spark, f"{self.path}/state", max(versions))) if versions else None

    @staticmethod
    def _shares(day: date, w: T.Window | None) -> tuple[int, int]:
        """How often a day counts in a window and in its baseline."""
        return (0, 0) if w is None else (int(w.start <= day <= w.end), int(w.baseline_start <= day <= w.baseline_end))

    def _moved(self, batches: Sequence[int], old: T.Window | None, new: T.Window) -> DataFrame | None:
        """What the given batches add to the state, of the days alone whose share differs."""
        span = [w for w in (old, new) if w]
        first, last = min(w.baseline_start for w in span), max(w.end for w in span)
        every = [first + timedelta(days=i) for i in range((last - first).days + 1)]
        change = {d: tuple(a - b for a, b in zip(self._shares(d, new), self._shares(d, old), strict=True)) for d in every}
        days = [d for d in every if change[d] != (0, 0)]
        if not batches or not days:
            return None
        # the days of a window and its baseline: a few dozen
        share: list[Column] = [F.element_at(F.create_map(*[F.lit(x) for d in days for x in (d, change[d][i])]), F.col("day")) for i in (0, 1)]
        rows = self.spark.read.schema(DAILY).parquet(f"{self.path}/daily").filter(F.col("batch").isin(*batches) & F.col("day").isin(*days))
        return rows.select("topic", "signal_type", (F.col("n") * share[0]).alias("count"), (F.col("n") * share[1]).alias("before"))

    def advance(self, end: date) -> None:
        """Moves the window so that it ends on a day, which may also lie before the last one."""
        seen = tables._versions(self.spark, f"{self.path}/state")[2]
        held, batches = self._published(), self._batches()
        old = self.window(date.fromisoformat(held["end"])) if held else None
        known = held["batches"] if held else []
        new = self.window(end)
        parts = [self._read(held["folder"])] if held else []
        parts += [x for x in (self._moved(known, old, new), self._moved([b for b in batches if b not in known], None, new)) if x is not None]
        whole = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], STATE)
        folder = f"counts-{uuid.uuid4().hex}"
        whole.groupBy("topic", "signal_type").agg(F.sum("count").alias("count"), F.sum("before").alias("before")).filter("count <> 0 or before <> 0").write.parquet(f"{self.path}/state/{folder}")
        tables.publish(self.spark, f"{self.path}/state", json.dumps({"end": end.isoformat(), "folder": folder, "batches": batches}), seen)

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(f"{self.path}/state/{folder}")

    def counts(self) -> DataFrame:
        """topic, signal_type, count, baseline_count, delta_ratio, rising as signals.type_counts has them."""
        held = self._published()
        if not held:
            raise ValueError(f"no window at {self.path}")
        baseline = signals.rounded(F.col("before") * F.lit(self.window(date.fromisoformat(held["end"])).scale), 3)
        rows = self._read(held["folder"]).withColumn("baseline_count", baseline).drop("before")
        rows = rows.withColumn("delta_ratio", F.when(F.col("baseline_count") > 0, signals.rounded(F.col("count") / F.col("baseline_count") - 1, 3)))
        return rows.withColumn("rising", (F.col("count") >= fixed.LEAST_COUNT) & (F.col("count") > F.col("baseline_count")))
