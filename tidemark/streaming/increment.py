"""Landing and counting as streams.

Documents may be observed arbitrarily late and still count, so there is no watermark: a batch of the stream is
anti-joined with what the table holds, which also makes a replayed batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import landing, tables


def land(stream: DataFrame, path: str, checkpoint: str, key: str = "raw_id", available_now: bool = True) -> StreamingQuery:
    """Appends the rows of a stream whose key the table doesn't hold."""

    def batch(df: DataFrame, epoch: int) -> None:
        tables.append_absent(df, path, key, [F.col("observed_at"), F.col(key)])

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def land_indexed(stream: DataFrame, path: str, checkpoint: str, key: str = "raw_id", available_now: bool = True) -> StreamingQuery:
    """Like land, into a table with an index of its keys: a batch reads what its own keys call for, however large the table is."""

    def batch(df: DataFrame, epoch: int) -> None:
        landing.Landing(df.sparkSession, path, key).put(df, [F.col("observed_at"), F.col(key)])

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def daily_counts(stream: DataFrame) -> DataFrame:
    """day, signal_type, n of an event stream, in update mode: a late event corrects its day."""
    return stream.select(F.to_date("event_at").alias("day"), F.explode("signal_types").alias("signal_type")).groupBy("day", "signal_type").agg(F.count("*").alias("n"))


def sliding_counts(stream: DataFrame, days: int = 7) -> DataFrame:
    """start, signal_type, n over windows of so many days, one starting each day."""
    w = F.window("event_at", f"{days} days", "1 day")
    return stream.select(w.alias("w"), F.explode("signal_types").alias("signal_type")).groupBy("w", "signal_type").agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("start"), "signal_type", "n")
