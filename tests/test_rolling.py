"""Windows that are moved on day by day against windows counted anew."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F
from tidemark.functions import time as T
from tidemark.operators import signals
from tidemark.streaming import rolling

SCHEMA = "topic string, signal_types array<string>, event_id string, event_at string, batch int"
FIRST = date(2026, 1, 1)


def events(spark, n=600, batches=12):
    """Events of some weeks; each arrives in the batch of its day, or up to a week late, or before its day."""
    rng, rows = random.Random(5), []
    for i in range(n):
        day = rng.randrange(batches)
        types = rng.choice([["a"], ["b"], ["a", "b"], [], None])
        rows.append((rng.choice("xyz"), types, f"e{i}", None if i % 50 == 0 else f"{FIRST + timedelta(days=day)}T0{i % 10}:00:00Z", max(0, min(batches - 1, day + rng.choice([0, 0, 0, 1, 7, -2])))))
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_at", F.col("event_at").cast("timestamp"))


def rows_of(df):
    return sorted((r.topic, r.signal_type, r["count"], r.baseline_count, r.delta_ratio, r.rising) for r in df.select("topic", "signal_type", "count", "baseline_count", "delta_ratio", "rising").collect())


def anew(rows, end):
    return rows_of(signals.type_counts(rows, T.Window.ending(end, 2, 3)))


def test_every_day_like_the_whole_count(spark, tmp_path):
    rows = events(spark).persist()
    kept = rolling.Rolling(spark, str(tmp_path / "w"), days=2, multiplier=3)
    for day in range(0, 12, 2):
        kept.add(rows.filter(F.col("batch").isin(day, day + 1)), day)
        end = FIRST + timedelta(days=day + 1)
        kept.advance(end)
        assert rows_of(kept.counts()) == anew(rows.filter(F.col("batch") <= day + 1), end)
    # a batch that is added again, a run that is repeated, and a window that is moved back
    kept.add(rows.filter(F.col("batch").isin(10, 11)), 10)
    for end in (FIRST + timedelta(days=11), FIRST + timedelta(days=3), FIRST + timedelta(days=200), FIRST + timedelta(days=9)):
        kept.advance(end)
        assert rows_of(kept.counts()) == anew(rows, end)
    rows.unpersist()


def test_follows_a_stream(spark, tmp_path):
    rows = events(spark, 60, 4)
    rows.write.parquet(str(tmp_path / "in"))
    kept = rolling.Rolling(spark, str(tmp_path / "w"), days=2, multiplier=3)
    kept.follow(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), str(tmp_path / "ck")).awaitTermination()
    kept.advance(FIRST + timedelta(days=3))
    assert rows_of(kept.counts()) == anew(rows, FIRST + timedelta(days=3))
