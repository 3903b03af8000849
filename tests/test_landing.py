"""Landing by an index of keys."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F
from tidemark.sources import landing, tables
from tidemark.streaming import increment

SCHEMA = "raw_id string, observed_at timestamp, v int"


def rows(spark, keys, v=0):
    return spark.createDataFrame([(k, f"2026-01-0{1 + i % 3} 00:00:00", v) for i, k in enumerate(keys)], "raw_id string, observed_at string, v int").withColumn("observed_at", F.col("observed_at").cast("timestamp"))


def test_lands_what_is_not_there(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FAN", 3)
    rng, path = random.Random(2), str(tmp_path / "t")
    t = landing.Landing(spark, path, buckets=5)
    with pytest.raises(ValueError, match="nothing"):
        t.read()
    want: dict[str, int] = {}
    for batch in range(8):
        keys = [f"k{rng.randrange(400)}" for _ in range(rng.choice([1, 60, 150]))] + [None, ""]
        new = set(keys) - {None} - set(want)
        assert t.put(rows(spark, keys, batch), [F.col("v")]) == len(new)
        want |= dict.fromkeys(new, batch)
        assert t.put(rows(spark, keys, 99), [F.col("v")]) == 0
    assert {r.raw_id: r.v for r in t.read().collect()} == want and t.read().count() == len(want)
    levels = [r["level"] for r in t.manifest()["runs"]]
    assert max(levels) >= 1 and all(levels.count(x) < 3 for x in levels)
    assert sum(r["rows"] for r in t.manifest()["runs"]) == len(want)
    assert sorted(os.listdir(f"{path}/keys")) == sorted(r["name"] for r in t.manifest()["runs"])
    assert {str(r.observed_day) for r in t.read().select("observed_day").distinct().collect()} == {"2026-01-01", "2026-01-02", "2026-01-03"}


def test_reads_what_the_batch_calls_for(spark, tmp_path):
    t = landing.Landing(spark, str(tmp_path / "t"), buckets=32)
    t.put(rows(spark, [f"k{i}" for i in range(2000)]), [F.col("v")])
    held = t.manifest()
    place = lambda keys: t._placed(rows(spark, keys), 32).select("raw_id", "_h", "bucket")
    one = place(["k7"])
    bucket = one.first().bucket
    pruned = lambda df: re.findall(r"PartitionFilters: \[([^]]*)\]", df._jdf.queryExecution().executedPlan().toString())
    of_bucket = lambda filters: any(re.search(rf"bucket#\d+ (?:= |IN \(){bucket}\b", f) for f in filters)
    # filters, then keys, are read of the key's bucket alone
    assert of_bucket(pruned(t.claims(one, held)))
    t.claims(one, held).write.parquet(str(tmp_path / "c"))
    known = t.present(spark.read.parquet(str(tmp_path / "c")))
    assert [r.raw_id for r in known.collect()] == ["k7"] and of_bucket(pruned(known))
    # of new keys few are claimed, so few keys are read
    assert t.claims(place([f"new{i}" for i in range(1000)]), held).count() < 60
    assert t.claims(place([f"k{i}" for i in range(0, 2000, 2)]), held).count() == 1000


def test_two_writers_and_a_crash(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    t = landing.Landing(spark, path, buckets=3)
    t.put(rows(spark, ["a"]), [F.col("v")])
    real = tables.publish
    monkeypatch.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        t.put(rows(spark, ["b"]), [F.col("v")])
    monkeypatch.setattr(tables, "publish", real)
    assert t.read().count() == 1 and t.put(rows(spark, ["a", "b"]), [F.col("v")]) == 1
    monkeypatch.setattr(tables, "_versions", lambda s, p, real=tables._versions: (*real(s, p)[:2], real(s, p)[2][:-1]))
    with pytest.raises(RuntimeError, match="another writer"):
        t.put(rows(spark, ["c"]), [F.col("v")])


def test_streams_land_once(spark, tmp_path):
    rows(spark, ["a", "b", "a"]).write.parquet(str(tmp_path / "in"))
    for n in ("1", "2"):
        increment.land_indexed(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / f"ck{n}")).awaitTermination()
    assert sorted(r.raw_id for r in landing.Landing(spark, str(tmp_path / "t")).read().collect()) == ["a", "b"]
