"""Clusters carried from run to run."""

import pytest
from pyspark.sql import functions as F
from tidemark.operators import dedup
from tidemark.streaming import clusters

COLUMNS = "event_date date, observed_at timestamp, raw_id string, source_id string, canonical_url string, content_hash string, event_key string, tokens array<string>"
STORY = [f"word{i}" for i in range(10)]


def rows(spark, made):
    text = [(d, f"2026-01-0{(d or DAY)[-1]}T{t}:00Z", r, s, u, h, k, w) for d, t, r, s, u, h, k, w in made]
    return spark.createDataFrame(text, "event_date string, observed_at string, raw_id string, source_id string, canonical_url string, content_hash string, event_key string, tokens array<string>").select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in COLUMNS.split(", ")])


DAY = "2026-01-01"
BATCHES = [
    [
        (DAY, "01:00", "r1", "a", "u1", "h1", "k1", STORY), (DAY, "01:01", "r2", "a", "u2", "h1", "k1", STORY), (DAY, "01:02", "r3", "b", "u3", "h3", "k3", [*STORY[:8], "x1"]),
        ("2026-01-02", "01:00", "r4", "a", "u4", "h1", "k1", STORY), (None, "01:03", "rx", "a", "u9", "h9", "k9", None),
    ],
    [(DAY, "02:00", "r5", "c", "u1", "h5", "k5", None), (DAY, "02:01", "r6", "a", "u6", "h1", "k6", ["z"]), (DAY, "02:02", "r7", "d", None, "h7", "k3", [])],
    [("2026-01-02", "03:00", "r8", "b", "u8", "h8", "k8", [*STORY, "more"]), (DAY, "03:01", "r9", "a", "", "h10", "k10", ["x1", *STORY[2:]]), (DAY, "03:02", "r10", "b", "", "h11", "k11", ["q"])],
]


@pytest.mark.parametrize("methods", [dedup.METHODS, ("canonical_url", "content_hash")])
def test_three_runs_give_the_clusters_of_one(spark, tmp_path, methods):
    arriving, found, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for batch in BATCHES:
        rows(spark, batch).write.mode("append").parquet(arriving)
        clusters.follow(spark.readStream.schema(COLUMNS).parquet(arriving), found, state, methods).awaitTermination()
    got = {r.raw_id: (r.cluster_id, r.is_cluster_primary, r.method, r.similarity, r.duplicate_of) for r in spark.read.parquet(found).collect()}
    whole = rows(spark, [r for b in BATCHES for r in b if r[0]]).collect()
    want = {}
    for day in {r.event_date for r in whole}:
        of = dedup.pd.DataFrame([r.asDict() for r in whole if r.event_date == day])
        for r in dedup.Day(dedup.frequencies(of), methods=methods).put_all(of).itertuples():
            want[r.raw_id] = (r.cluster_id, r.is_cluster_primary, r.method, r.similarity, r.duplicate_of)
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}
    assert len({v[0] for v in got.values()}) == len({v[0] for v in want.values()})
    if methods == dedup.METHODS:
        assert got["r5"][2:] == ("canonical_url", 1.0, "r1") and got["r6"][2:] == ("content_hash", 1.0, "r1") and got["r8"][4] == "r4" and got["r9"][2] == "token_similarity"
        assert got["r7"][2:] == ("event_key", 1.0, None) or got["r7"][4] == "r1"


def test_a_late_day_goes_on_where_it_was_left(spark, tmp_path):
    arriving, found, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for batch in ([(DAY, "01:00", "r1", "a", "u1", "h1", "k1", [])], [("2026-01-05", "01:00", "r2", "a", "u2", "h1", "k1", [])], [(DAY, "09:00", "r3", "b", "u3", "h1", "k3", [])]):
        rows(spark, batch).write.mode("append").parquet(arriving)
        clusters.follow(spark.readStream.schema(COLUMNS).parquet(arriving), found, state).awaitTermination()
    assert {r.raw_id: r.duplicate_of for r in spark.read.parquet(found).collect()} == {"r1": None, "r2": None, "r3": "r1"}


class _Map:
    """Stands in for a map of a day's state and counts what is asked of it."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def iterator(self):
        return iter(list(self.held.items()))

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.held[key] = value


def test_a_large_batch_asks_the_state_by_entry_and_not_by_key(monkeypatch):
    monkeypatch.setattr(clusters, "BUCKETS", 16, raising=False)
    maps = {"clusters": _Map(), "keys": _Map()}
    handle = type("Handle", (), {"getMapState": lambda self, name, k, v: maps[name]})()
    made = [(f"r{i:04}", f"s{i % 3}", i, f"u{i}", f"h{i % 700}", None, []) for i in range(1000)]
    whole = dedup.pd.DataFrame(made, columns=["raw_id", "source_id", "observed_at", "canonical_url", "content_hash", "event_key", "tokens"])
    got = []
    for part in (whole[:600], whole[600:]):
        day = clusters.DayClusters(("canonical_url", "content_hash"))
        day.init(handle)
        got += list(day.handleInputRows(None, iter([part]), None))
    want = dedup.Day(dedup.frequencies(whole), methods=("canonical_url", "content_hash")).put_all(whole)
    assert dedup.pd.concat(got, ignore_index=True).equals(want)
    assert maps["keys"].calls <= 2 * 2 * 16 and maps["clusters"].calls <= 2 * (1000 // clusters.CHUNK + 2)
