"""Tables with history."""

import os

import pytest
from tidemark.sources import history, tables

SCHEMA = "id string, v int, x string"


def rows(spark, made):
    return spark.createDataFrame(made, SCHEMA)


def at(day):
    return f"2026-01-{day:02d}T00:00:00Z"


def seen(table, as_of=None):
    return {r.id: (r.v, str(r.valid_from)[:10], None if r.valid_to is None else str(r.valid_to)[:10]) for r in table.read(as_of).collect()}


def test_reads_as_of_any_time(spark, tmp_path):
    t = history.History(spark, str(tmp_path / "t"), "id", buckets=3)
    with pytest.raises(ValueError, match="nothing"):
        t.read()
    assert t.put(rows(spark, [("a", 1, "x"), ("b", 1, None), (None, 9, "no key")]), at(1))
    assert t.put(rows(spark, [("a", 2, "x"), ("b", 1, None), ("c", 1, ""), ("c", 2, "y")]), at(3))
    assert not t.put(rows(spark, [("a", 2, "x")]), at(4))
    assert t.put(rows(spark, [("a", 1, "x"), ("b", 1, "z")]), at(5))
    day = lambda n: f"2026-01-{n:02d}"
    assert seen(t, at(1)) == {"a": (1, day(1), day(3)), "b": (1, day(1), day(5))}
    assert seen(t, at(2)) == seen(t, at(1)) and seen(t, "2025-12-31T00:00:00Z") == {}
    assert seen(t, at(4)) == {"a": (2, day(3), day(5)), "b": (1, day(1), day(5)), "c": (2, day(3), None)}
    assert seen(t) == seen(t, at(9)) == {"a": (1, day(5), None), "b": (1, day(5), None), "c": (2, day(3), None)}
    with pytest.raises(ValueError, match="already holds"):
        t.put(rows(spark, [("a", 7, "x")]), at(4))
    with pytest.raises(ValueError, match="other columns"):
        t.put(spark.createDataFrame([("a", 1)], "id string, w int"), at(6))
    assert t.versions().count() == 6


def test_only_touched_buckets_are_rewritten_and_old_folders_go(spark, tmp_path):
    path = str(tmp_path / "t")
    t = history.History(spark, path, "id", buckets=8)
    t.put(rows(spark, [(f"k{i}", 0, "") for i in range(40)]), at(1))
    first = t.manifest()["open"]
    t.put(rows(spark, [("k7", 1, "")]), at(2))
    second = t.manifest()["open"]
    assert sum(first[b] != second[b] for b in first) == 1
    # a writer that dies before it publishes changes nothing, and is swept up
    rows(spark, [("dead", 1, "")]).write.parquet(f"{path}/open-dead/_bucket=0")
    assert t.read().count() == 40
    t.put(rows(spark, [("k7", 2, "")]), at(3))
    held = len(os.listdir(path))
    assert t.vacuum() > 0 and len(os.listdir(path)) < held
    assert (t.read().count(), t.read(at(1)).count(), t.versions().count()) == (40, 40, 42)
    t.vacuum(before=at(2))
    assert t.versions().count() == 41 and seen(t, at(2))["k7"][0] == 1
    with pytest.raises(ValueError, match="was removed"):
        t.read(at(1))


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark, path, "{}")
    with pytest.raises(RuntimeError, match="another writer"):
        tables.publish(spark, path, "{}", seen=[])


def test_a_put_computes_its_rows_once(spark, tmp_path):
    """However often a put looks at its rows, they are computed once; equal rows, changed ones, new ones and those that aren't put come out by themselves."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    table = history.History(spark, str(tmp_path / "h"), "k")
    put = lambda rows, at: table.put(spark.createDataFrame(rows, "k string, v long").coalesce(1).mapInPandas(counted, "k string, v long"), at)
    assert put([("a", 1), ("b", 2), ("c", None)], "2026-01-01T00:00:00Z")
    assert put([("a", 1), ("b", 3), ("c", None), ("d", 4), (None, 5)], "2026-01-02T00:00:00Z")
    assert not put([("a", 1), ("d", 4)], "2026-01-03T00:00:00Z")
    assert seen.value == 3 + 5 + 2
    assert sorted((r.k, r.v, r.valid_from.day) for r in table.read().collect()) == [("a", 1, 1), ("b", 3, 2), ("c", None, 1), ("d", 4, 2)]
    assert sorted((r.k, r.v) for r in table.read("2026-01-01T12:00:00Z").collect()) == [("a", 1), ("b", 2), ("c", None)]
