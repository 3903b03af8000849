"""Tables that keep their history: every version of a row with the time from which and until which it held.

Current rows lie in buckets by key, so a put rewrites the buckets that it touches and leaves the others where they are. The versions that it
ends go to a folder of their own, named with the time at which they ended, so a read as of a time opens only what was ended later. Which folders make up the
table is told by a manifest, written beside and renamed: a crash before that leaves the table as it was, and two writers can't publish the same version.
vacuum removes folders that no kept manifest names, and history that ended before a given time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from tidemark.functions import time as T
from tidemark.sources import shared, tables


class History:
    """A table at path with one current row a key. buckets is settled by the first put."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path, [key] if isinstance(key, str) else list(key), buckets

    def manifest(self) -> dict | None:
        versions = tables._versions(self.spark, self.path)[2]
        return json.loads(tables.version_text(self.spark, self.path, max(versions))) if versions else None

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int")

    def _read(self, folders: Sequence[str], schema: types.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def put(self, rows: DataFrame, at: str) -> bool:
        """Makes rows the current ones of their keys from `at` on; whether any differed. Equal rows get no new version, rows without a key are left out. Of rows with the same key the one greatest as JSON stands. Time runs forward: an earlier `at` than the last is refused."""
        seen = tables._versions(self.spark, self.path)[2]
        old = self.manifest()
        now = T.instant(at).isoformat()
        if old and now < old["at"]:
            raise ValueError(f"the table already holds versions of {old['at']}")
        n = old["buckets"] if old else self.buckets
        text = F.to_json(F.struct(*rows.columns))
        best = F.row_number().over(Window.partitionBy(*self.key).orderBy(text.desc()))
        # rows are computed once: what follows reads them from a table
        new = shared.kept(rows.dropna(subset=self.key).withColumn("_nth", best).filter("_nth = 1").drop("_nth").withColumn("_bucket", self._bucket(n)), "history-new")
        # at most as many as there are buckets
        touched = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())
        schema = types.StructType([*rows.schema.fields, types.StructField("valid_from", types.TimestampType())])
        if old and types.StructType.fromJson(old["schema"]).fieldNames() != rows.schema.fieldNames():
            raise ValueError("the table has other columns")
        held = self._read([old["open"][str(b)] for b in touched if str(b) in old["open"]] if old else [], schema)
        name = uuid.uuid4().hex
        # one join tells of each key what it was and what it is; a version is written with whether it is open, and new
        whole = [*rows.columns, "valid_from"]
        then, now_ = F.struct(*whole), F.struct(*rows.columns, F.lit(T.instant(at)).alias("valid_from"))
        pairs = new.select(*self.key, now_.alias("_now")).join(held.select(*self.key, then.alias("_then")), self.key, "full")
        as_text = lambda side: F.to_json(F.struct(*[F.col(side)[c].alias(c) for c in rows.columns]))
        same = F.col("_now").isNotNull() & F.col("_then").isNotNull() & (as_text("_now") == as_text("_then"))
        stays = F.col("_then").isNotNull() & (F.col("_now").isNull() | same)
        version = lambda when, row, is_open, is_new: F.when(when, F.struct(F.col(row).alias("row"), F.lit(is_open).alias("open"), F.lit(is_new).alias("new")))
        made_of = F.array_compact(F.array(version(stays, "_then", True, False), version(F.col("_now").isNotNull() & ~same, "_now", True, True), version(F.col("_then").isNotNull() & ~stays, "_then", False, False)))
        versions = pairs.select(F.inline(made_of)).select("row.*", "open", "new")
        if old:
            versions = shared.kept(versions, "history-put")
            if versions.filter("new").isEmpty():
                return False
        versions.filter("open").select(*whole).withColumn("_bucket", self._bucket(n)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/open-{name}")
        versions.filter("not open").select(*whole).withColumn("valid_to", T.at(at)).write.parquet(f"{self.path}/closed-{name}")
        made = {"at": now, "buckets": n, "schema": rows.schema.jsonValue(), "open": {**(old["open"] if old else {}), **{str(b): f"open-{name}/_bucket={b}" for b in touched}}, "closed": [*(old["closed"] if old else []), {"folder": f"closed-{name}", "at": now}], "since": old["since"] if old else None}
        self._publish(made, seen)
        return True

    def _publish(self, manifest: dict, seen: Sequence[int] | None = None) -> None:
        tables.publish(self.spark, self.path, json.dumps(manifest), seen)

    def read(self, as_of: str | None = None) -> DataFrame:
        """The rows that held at as_of (now, if none), with valid_from and valid_to."""
        found = self.manifest()
        if not found:
            raise ValueError(f"nothing was put into {self.path}")
        schema = types.StructType([*types.StructType.fromJson(found["schema"]).fields, types.StructField("valid_from", types.TimestampType())])
        rows = self._read(sorted(found["open"].values()), schema).withColumn("valid_to", F.lit(None).cast("timestamp"))
        if as_of is None:
            return rows
        t = T.instant(as_of).isoformat()
        if found["since"] and t < found["since"]:
            raise ValueError(f"history before {found['since']} was removed")
        later = [c["folder"] for c in found["closed"] if c["at"] > t]
        past = self._read(later, types.StructType([*schema.fields, types.StructField("valid_to", types.TimestampType())]))
        return rows.unionByName(past).filter((F.col("valid_from") <= T.at(as_of)) & (F.col("valid_to").isNull() | (F.col("valid_to") > T.at(as_of))))

    def versions(self) -> DataFrame:
        """All versions that are still held."""
        found = self.manifest()
        schema = types.StructType([*types.StructType.fromJson(found["schema"]).fields, types.StructField("valid_from", types.TimestampType()), types.StructField("valid_to", types.TimestampType())])
        return self._read(sorted(found["open"].values()), schema).unionByName(self._read([c["folder"] for c in found["closed"]], schema))

    def vacuum(self, keep: int = 1, before: str | None = None) -> int:
        """Forgets what ended by `before`, then removes all manifests but the last `keep` and the folders that none of these names; the number of folders."""
        found = self.manifest()
        if found and before:
            t = T.instant(before).isoformat()
            self._publish({**found, "closed": [c for c in found["closed"] if c["at"] > t], "since": max(t, found["since"] or t)})
        fs, at, versions = tables._versions(self.spark, self.path)
        last = sorted(versions)[-keep:]
        named = set()
        for v in last:
            m = json.loads(tables.version_text(self.spark, self.path, v))
            named |= {x.split("/")[0] for x in m["open"].values()} | set(m["open"].values()) | {c["folder"] for c in m["closed"]}
        gone = 0
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        for v in sorted(versions)[:-keep]:
            fs.delete(hadoop(at, f"_version-{v:012d}"), False)
        for f in list(fs.listStatus(at)):
            name = f.getPath().getName()
            if name.startswith(("open-", "closed-")) and name not in named:
                fs.delete(f.getPath(), True)
                gone += 1
            elif name.startswith("open-"):
                for b in list(fs.listStatus(f.getPath())):
                    inner = b.getPath().getName()
                    if inner.startswith("_bucket=") and f"{name}/{inner}" not in named:
                        fs.delete(b.getPath(), True)
                        gone += 1
        return gone
