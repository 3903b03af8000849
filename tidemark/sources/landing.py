"""Landing what isn't there yet by an index of keys: runs of keys in buckets, each with Bloom filters.

A batch is put against filters before it is put against keys: of each run only the filters of the buckets that the batch's keys fall into are
read, a page of 512 bits for each key, and keys only in those buckets of a run that a filter claims. A key that no filter claims is new for
sure, so a batch of new keys reads no keys at all, and what a batch reads grows with the batch and not with the table, as long as buckets are
many enough. A batch's keys become a run; eight runs of a level are merged into one of the next, so there are few. Which runs and
documents make up the table is told by a manifest that is renamed into place: a batch lands whole or not at all, a batch that is repeated lands
nothing, and of two writers at the same time one is refused and tries again.

Keys are compared themselves, hashes only choose buckets and bits. Rows without a key are left out.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types

from tidemark.sources import tables

#: Bits of a page, the longs that hold them, bits set by a key, and keys a page is made for.
PAGE, LONGS, PROBES, KEYS_A_PAGE = 512, 8, 4, 48
#: Runs of a level that are merged.
FAN = 8


def _bits(h: Column) -> list[Column]:
    """The places in a page that a key sets."""
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(PAGE)) for i in range(PROBES)]


class Landing:
    """The documents at path, once each by key. buckets is settled by the first batch."""

    def __init__(self, spark: SparkSession, path: str, key: str = "raw_id", observed: str = "observed_at", buckets: int = 64):
        self.spark, self.path, self.key, self.observed, self.buckets = spark, path, key, observed, buckets

    def manifest(self) -> dict:
        versions = tables._versions(self.spark, self.path)[2]
        return json.loads(tables.version_text(self.spark, self.path, max(versions))) if versions else {"buckets": self.buckets, "runs": [], "data": [], "schema": None}

    def _placed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn("_h", F.xxhash64(self.key)).withColumn("bucket", F.pmod("_h", F.lit(buckets)).cast("int"))

    @staticmethod
    def _page(pages: int) -> Column:
        return F.pmod(F.shiftrightunsigned("_h", 20), F.lit(pages)).cast("long")

    def claims(self, batch: DataFrame, manifest: dict) -> DataFrame | None:
        """key, run, bucket wherever a filter says that a run may hold a key of the batch (key, _h, bucket)."""
        touched = [r.bucket for r in batch.select("bucket").distinct().collect()]  # at most as many as there are buckets
        found = None
        for run in manifest["runs"]:
            pages = self.spark.read.schema(f"page long, {', '.join(f'w{i} long' for i in range(LONGS))}, bucket int").parquet(f"{self.path}/filters/{run['name']}").filter(F.col("bucket").isin(touched))
            words = F.array(*[f"w{i}" for i in range(LONGS)])
            held = [F.get(words, F.floor(b / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (b % 64).cast("int"))) != 0 for b in _bits(F.col("_h"))]
            maybe = held[0]
            for x in held[1:]:
                maybe = maybe & x
            here = batch.withColumn("page", self._page(run["pages"])).join(pages, ["bucket", "page"]).filter(maybe).select(self.key, F.lit(run["name"]).alias("run"), "bucket")
            found = here if found is None else found.unionByName(here)
        return found

    def present(self, claims: DataFrame) -> DataFrame:
        """The keys of claims (written) that are there: looked up in the buckets of the runs that claim any."""
        where: dict[str, list[int]] = {}
        for r in claims.select("run", "bucket").distinct().collect():  # at most runs times buckets
            where.setdefault(r.run, []).append(r.bucket)
        found = self.spark.createDataFrame([], claims.select(self.key).schema)
        for run, buckets in sorted(where.items()):
            keys = self._keys(run, claims.schema[self.key].dataType.simpleString()).filter(F.col("bucket").isin(buckets))
            found = found.unionByName(claims.filter(F.col("run") == run).select(self.key, "bucket").join(keys, [self.key, "bucket"], "left_semi").select(self.key))
        return found

    def _keys(self, run: str, kind: str = "string") -> DataFrame:
        return self.spark.read.schema(f"`{self.key}` {kind}, bucket int").parquet(f"{self.path}/keys/{run}")

    def _write_run(self, keys: DataFrame, n: int, level: int, buckets: int) -> dict:
        """Writes keys (key) and their filters as a run."""
        name, pages = uuid.uuid4().hex, max(1, -(-n // (buckets * KEYS_A_PAGE)))
        placed = self._placed(keys, buckets)
        placed.select(self.key, "bucket").repartition("bucket").sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(f"{self.path}/keys/{name}")
        at = F.explode(F.array(*_bits(F.col("_h")))).alias("at")
        bits = placed.select("bucket", self._page(pages).alias("page"), at)
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
        words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("at") / 64) == i, one)), F.lit(0).cast("long")).alias(f"w{i}") for i in range(LONGS)]
        bits.groupBy("bucket", "page").agg(*words).repartition("bucket").sortWithinPartitions("bucket", "page").write.partitionBy("bucket").parquet(f"{self.path}/filters/{name}")
        return {"name": name, "rows": n, "level": level, "pages": pages}

    def put(self, batch: DataFrame, order: list[Column]) -> int:
        """Lands the rows whose key isn't there, of each key the first by order; their number."""
        seen = tables._versions(self.spark, self.path)[2]
        held = self.manifest()
        first = self._placed(tables.absent(batch.filter(F.col(self.key).isNotNull()), self.key, order), held["buckets"])
        claims = self.claims(first.select(self.key, "_h", "bucket"), held)
        rows = first
        if claims is not None:
            folder = f"{self.path}/tmp/claims-{uuid.uuid4().hex}"
            claims.write.parquet(folder)
            rows = first.join(self.present(self.spark.read.schema(claims.schema).parquet(folder)).distinct(), self.key, "left_anti")
        name, added = uuid.uuid4().hex, Observation()
        schema = batch.schema
        rows.select(*batch.columns, F.to_date(self.observed).alias("observed_day")).observe(added, F.count(F.lit(1)).alias("n")).write.partitionBy("observed_day").parquet(f"{self.path}/data/run={name}")
        n = added.get["n"]
        if claims is not None:
            self._remove(folder)
        if not n:
            self._remove(f"{self.path}/data/run={name}")
            return 0
        landed = self.spark.read.schema(schema).parquet(f"{self.path}/data/run={name}").select(self.key)
        runs = [*held["runs"], self._write_run(landed, n, 0, held["buckets"])]
        runs, spent = self._merged(runs, held["buckets"], schema[self.key].dataType.simpleString())
        tables.publish(self.spark, self.path, json.dumps({"buckets": held["buckets"], "runs": runs, "data": [*held["data"], name], "schema": held["schema"] or schema.jsonValue()}), seen)
        for run in spent:
            self._remove(f"{self.path}/keys/{run}")
            self._remove(f"{self.path}/filters/{run}")
        return n

    def _merged(self, runs: list[dict], buckets: int, kind: str) -> tuple[list[dict], list[str]]:
        """runs, those of a level that has enough of them as one of the next, and the names of those that went into others."""
        level, spent = 0, []
        while any(r["level"] >= level for r in runs):
            mine = [r for r in runs if r["level"] == level]
            if len(mine) >= FAN:
                keys = None
                for r in mine:
                    more = self._keys(r["name"], kind).select(self.key)
                    keys = more if keys is None else keys.unionByName(more)
                spent += [r["name"] for r in mine]
                runs = [*(r for r in runs if r["level"] != level), self._write_run(keys, sum(r["rows"] for r in mine), level + 1, buckets)]
            level += 1
        return runs, spent

    def _remove(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def read(self) -> DataFrame:
        """All documents that have landed, with observed_day, by which they are partitioned."""
        found = self.manifest()
        if not found["data"]:
            raise ValueError(f"nothing has landed at {self.path}")
        schema = types.StructType([*types.StructType.fromJson(found["schema"]).fields, types.StructField("observed_day", types.DateType()), types.StructField("run", types.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/run={n}" for n in found["data"]]).drop("run")
