"""Landing, reading and keying of tables: append-only, partitioned by day, visible as of a time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import time as T


def absent(batch: DataFrame, key: str, order: list[Column], target: DataFrame | None = None) -> DataFrame:
    """The rows to insert: the first of each key in the batch, if the target doesn't have the key."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    rows = batch.withColumn("_nth", first).filter("_nth = 1").drop("_nth")
    return rows if target is None else rows.join(target.select(key), key, "left_anti")


def append_absent(batch: DataFrame, path: str, key: str, order: list[Column], observed: str = "observed_at", partition: tuple[str, ...] = ("observed_day",)) -> int:
    """Lands what the table at path doesn't hold yet; the number of rows that were added."""
    rows = absent(batch, key, order, _existing(batch.sparkSession, path)).withColumn("observed_day", F.to_date(observed))
    # counted while it is written, whatever others write beside it
    added = Observation()
    rows.observe(added, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(*partition).parquet(path)
    return added.get["n"]


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    held = fs.exists(jpath) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(jpath))
    return spark.read.parquet(path) if held else None


def read(spark: SparkSession, path: str, as_of: str, days: list[str] | None = None) -> DataFrame:
    """Rows known at as_of. The day partitions after it are pruned, the rest is filtered by the instant."""
    rows = spark.read.parquet(path).filter(F.col("observed_day") <= F.lit(T.instant(as_of).date()))
    if days:
        rows = rows.filter(F.col("observed_day").isin(*days))
    return rows.filter(T.visible(F.col("observed_at"), as_of))


def known(rows: DataFrame, as_of: str, primary_only: bool = False) -> DataFrame:
    """Events known at as_of; a missing flag counts as primary."""
    found = rows.filter(T.visible(F.col("observed_at"), as_of))
    return found.filter(F.coalesce("is_cluster_primary", F.lit(True))) if primary_only else found


def archive(rows: DataFrame, path: str, partition: tuple[str, ...] = ("observed_day", "source_id")) -> None:
    """Rows as gzipped JSON lines, by day and source."""
    rows.withColumn("observed_day", F.to_date("observed_at")).write.mode("append").partitionBy(*partition).json(path, compression="gzip")


def read_archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def upsert(rows: DataFrame, path: str, key: str, version: Column) -> None:
    """A table with one row for each key, the one of the largest version.

    Every call writes a whole new folder and then publishes it by a file `_version-N` that names it, made beside and renamed. Readers take the
    largest N, so a crash before the rename leaves the table as it was.
    """
    spark = rows.sparkSession
    fs, at, versions = _versions(spark, path)
    old = latest(spark, path) if versions else None
    whole = rows if old is None else old.unionByName(rows, allowMissingColumns=True)
    nth = F.row_number().over(Window.partitionBy(key).orderBy(version.desc()))
    name = f"data-{uuid.uuid4().hex}"
    whole.withColumn("_nth", nth).filter("_nth = 1").drop("_nth").write.parquet(f"{path}/{name}")
    publish(spark, path, name, versions)


def publish(spark: SparkSession, path: str, text: str, seen: Sequence[int] | None = None) -> None:
    """Makes text the next version of the table at path; an error if another writer was first. seen: the versions that the text was made from, if not those of now."""
    fs, at, versions = _versions(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    part = hadoop(f"{path}/_part-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    to = hadoop(at, f"_version-{max(versions if seen is None else seen, default=0) + 1:012d}")
    if fs.exists(to) or not fs.rename(part, to):
        fs.delete(part, False)
        raise RuntimeError("another writer published this version first; nothing has changed")


def version_text(spark: SparkSession, path: str, version: int) -> str:
    """What a version's file says."""
    fs, at, _ = _versions(spark, path)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(at, f"_version-{version:012d}"))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published(spark: SparkSession, path: str) -> bool:
    """Whether an upsert has published the table."""
    return bool(_versions(spark, path)[2])


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last upsert published it; one that was written otherwise is read as it is."""
    fs, at, versions = _versions(spark, path)
    if not versions:
        return spark.read.parquet(path)
    name = version_text(spark, path, max(versions))
    return spark.read.parquet(f"{path}/{name}")


def _versions(spark: SparkSession, path: str) -> tuple:
    """The file system, the path in it and the numbers of the versions there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return fs, at, [int(n.removeprefix("_version-")) for n in names if n.startswith("_version-")]


def last_by_day(entries: DataFrame) -> DataFrame:
    """entries (day, key, value): the value of the last day that has the key."""
    return entries.groupBy("key").agg(F.max_by("value", "day").alias("value"))


def index_of_files(rows: DataFrame, key: str = "raw_id") -> DataFrame:
    """key and the file that holds it."""
    return rows.select(key, F.col("_metadata.file_path").alias("file"))


def with_sources(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """raw with its source's columns (src) and a status: rows of unknown sources are skipped."""
    dim = registry.select(F.col("source_id").alias("_sid"), F.struct(*registry.columns).alias("src"))
    joined = raw.join(dim, F.col("source_id") == F.col("_sid"), "left").drop("_sid")
    return joined.withColumn("status", F.when(F.col("src").isNull(), "skipped").otherwise("normalized"))


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df to be broadcast if it has no more than so many rows; else joins with it shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def registry(spark: SparkSession, rows: list[dict], enabled_only: bool = True, tiers: tuple[str, ...] = ()) -> DataFrame:
    """Sources as a table; those without a flag are enabled."""
    schema = "source_id string, name string, kind string, tier string, reliability string, publisher string, country string, categories array<string>, default_signal_types array<string>, interval_minutes int, enabled boolean"
    df = spark.createDataFrame([{k: r.get(k) for k in [c.split()[0] for c in schema.split(", ")]} for r in rows], schema)
    if enabled_only:
        df = df.filter(F.coalesce("enabled", F.lit(True)))
    return df.filter(F.col("tier").isin(*tiers)) if tiers else df
