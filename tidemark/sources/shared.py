"""The folder that driver and executors share, for what runs leave to one another."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession, tag: str) -> str:
    """A new path under spark.checkpoint.dir. A local session without that setting gets a folder of its own; a cluster is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def kept(df: DataFrame, tag: str, *, keep_exchanged: bool = True) -> DataFrame:
    """df as a table in a new shared folder: computed once, however often it is read. keep_exchanged: else what was exchanged on the way is removed from the executors' disks at once."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = folder(df.sparkSession, tag), conf.get(name)
    try:
        if not keep_exchanged:
            conf.set(name, "true")
        df.write.parquet(path)
    finally:
        conf.set(name, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes kept tables that nothing still to be computed reads."""
    for df in tables:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._tidemark_path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def once(rows: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """keep and new columns of rows. The plan computes each once: as they come from a generator, neither filters nor later columns repeat them."""
    return rows.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
