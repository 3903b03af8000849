"""What the operators share: white space and words, checksums of folds, shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows whose id is null sort after all others.
LAST_ID = 9223372036854775807
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset a local session, all of whose tasks run in the driver, gets one of its own; a cluster is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, *, keep_exchanged: bool = True, **options: object) -> DataFrame:
    """df as a table in the shared folder: computed once, and still there when executors are lost. keep_exchanged: else what was exchanged on the way is removed from the executors' disks at once."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = new_path(df.sparkSession, tag), conf.get(name)
    try:
        if not keep_exchanged:
            conf.set(name, "true")
        df.write.options(**options).parquet(path)
    finally:
        conf.set(name, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes materialised tables that nothing still to be computed reads."""
    for df in tables:
        remove(df.sparkSession, df._tidemark_path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder in the shared one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def one_space(text: Column) -> Column:
    """Every run of [\\x20\\x09-\\x0D] as one space; null as empty. Only texts with doubled spaces pay for a regular expression."""
    flat = F.coalesce(text, F.lit(""))
    for c in BLANKS[1:]:
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    return F.when(F.instr(flat, "  ") > 0, F.regexp_replace(flat, " {2,}", " ")).otherwise(flat)


def count_words(text: Column) -> Column:
    """The number of [^\\x20\\x09-\\x0D]+ in text; 0 for null."""
    flat = F.btrim(one_space(text), F.lit(" "))
    gaps = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(flat == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def range_bounds(df: DataFrame, col: str, parts: int) -> list[int]:
    """parts - 1 cut points of a long column, about equal in rows; fewer where values repeat."""
    if parts < 2:
        return []
    q = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(col, q, 10000)).first()[0] or []
    return sorted(set(found))


def slice_of(df: DataFrame, col: str, cuts: list[int], i: int) -> DataFrame:
    """The rows above cut i - 1 and not above cut i. Nulls belong to the last slice."""
    c, keep = F.col(col), F.lit(True)
    if i > 0:
        keep = c > cuts[i - 1]
    if i < len(cuts):
        keep = keep & (c <= cuts[i])
    return df.filter(keep | c.isNull()) if i == len(cuts) else df.filter(keep)


def data_file(path: str | None, name: str) -> str:
    """A vocabulary file: path if given, else from the installed public tokenizers."""
    if path:
        return path
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path(name))
