"""Line dedup over levelled sorted runs of line hashes, with DataFrame functions alone.

A text is split at \\n. A line's key is the line with [\\x20\\x09-\\x0D] stripped at both ends
and A-Z lower-cased; keys shorter than min_chars code points are left alone. The index holds
one row for each key ever seen, the key's two 64-bit hashes and the smallest id that has it,
in runs that are bucketed and sorted by the hashes. Documents arrive in batches in the order
of their ids. A batch's keys are aggregated and merge-joined with the runs without moving
these: keys that the runs hold belong to the older document, the others (the anti-join) are
written as a new run. When a level has `fanout` runs they are rewritten as one run of the
next level. A line stays if its key's owner is its own document.

A null or empty text is one empty line. A null id sorts after all others, and rows with null
ids count as one document. Rows that repeat an id count as the same document, so that they
don't take each other's lines; each such row is returned. A document whose lines all go keeps the empty
text. An empty table gives no rows. Other columns are neither read nor needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

KEY = ["h1", "h2"]


def line_keys(text: Column) -> Column:
    """The keys of all lines of text, in order."""
    return F.transform(F.split(C.ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1), lambda x: F.btrim(x, F.lit(C.BLANKS)))


class LineIndex:
    """Levelled runs of (h1, h2, owner), disjoint in their keys."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = 3):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> None:
        """keys: rows that no run holds, one for each key."""
        self._write(0, keys)

    def _write(self, level: int, rows: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        name = f"line_run_{level}_{uuid.uuid4().hex}"
        self.paths[name] = C.new_path(self.spark, "line-run")
        rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self.paths[name]).format("parquet").saveAsTable(name)
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            whole = None
            merged, self.levels[level] = self.levels[level], []
            for old in merged:
                t = self.spark.table(old)
                whole = t if whole is None else whole.unionByName(t)
            self._write(level + 1, whole)
            self._drop(merged)

    def _drop(self, names: list[str]) -> None:
        """Takes runs out of the catalogue and out of the shared folder."""
        for name in names:
            path = self.paths.pop(name)
            self.spark.sql(f"drop table {name}")
            C.remove(self.spark, path)

    def close(self) -> None:
        """Drops all runs: what was to be joined with them has been written."""
        for level in self.levels:
            self._drop(level)
        self.levels = [[]]

    def owners(self, batch: DataFrame) -> DataFrame:
        """batch (h1, h2, own: smallest id here, last: largest id here, n: lines) with the owner: of the runs, else of the batch."""
        found, names = batch, []
        for i, run in enumerate(self.runs()):
            name = f"_owner{i}"
            names.append(name)
            found = found.hint("merge").join(run.withColumnRenamed("owner", name), KEY, "left")
        old = F.coalesce(*names, F.lit(None).cast("long"))
        return found.select(*KEY, "own", "last", "n", old.alias("old"))


def dropped_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4, fanout: int = 3, buckets: int | None = None, common: int = 10_000) -> DataFrame:
    """id, th, gone: for each row (by id and hash of its text) that loses lines, the sorted positions of these.

    Keys with more than one in `common` of a batch's lines are broadcast; there are fewer than `common` of them.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(C.LAST_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    exploded = rows.select("id", F.xxhash64("text").alias("th"), F.posexplode(line_keys(F.col("text"))).alias("pos", "key")).filter(F.length("key") >= min_chars)
    lines = C.materialise(exploded.select("id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2")), "lines")

    index = LineIndex(spark, buckets, fanout)
    cuts = C.range_bounds(lines, "id", batches)
    gone, written = None, [lines]
    for i in range(len(cuts) + 1):
        batch = C.slice_of(lines, "id", cuts, i)
        keys = batch.groupBy(*KEY).agg(F.min("id").alias("own"), F.max("id").alias("last"), F.count("*").alias("n"))
        keys = C.materialise(index.owners(keys), "line-keys")
        written.append(keys)
        if i < len(cuts):
            index.add(keys.filter("old is null").select(*KEY, F.col("own").alias("owner")))
        # the keys that cost some line here, and the lines they cost
        contested = keys.filter("old is not null or own < last").select(*KEY, F.coalesce("old", "own").alias("owner"), "n")
        # fewer than `common` keys have so many of the batch's lines: they go to the lines, the others' lines are shuffled
        total = keys.agg(F.sum("n")).first()[0] or 0
        hot = C.materialise(contested.filter(F.col("n") * common > total).drop("n"), "common-lines")
        written.append(hot)
        rare = batch.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").join(contested.filter(F.col("n") * common <= total).drop("n").hint("merge"), KEY)
        lost = batch.join(F.broadcast(hot), KEY).unionByName(rare).filter("id > owner").select("id", "th", "pos")
        gone = lost if gone is None else gone.unionByName(lost)
    index.close()
    found = C.materialise(gone.groupBy("id", "th").agg(F.array_sort(F.collect_set("pos")).alias("gone")), "lines-gone")
    C.discard(*written)
    return found


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and text, the kept lines joined by \\n, of every row."""
    gone = dropped_lines(docs, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(C.LAST_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    joined = rows.join(gone.hint("merge"), ["id", "th"], "left")
    # one flag a line up to the last that goes: true for each of a gap's lines, false for the one that ends it
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(F.col("gone"), i - 1))
    stays = F.flatten(F.transform("gone", lambda p, i: F.array_append(F.array_repeat(F.lit(True), (p - before(i) - 1).cast("int")), F.lit(False))))
    joined = joined.select("doc_id", "text", F.coalesce(F.size("gone"), F.lit(0)).alias("n"), stays.alias("stays"))
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: F.coalesce(F.get(F.col("stays"), i), F.lit(True))), "\n")
    n_lines = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    return joined.select("doc_id", n_lines.cast("long").alias("n_lines"), F.when(F.col("n") < 0, 0).otherwise(F.col("n")).cast("long").alias("n_dropped"), F.when(F.col("n") <= 0, F.col("text")).otherwise(kept).alias("text"))
