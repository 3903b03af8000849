"""Exact dedup by a log-structured merge index over text digests.

Documents arrive in batches. Each batch is a memtable: its digests are aggregated and
flushed as a level-0 run, sorted within segments of the digest space, each segment with a
Bloom filter. When a level holds `fanout` runs they are compacted into one run of the next
level, which keeps the smallest identifier and the sum of the counts. Resolving the index
asks the filters of the other runs first; only digests that some other run may hold are
merged. Every hit is then compared byte by byte with the text it is said to equal; digests
under which texts differ are grouped again by their texts.

Texts are equal when identical after each run of [\\x20\\x09-\\x0D] becomes one space; a
null text counts as empty. The smallest id of a group stays; a null id sorts last. Rows
that repeat the same id and text are one document given more than once: all count in
group_size and only one of them is kept. An empty table gives no rows. Columns other than
id and text are neither read nor needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

RUN = "seg long, n long, digests binary, ids binary, counts binary, filter binary"
WIDTH = 32
BITS_PER_KEY, PROBES = 12, 6
COPIES_PER_SALT = 256


def _filter_bits(digests: np.ndarray, n_bits: int) -> np.ndarray:
    """Positions (n, PROBES) by double hashing of two words of each digest."""
    words = digests.view("<u8").reshape(len(digests), WIDTH // 8)
    step = words[:, 1] | np.uint64(1)
    return (words[:, :1] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(n_bits)


def _make_filter(digests: np.ndarray) -> bytes:
    n_bits = max(64, (len(digests) * BITS_PER_KEY + 63) // 64 * 64)
    bits = np.zeros(n_bits, dtype=bool)
    bits[_filter_bits(digests, n_bits).ravel()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _may_hold(filter_: bytes, digests: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(filter_, dtype=np.uint8), bitorder="little")
    return bits[_filter_bits(digests, len(bits))].all(axis=1)


def _merge(digests: np.ndarray, ids: np.ndarray, counts: np.ndarray):
    """Sorted distinct digests with the smallest id and the summed count of each."""
    keys = np.ascontiguousarray(digests).view(f"S{WIDTH}").ravel()
    # S strings drop trailing zero bytes when compared, so order by the four big-endian words instead
    words = digests.view(">u8").reshape(len(digests), WIDTH // 8).astype(np.uint64)
    order = np.lexsort((ids, words[:, 3], words[:, 2], words[:, 1], words[:, 0]))
    words, ids, counts = words[order], ids[order], counts[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (words[1:] != words[:-1]).any(axis=1)
    starts = np.flatnonzero(first)
    return digests[order][starts], ids[starts], np.add.reduceat(counts, starts)


def _run_row(seg: int, digests: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> pa.Table:
    return pa.table({
        "seg": pa.array([seg], pa.int64()), "n": pa.array([len(ids)], pa.int64()),
        "digests": pa.array([digests.tobytes()], pa.binary()), "ids": pa.array([ids.tobytes()], pa.binary()),
        "counts": pa.array([counts.tobytes()], pa.binary()), "filter": pa.array([_make_filter(digests)], pa.binary()),
    })


def _digest_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)


def _flush(table: pa.Table) -> pa.Table:
    """A memtable's segment as one sorted run segment."""
    parts = _merge(_digest_array(table["digest"]), table["id"].to_numpy().astype("<i8"), table["copies"].to_numpy().astype("<i8"))
    return _run_row(table["seg"][0].as_py(), *parts)


def _segments(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    return [
        (np.frombuffer(d, dtype=np.uint8).reshape(-1, WIDTH), np.frombuffer(i, dtype="<i8"), np.frombuffer(c, dtype="<i8"), f)
        for d, i, c, f in zip(*(table[k].to_pylist() for k in ("digests", "ids", "counts", "filter")), strict=True)
    ]


def _compact(table: pa.Table) -> pa.Table:
    """The runs' parts of one segment as one part."""
    parts = _segments(table)
    return _run_row(table["seg"][0].as_py(), *_merge(*(np.concatenate([p[k] for p in parts]) for k in range(3))))


def _resolve(table: pa.Table) -> pa.Table:
    """Digests with more than one copy. Those that no other run's filter may hold aren't merged."""
    parts = _segments(table)
    merge, plain = [], []
    for k, (digests, ids, counts, _) in enumerate(parts):
        maybe = np.zeros(len(ids), dtype=bool)
        for j, other in enumerate(parts):
            if j != k:
                maybe |= _may_hold(other[3], digests)
        merge.append((digests[maybe], ids[maybe], counts[maybe]))
        plain.append((digests[~maybe], ids[~maybe], counts[~maybe]))
    merged = _merge(*(np.concatenate([p[k] for p in merge]) for k in range(3)))
    digests, ids, counts = (np.concatenate([p[k] for p in [*plain, merged]]) for k in range(3))
    many = counts > 1
    return pa.table({
        "digest": pa.array([d.tobytes() for d in digests[many]], pa.binary()),
        "keep": pa.array(ids[many], pa.int64()), "copies": pa.array(counts[many], pa.int64()),
    })


class DigestIndex:
    """Runs by level, as tables in the shared folder. A segment holds about segment_rows digests."""

    def __init__(self, spark, segments: int, fanout: int):
        self.spark, self.segments, self.fanout = spark, segments, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def add(self, batch: DataFrame) -> None:
        """batch: digest, id. Aggregated before the shuffle, so that a hot digest is one row a task."""
        memtable = (
            batch.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
            .withColumn("seg", F.pmod(F.xxhash64("digest"), F.lit(self.segments)))
        )
        self._put(0, memtable.groupBy("seg").applyInArrow(_flush, RUN))

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(C.materialise(run, f"digest-run-{level}"))
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._union(old).groupBy("seg").applyInArrow(_compact, RUN))
            C.discard(*old)

    @staticmethod
    def _union(runs: list[DataFrame]) -> DataFrame:
        whole = runs[0]
        for r in runs[1:]:
            whole = whole.unionByName(r)
        return whole

    def groups(self) -> DataFrame:
        """digest, keep, copies of each digest that occurs more than once."""
        runs = self._union([r for level in self.levels for r in level])
        return runs.groupBy("seg").applyInArrow(_resolve, "digest binary, keep long, copies long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """df to be broadcast if it has no more than so many rows, else as it is: then the join shuffles both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, batches: int = 4, fanout: int = 3, segment_rows: int = 32768, digest_bits: int = 256, broadcast_rows: int = 200_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; see the module's text for the rules.

    digest_bits below 256 shortens the index's digests, so that tests can make them collide.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(C.LAST_ID)).alias("id"), C.one_space(F.col(text_col)).alias("norm"))
    full = F.unhex(C.sha256_hex(F.col("norm")))
    digest = full if digest_bits == 256 else F.unhex(F.rpad(F.substring(F.hex(full), 1, digest_bits // 4), 64, "0"))
    digests = C.materialise(rows.select("id", full.alias("sha"), digest.alias("digest")) if digest_bits < 256 else rows.select("id", full.alias("sha"), full.alias("digest")), "digests")

    index = DigestIndex(spark, max(1, -(-digests.count() // segment_rows)), fanout)
    cuts = C.range_bounds(digests, "id", batches)
    for i in range(len(cuts) + 1):
        index.add(C.slice_of(digests, "id", cuts, i).select("digest", "id"))
    groups = C.materialise(index.groups(), "digest-groups")

    # byte verification of every hit
    hits = rows.withColumn("digest", digest).join(_small(groups, broadcast_rows), "digest")
    # a keeper's text is sent once for each so many copies, so that a hot group spreads over many tasks
    salts = F.ceil(F.col("copies") / COPIES_PER_SALT).cast("long")
    keepers = hits.filter(F.col("id") == F.col("keep")).dropDuplicates(["digest"]).select("digest", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.col("norm").alias("kept_norm"))
    others = hits.filter(F.col("id") != F.col("keep")).withColumn("salt", F.pmod(F.xxhash64("id"), salts))
    differs = C.materialise(others.join(keepers, ["digest", "salt"]).filter(F.col("norm") != F.col("kept_norm")).select("digest").distinct(), "digest-collisions")
    if digest_bits < 256 or differs.limit(1).count():
        # keepers of an id that repeats may differ among themselves, so shortened digests are always regrouped whole
        again = hits if digest_bits < 256 else hits.join(differs, "digest", "left_semi")
        true_groups = again.groupBy("digest", "norm").agg(F.min("id").alias("keep"), F.count("*").alias("copies"))
        true_groups = true_groups.select("digest", F.unhex(C.sha256_hex(F.col("norm"))).alias("sha"), "keep", "copies").filter("copies > 1")
        groups = true_groups.drop("digest") if digest_bits < 256 else groups.join(differs, "digest", "left_anti").withColumnRenamed("digest", "sha").unionByName(true_groups.drop("digest"))
    else:
        groups = groups.withColumnRenamed("digest", "sha")

    nth = F.row_number().over(Window.partitionBy("id", "sha").orderBy("id"))
    out = digests.select("id", "sha").join(groups, "sha", "left").withColumn("nth", nth)
    keep = F.coalesce("keep", "id")
    return out.select(
        F.when(F.col("id") != C.LAST_ID, F.col("id")).alias("doc_id"),
        F.when(keep != C.LAST_ID, keep).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        ((keep == F.col("id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """docs without the rows whose text an earlier row has; all columns stay. Of identical rows one stays.

    Which row of a group stays is told by its id; rows that repeat an id with equal texts are told apart by a window.
    """
    verdict = dedup_exact(docs, **options).filter("kept").select(F.coalesce("doc_id", F.lit(C.LAST_ID)).alias("_id"), F.unhex("text_sha256").alias("_sha"))
    tagged = docs.select(
        F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(C.LAST_ID)).alias("_id"),
        F.unhex(C.sha256_hex(C.one_space(F.col("text")))).alias("_sha"),
    )
    nth = F.row_number().over(Window.partitionBy("_id", "_sha").orderBy("_id"))
    return tagged.join(verdict, ["_id", "_sha"], "left_semi").withColumn("_nth", nth).filter("_nth = 1").select("_row.*")
