"""Mixing sources to target weights, with DataFrame functions alone.

A document's size is its count of words ([^\\x20\\x09-\\x0D]+). Sources are ordered by code
point, null last, and weigh as `weights` says, repeating. They share `share` times the
total size by weight; no target exceeds `cap` times its source's size, the excess being
shared again by weight until none does. That fixed point is min(cap * size, level * weight)
with one level for all sources below their cap, which two running sums over the sources
find without iterating. A source's repetition rate is target / size: each of its documents
is taken floor(rate) times, and once more if a hash of its id under `seed` falls below the
fraction. So reruns agree, in any partitioning.

A null text has size 0 and a null source is a source of its own. A source of size 0 has
target 0 and takes nothing. Rows that repeat an id draw alike; a null id draws by its text.
An empty table gives no rows. Columns with other names pass through mix() untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target of each source in sizes (source, size).

    The windows below run over one row a source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    per = (
        per.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    )
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    # if the sources up to here are at their caps, level is what those from here on would get for each unit of weight
    found = per.withColumn("_level", level).withColumn("_first", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")))
    found = found.withColumn("_at", F.first("_first", ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_at") * F.col("_w"), F.col("_cap")))
    return found.select("source", "source_size", target.alias("target"))


def _draw(seed: int, doc_id: Column, text: Column) -> Column:
    """Uniform in [0, 1) by the document."""
    h = F.xxhash64(F.lit(seed), doc_id, F.when(doc_id.isNull(), text))
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0**-53)


def _copies(draw: Column) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def _with_targets(rows: DataFrame, targets: DataFrame, broadcast_rows: int) -> DataFrame:
    """The sources' table is broadcast when it is small; else AQE splits what a hot source gathers."""
    t = targets.withColumnRenamed("source", "_source")
    if t.limit(broadcast_rows + 1).count() <= broadcast_rows:
        t = F.broadcast(t)
    return rows.join(t, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def plan_mix(docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 20, broadcast_rows: int = 10_000) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row of docs (doc_id, source, text)."""
    sizes = C.materialise(docs.select("doc_id", "source", C.count_words(F.col("text")).alias("size"), _draw(seed, F.col("doc_id"), F.col("text")).alias("_draw")), "sizes")
    targets = C.materialise(source_targets(sizes, weights, share, cap), "targets")
    found = _with_targets(sizes, targets, broadcast_rows).withColumn("copies", _copies(F.col("_draw")))
    return found.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 20, broadcast_rows: int = 10_000) -> DataFrame:
    """The mixed corpus: each row of docs as often as its rate and draw say, with its own columns."""
    sizes = docs.select("source", C.count_words(F.col("text")).alias("size"))
    targets = C.materialise(source_targets(sizes, weights, share, cap), "targets")
    keep = F.struct(*docs.columns).alias("_row")
    rows = docs.select(keep, "source", _draw(seed, F.col("doc_id"), F.col("text")).alias("_draw"))
    found = _with_targets(rows, targets, broadcast_rows).withColumn("_copies", _copies(F.col("_draw")))
    return found.filter("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_nth")).select("_row.*")
