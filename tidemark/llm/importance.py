"""Importance resampling towards a target: documents are drawn in proportion to how much likelier the target makes their n-grams.

Documents and target are read once, in portions. A portion numbers its distinct words and holds its n-grams as tuples of
these numbers, each distinct tuple once, and for each document which tuples it has and how often. An integer dictionary
then maps every distinct word of all portions to an id, so that a tuple of ids stands for an n-gram everywhere. Each distinct tuple is
turned back into its bytes and hashed once; its counts in documents and target are added to its bucket. A bucket's gain is
the smoothed log ratio of the two, and is joined back to the portions' tuples, from which the documents' weights are read.
What is shuffled are distinct words and tuples of portions, so a word or tuple that a third of all texts are made of is a
row a portion. Only the gains, one a bucket, are broadcast.

A document's score is its weight plus Gumbel noise from a hash of its id; the best are drawn. Scores are integers whose range follows from the 64-bit
counts and 32-bit noise (some 90,000 values), so documents are ranked by the number of better scores and, among those that share a score, by id.

Null and empty texts have no features: weight 0, and they aren't eligible. Rows that repeat an id share its noise and are ranked each by
itself. A null id counts as the empty text for the noise and sorts last. Texts of any length are read whole. An empty target gives gains
from the documents' counts alone; empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .words import rows_of, utf8, words_of

#: Words after which a portion ends. Words and tuples are shuffled once a portion, so larger ones shuffle less; a worker holds one.
PORTION_WORDS = 4_000_000

_PORTION = pa.schema([("words", pa.list_(pa.binary())), ("grams", pa.list_(pa.list_(pa.int32()))), ("counts", pa.list_(pa.int64())), ("docs", pa.binary()), ("present", pa.binary()), ("n_words", pa.binary()), ("n_features", pa.binary()), ("ends", pa.binary()), ("gram", pa.binary()), ("times", pa.binary())])
_PORTION_SQL = "words array<binary>, grams array<array<int>>, counts array<bigint>, docs binary, present binary, n_words binary, n_features binary, ends binary, gram binary, times binary"
_WEIGHED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


class _Portion:
    """Documents as bags of n-grams over the portion's own numbers of words. A single word is the tuple of its number; longer tuples are numbered after the words."""

    def __init__(self, n: int):
        self.n = n
        self.words: dict[bytes, int] = {}
        self.longer: dict[tuple[int, ...], int] = {}
        self.docs: list[int | None] = []
        self.sizes: list[tuple[int, int]] = []
        self.bags: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    @staticmethod
    def _arrays(bag: Counter) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(bag.keys(), np.int32, len(bag)), np.fromiter(bag.values(), np.int32, len(bag))

    def add(self, doc: int | None, text: bytes | None) -> None:
        number, longer = self.words, self.longer
        seq = [number.setdefault(w, len(number)) for w in words_of(text)]
        more: Counter = Counter()
        for k in range(2, self.n + 1):
            for t, c in Counter(zip(*(seq[i:] for i in range(k)), strict=False)).items():
                more[longer.setdefault(t, len(longer))] += c
        self.docs.append(doc)
        self.sizes.append((len(seq), len(seq) + more.total()))
        self.bags.append((*self._arrays(Counter(seq)), *self._arrays(more)))
        self.held += len(seq) + 1

    def pack(self) -> pa.RecordBatch:
        n = len(self.words)
        gram = np.concatenate([x for a, _, b, _ in self.bags for x in (a, b + np.int32(n))])
        times = np.concatenate([x for _, a, _, b in self.bags for x in (a, b)])
        ends = np.cumsum([len(a) + len(b) for a, _, b, _ in self.bags])
        counts = np.bincount(gram, times, n + len(self.longer)).astype(np.int64) if len(gram) else np.zeros(0, np.int64)
        flat = np.concatenate([np.arange(n), np.fromiter((i for t in self.longer for i in t), np.int64)])
        to = np.concatenate([np.arange(n + 1), n + np.cumsum(np.fromiter(map(len, self.longer), np.int64, len(self.longer)))])
        grams = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(flat, pa.int32()))
        sizes = np.array(self.sizes, np.int64)
        row = [
            pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(list(self.words), pa.binary())), pa.ListArray.from_arrays(pa.array([0, len(grams)], pa.int32()), grams), pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts)),
            np.array([C.LAST_ID if d is None else d for d in self.docs], np.int64), np.array([d is not None for d in self.docs], np.int8), sizes[:, 0].copy(), sizes[:, 1].copy(), ends.astype(np.int64), gram, times,
        ]
        return pa.record_batch([v if isinstance(v, pa.Array) else pa.array([v.tobytes()], pa.binary()) for v in row], schema=_PORTION)


def _portions(rows: DataFrame, id_col: str, text_col: str, n: int, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Portion(n)
        for doc, text in rows_of(batches):
            held.add(doc, text)
            if held.held >= words:
                yield held.pack()
                held = _Portion(n)
        if held.docs:
            yield held.pack()

    return rows.select(F.col(id_col).cast("long"), utf8(F.col(text_col))).mapInArrow(run, _PORTION_SQL)


def bucket_gain(s: Column, t: Column, s_all: Column, t_all: Column, buckets: int) -> Column:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) in doubles."""
    s, t, s_all, t_all = (c.cast("double") for c in (s, t, s_all, t_all))
    return F.floor(F.lit(1000) * F.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))).cast("long")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 32 bits of a checksum of seed and id."""
    h = F.conv(F.substring(C.sha256_hex(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, *, n: int = 1, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", target_text: str = "text", portion_words: int = PORTION_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of each document's n-grams of 1 to n words."""
    both = _portions(docs, id_col, text_col, n, portion_words).withColumn("wanted", F.lit(False)).unionByName(_portions(target, target_id, target_text, n, portion_words).withColumn("wanted", F.lit(True)))
    portions = C.materialise(both.withColumn("portion", F.monotonically_increasing_id()), "resample-portions")
    dictionary = C.materialise(portions.select(F.explode("words").alias("word")).distinct().withColumn("id", F.monotonically_increasing_id()), "resample-words")
    local = portions.select("portion", F.posexplode("words").alias("nth", "word"))
    ids = local.join(dictionary, "word").groupBy("portion").agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "id"))), lambda x: x["id"]).alias("ids"))
    # spelled in ids before they are dealt as rows, which would otherwise each carry the portion's ids
    named = F.transform("grams", lambda g: F.transform(g, lambda i: F.get("ids", i))).alias("tuple")
    tuples = portions.select("portion", "wanted", "grams", "counts").join(ids, "portion").select("portion", "wanted", named, F.col("counts").alias("n"))
    tuples = tuples.select("portion", "wanted", F.posexplode(F.arrays_zip("tuple", "n")).alias("gram", "x")).select("portion", "wanted", "gram", "x.tuple", "x.n")
    tuples = C.materialise(tuples, "resample-tuples")

    distinct = tuples.groupBy("tuple").agg(F.sum(F.when(~F.col("wanted"), F.col("n")).otherwise(0)).alias("s"), F.sum(F.when(F.col("wanted"), F.col("n")).otherwise(0)).alias("t"))
    distinct = C.materialise(distinct.withColumn("key", F.monotonically_increasing_id()), "resample-distinct")
    spelled = distinct.select("key", F.posexplode("tuple").alias("nth", "id")).join(dictionary, "id").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("nth", "word"))).alias("w"))
    text = F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ")
    hashed = C.materialise(distinct.join(spelled.select("key", (F.crc32(text.cast("binary")) % buckets).alias("bucket")), "key").select("tuple", "bucket", "s", "t"), "resample-hashed")
    C.discard(dictionary, distinct)
    # one row a bucket
    sums = hashed.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    totals = sums.agg(F.sum("s"), F.sum("t")).first()
    gains = sums.select("bucket", bucket_gain(F.col("s"), F.col("t"), F.lit(totals[0] or 0), F.lit(totals[1] or 0), buckets).alias("gain"))
    of_tuple = hashed.select("tuple", "bucket").join(F.broadcast(gains), "bucket").select("tuple", "gain")
    mine = tuples.filter(~F.col("wanted")).select("portion", "gram", "tuple").join(of_tuple, "tuple")
    mine = mine.groupBy("portion").agg(F.transform(F.sort_array(F.collect_list(F.struct("gram", "gain"))), lambda x: x["gain"]).alias("gains"))
    back = portions.filter(~F.col("wanted")).select("portion", "docs", "present", "n_words", "n_features", "ends", "gram", "times").join(mine, "portion", "left").drop("portion")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, present, words, features, ends, gram, times, gain in rows_of(batches):
            ids, words, features, ends, times = (np.frombuffer(b, t) for b, t in ((ids, np.int64), (words, np.int64), (features, np.int64), (ends, np.int64), (times, np.int32)))
            each = np.concatenate([[0], np.cumsum(np.array(gain or [], np.int64)[np.frombuffer(gram, np.int32)] * times)])
            sums = each[ends] - each[np.concatenate([[0], ends[:-1]])]
            weight = np.floor_divide(sums, np.maximum(features, 1))
            yield pa.record_batch([pa.array(ids, mask=np.frombuffer(present, np.int8) == 0), pa.array(words), pa.array(features), pa.array(weight)], schema=_WEIGHED)

    out = C.materialise(back.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"), "resample-weights")
    C.discard(portions, tuples, hashed)
    return out


def draw(weighed: DataFrame, *, percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """weighed with score and rank: of the N documents of at least min_words words, the floor(percent N / 100) best are ranked, the others' rank is null."""
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    fit = F.col("n_words") >= min_words
    # a row a score: the integers between the least and the largest sum of a weight and the noise
    ahead = scored.filter(fit).groupBy("score").agg(F.count("*").alias("n"))
    upto = Window.orderBy(F.desc("score"))
    ahead = C.materialise(ahead.withColumn("ahead", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy())), "resample-scores")
    some = ahead.select("all").first()
    wanted = 0 if some is None else percent * some[0] // 100
    reached = F.broadcast(ahead.filter(F.col("ahead") < wanted).select("score", "ahead"))
    drawn = scored.filter(fit).join(reached, "score")
    nth = F.col("ahead") + F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    ranked = drawn.withColumn("rank", F.when(nth <= wanted, nth).cast("long")).drop("ahead")
    rest = scored.filter(fit).join(reached, "score", "left_anti").unionByName(scored.filter(~fit))
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long"))).select(*weighed.columns, "score", "rank")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 10, min_words: int = 20, seed: int = 2024, **how) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of all docs; those drawn have a rank."""
    return draw(weigh(docs, target, **how), percent=percent, min_words=min_words, seed=seed)
