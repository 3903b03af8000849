"""Pairs of token sets of a day of which one holds most of the other, without a list of candidates that is exchanged.

Equal sets are one class, told by a 64-bit hash; tokens are told apart by 64-bit hashes too. Tokens are ordered rare first, by counts in
a fixed number of cells. Of two similar sets the smaller shares so many tokens, `needed`, that of its rarest, all but needed less k, at
least k are in the other. The classes of a day are dealt to blocks of a bounded number of tokens. A block's task holds the index of its sets by token
and reads the rarest tokens of all sets of the day as a stream: those pairs that share k are counted there and then. What is left meets by block once more,
each whole set once a block, and is counted exactly. So a set is sent once whole and once a block by a tenth of its tokens (at 0.9), whatever the number of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.sources import shared

CELLS = 1 << 22
#: How many of the rarest tokens a pair must share, at most.
SHARED = 3
#: Tokens of a block, at least and at most; between them a 24th of all.
BLOCK = (2_000_000, 16_000_000)
#: Pairs that are counted at once.
PORTION = 4_000_000
#: Keys that are broadcast; beyond that a join shuffles.
BROADCAST = 1_000_000
#: Likely pairs whose whole sets are on the disk at once.
ROUND = 4_000_000


def needed(n, least: float):
    """How many tokens the smaller of two similar sets, of n tokens, shares."""
    return np.maximum(np.ceil(least * n - 1e-9), 1).astype(np.int64)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column as one array, and the length of each list."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values, column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each range, one after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum()), dtype=np.int64) + np.repeat(start - before, length)


def _list_array(values: np.ndarray, length: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(values, kind))


def _offer(counts, blocks, least: float):
    """Of sets (day, class, n, tokens): one row for the block that holds it, and one with its rarest tokens for every block of the day. Tokens that occur once are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = counts.value
        for b in batches:
            if not b.num_rows:
                continue
            day, cls, n = (b.column(i).to_numpy().astype(np.int64) for i in range(3))
            tokens, length = _lists(b.column(3))
            of = np.repeat(np.arange(len(n)), length)
            df = frequency[(tokens.view(np.uint64) >> np.uint64(42)).astype(np.int64)]
            order = np.lexsort((tokens, df, of))
            tokens, df = tokens[order], df[order]
            code = (tokens & 0x7FFFFFFF).astype(np.int32)
            nth = np.arange(len(tokens)) - np.repeat(np.cumsum(length) - length, length)
            must = needed(n, least)
            k = np.minimum(must, SHARED)
            many = np.array([blocks[d] for d in day.tolist()], dtype=np.int64)
            whole = df > 1
            rare = whole & (nth < (n - must + k)[of])
            n_whole, n_rare = (np.bincount(of[x], minlength=len(n)) for x in (whole, rare))
            asks = np.where(n_rare >= k, many, 0)
            copies = np.repeat(np.arange(len(n)), asks)
            start = np.cumsum(n_rare) - n_rare
            at = np.concatenate([np.arange(len(n)), copies])
            block = np.concatenate([cls % many, _ranges(np.zeros(len(n), np.int64), asks)])
            side = np.concatenate([np.zeros(len(n), np.int8), np.ones(len(copies), np.int8)])
            codes = np.concatenate([code[whole], code[rare][_ranges(start[copies], n_rare[copies])]])
            yield pa.record_batch([pa.array(day[at]), pa.array(block, pa.int32()), pa.array(side, pa.int8()), pa.array(cls[at]), pa.array(n[at], pa.int32()), _list_array(codes, np.concatenate([n_whole, n_rare[copies]]), pa.int32())], names=["day", "block", "side", "class", "n", "codes"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], pa.RecordBatch]]:
    """Pieces of batches of one day, block and side, in order."""
    for b in batches:
        if not b.num_rows:
            continue
        day, block, side = (b.column(i).to_numpy() for i in range(3))
        cut = np.flatnonzero((day[1:] != day[:-1]) | (block[1:] != block[:-1]) | (side[1:] != side[:-1])) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(day)], strict=True):
            yield (int(day[i]), int(block[i]), int(side[i])), b.slice(i, j - i)


class _Block:
    """The sets of a block by token."""

    def __init__(self, pieces: list[pa.RecordBatch]):
        self.cls, self.n = (np.concatenate([p.column(i).to_numpy() for p in pieces]).astype(np.int64) for i in (3, 4))
        codes, length = (np.concatenate(x) for x in zip(*[_lists(p.column(5)) for p in pieces], strict=True))
        keep = np.ones(len(self.cls), dtype=bool)
        keep[1:] = self.cls[1:] != self.cls[:-1]  # copies follow one another
        codes, length, self.cls, self.n = codes[np.repeat(keep, length)], length[keep], self.cls[keep], self.n[keep]
        order = np.argsort(codes, kind="stable")
        self.of = np.repeat(np.arange(len(self.cls), dtype=np.int32), length)[order]
        self.codes, self.start = np.unique(codes[order], return_index=True)
        self.end = np.append(self.start[1:], len(codes))

    def shared(self, asked: pa.RecordBatch, least: float, last: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Classes of asked and of the block that share as many of the rarest tokens as similar sets must. last: the class before, whose copies are left out."""
        cls, n = (asked.column(i).to_numpy().astype(np.int64) for i in (3, 4))
        codes, length = _lists(asked.column(5))
        keep = np.concatenate([[cls[0] != last], cls[1:] != cls[:-1]])
        codes, length, cls, n = codes[np.repeat(keep, length)], length[keep], cls[keep], n[keep]
        if not len(cls) or not len(self.codes):
            return
        order = np.argsort(codes, kind="stable")
        place = np.empty(len(codes), dtype=np.int64)
        place[order] = np.minimum(np.searchsorted(self.codes, codes[order]), len(self.codes) - 1)
        there = self.codes[place] == codes
        met = np.where(there, self.end[place] - self.start[place], 0)
        of = np.repeat(np.arange(len(cls)), length)
        must = np.minimum(needed(n, least), SHARED)
        total = np.cumsum(np.bincount(of, weights=met, minlength=len(cls)))
        i = 0
        while i < len(cls):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PORTION, "right")))
            a, b = np.searchsorted(of, [i, j])
            s = np.repeat(of[a:b], met[a:b])
            t = self.of[_ranges(self.start[place[a:b]], met[a:b])]
            larger = (self.n[t] > n[s]) | ((self.n[t] == n[s]) & (self.cls[t] > cls[s]))
            pair = np.sort((s[larger] - i) * len(self.cls) + t[larger])
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
            s, t = np.divmod(pair[first], len(self.cls))
            enough = np.diff(np.append(first, len(pair))) >= must[s + i]
            yield cls[s[enough] + i], self.cls[t[enough]]
            i = j


def _probe(least: float):
    """From rows of _offer, ordered by day, block, side and class: likely pairs, the smaller set first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groupby(_runs(batches), key=lambda r: r[0][:2]):
            held, block, last = [], None, None
            for (_, _, side), piece in rows:
                if side == 0:
                    held.append(piece)
                    continue
                if not held:
                    continue
                block = block or _Block(held)
                for s, t in block.shared(piece, least, last):
                    if len(s):
                        yield pa.record_batch([pa.array(np.full(len(s), key[0])), pa.array(np.full(len(s), key[1]), pa.int32()), pa.array(s), pa.array(t)], names=["day", "block", "s", "l"])
                last = piece.column(3)[-1].as_py()

    return run


def _count(least: float):
    """From rows (day, block, side, class, tokens, asked), ordered so: pairs whose smaller set shares as many tokens as it needs, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_runs(batches), key=lambda r: r[0][:2]):
            held: list[pa.RecordBatch] = []
            block: _Whole | None = None
            for (day, _, side), piece in rows:
                if side == 0:
                    held.append(piece)
                    continue
                block = block or _Whole(held)
                s, t, both, ns, nl = block.shared(piece)
                enough = both >= needed(ns, least)
                yield pa.record_batch([pa.array(np.full(int(enough.sum()), day, np.int64)), *(pa.array(x[enough], kind) for x, kind in ((s, pa.int64()), (t, pa.int64()), (both, pa.int32()), (ns, pa.int32()), (nl, pa.int32())))], names=["day", "s", "l", "both", "ns", "nl"])

    return run


class _Whole:
    """Whole sets of a block, by class, their tokens numbered within the block."""

    def __init__(self, pieces: list[pa.RecordBatch]):
        self.cls = np.concatenate([p.column(3).to_numpy() for p in pieces])
        tokens, self.length = (np.concatenate(x) for x in zip(*[_lists(p.column(4)) for p in pieces], strict=True))
        self.start = np.cumsum(self.length) - self.length
        self.known, number = np.unique(tokens, return_inverse=True)
        self.number = number.astype(np.int32)
        self.mine = np.zeros(len(self.known), dtype=bool)

    def shared(self, asking: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Of the asking sets and the ones they ask for: class, class asked for, how many tokens both have, and their sizes."""
        cls = asking.column(3).to_numpy()
        tokens, n = _lists(asking.column(4))
        asked, many = _lists(asking.column(5))
        at = np.searchsorted(self.cls, asked)
        place = np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)
        there = self.known[place] == tokens
        both = np.zeros(len(asked), dtype=np.int64)
        first, begin = np.cumsum(n) - n, np.cumsum(many) - many
        for i in range(len(cls)):
            own = slice(first[i], first[i] + n[i])
            mine = place[own][there[own]]
            self.mine[mine] = True
            x = at[begin[i] : begin[i] + many[i]]
            size = np.cumsum(self.length[x])
            a = 0
            while a < len(x):
                b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + PORTION, "right")))
                part = self.length[x[a:b]]
                both[begin[i] + a : begin[i] + b] = np.add.reduceat(self.mine[self.number[_ranges(self.start[x[a:b]], part)]], np.cumsum(part) - part, dtype=np.int64)
                a = b
            self.mine[mine] = False
        return np.repeat(cls, many), asked, both, np.repeat(n, many), self.length[at]


def _narrow(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST + 1).count() <= BROADCAST else df


def similar_pairs(docs: DataFrame, least: float) -> DataFrame:
    """See dedup.similar_pairs."""
    spark = docs.sparkSession
    hashed = docs.filter("event_date is not null and size(tokens) > 0").select("event_date", "raw_id", F.xxhash64("event_date").alias("day"), F.sort_array(F.transform("tokens", lambda t: F.xxhash64(t))).alias("tokens"))
    sets = shared.kept(hashed.withColumn("class", F.xxhash64("day", "tokens").bitwiseAND((1 << 62) - 1)), "token-sets")
    members = sets.select("event_date", "raw_id", "day", "class")

    # by cell how often its tokens occur, in an array of fixed size; by day its tokens, a row each
    counts = np.zeros(CELLS, dtype=np.int32)
    cells = sets.select(F.explode("tokens").alias("t")).groupBy(F.shiftrightunsigned("t", 42).cast("int").alias("cell")).agg(F.least(F.count("*"), F.lit((1 << 31) - 1)).cast("int").alias("n")).toArrow()
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    per_day = {r.day: r.n for r in sets.groupBy("day").agg(F.sum(F.size("tokens")).alias("n")).collect()}
    block = min(max(sum(per_day.values()) // 24, BLOCK[0]), BLOCK[1])
    blocks = {d: -(-n // block) for d, n in per_day.items()}

    offered = sets.select("day", "class", F.size("tokens").alias("n"), "tokens").mapInArrow(_offer(spark.sparkContext.broadcast(counts), blocks, least), "day long, block int, side byte, class long, n int, codes array<int>")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    together = lambda df: df.repartition(parts, "day", "block").sortWithinPartitions("day", "block", "side", "class")
    likely = shared.kept(together(offered).mapInArrow(_probe(least), "day long, block int, s long, l long"), "likely-pairs", keep_exchanged=False)

    # whole sets of what is likely: the larger once, in its block, the smaller once a block that asks for it; in rounds of some blocks each
    wanted = shared.kept(likely.select(F.explode(F.array("s", "l")).alias("class")).distinct(), "wanted", keep_exchanged=False)
    held = shared.kept(sets.select("class", "tokens").join(_narrow(wanted), "class", "left_semi").dropDuplicates(["class"]), "wanted-sets", keep_exchanged=False)
    rounds = min(-(-likely.count() // ROUND) or 1, max(blocks.values(), default=1))
    similarity = X.similarity_of(F.col("both"), F.col("ns"), F.col("nl"))
    counted = []
    for i in range(rounds):
        here = likely.filter(F.col("block") % rounds == i)
        asks = here.groupBy("day", "block", F.col("s").alias("class")).agg(F.collect_list("l").alias("asked"), F.lit(1).cast("byte").alias("side"))
        asked = here.select("day", "block", F.col("l").alias("class")).distinct().withColumns({"asked": F.lit(None).cast("array<long>"), "side": F.lit(0).cast("byte")})
        whole = asks.unionByName(asked).join(held, "class").select("day", "block", "side", "class", "tokens", "asked")
        similar = together(whole).mapInArrow(_count(least), "day long, s long, l long, both int, ns int, nl int").withColumn("similarity", similarity)
        counted.append(shared.kept(similar.filter(F.col("similarity") >= least).select("day", "s", "l", "both", "similarity"), "similar-classes", keep_exchanged=False))
    found = reduce(DataFrame.unionByName, counted)
    shared.discard(wanted, held, likely)

    # classes as their members; those of one class are equal, so each is all of the other
    narrow = _narrow(members)
    side = lambda name: narrow.select(*(["event_date"] if name == "s" else []), "day", F.col("class").alias(name), F.col("raw_id").alias(f"raw_{name}"))
    apart = found.join(side("s"), ["day", "s"]).join(side("l"), ["day", "l"])
    copies = sets.select("event_date", "day", F.col("class").alias("s"), F.col("raw_id").alias("raw_s"), F.size("tokens").alias("both")).join(side("l").withColumnRenamed("l", "s"), ["day", "s"]).filter("raw_s < raw_l").withColumn("similarity", F.lit(1.0))
    pairs = apart.select("event_date", "raw_s", "raw_l", "both", "similarity").unionByName(copies.select("event_date", "raw_s", "raw_l", "both", "similarity"))
    return pairs.select("event_date", F.least("raw_s", "raw_l").alias("a"), F.greatest("raw_s", "raw_l").alias("b"), "both", "similarity")
