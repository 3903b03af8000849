"""N-gram Jaccard join: components of documents whose shingle sets are alike.

A set's shingles are ordered rare first: by a bit for hot shingles, by the count that their
words' frequencies lead to expect, then by hash. Both come from sketches that count every
shingle and word of the corpus in a fixed number of cells, so what is broadcast is of bounded
size; an order need only be the same everywhere for the join to be exact.

Size-aware heavy-light join: two sets can only be alike if they share so many shingles as
their sizes require. Light sets, up to a boundary size, emit every subset of each such
number as a key; sets above it scan inverted lists, in which a set enters the first shingles of its order: few
enough that alike sets meet in one. A light set that a heavy one could resemble enters
lists too. The boundary is where keys and expected list entries together cost least.

A key's sets are linked to the first and to the next of them, never pair by pair. Such a pair is
dropped if a bound on its overlap, from counts of its shingles by hash class, is too low. The components of
those left are clusters; a cluster's whole sets meet in blocks of bounded size, each sent once
where the cluster is small, and only the links that join components come back; of larger clusters every likely
pair whose sets no link joins yet is verified. Where the sets of a
key then still lie in several components and clusters, blocks of them are compared by the bound, and what it
allows is clustered and verified likewise. So no link between components is lost, and no list
of pairs is made. Equal sets are one node from the start; hot keys are salted.

Empty sets (null, empty or blank text) link with nothing. A null id sorts last. Rows that repeat an
id are judged each by its own text. Sets are told apart by 64-bit hashes, shingles within a set too.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .bloom_lm import Hashes, _portions, mix
from .components import components

#: Cells of the two sketches, and of a piece of one.
SHINGLE_CELLS, WORD_CELLS, PIECE = 1 << 22, 1 << 20, 1 << 16
#: A count of a hash class that stands for itself and all larger ones.
FULL = 65535
#: Light sets are no larger than this, whatever the costs.
LIGHT = 16
SALTS, CELL = 64, 256
BUFFERED = 4_000_000
#: Characters of text whose sets are made at once.
CUT = 500_000


class Rule:
    """Sizes and overlaps for alike sets: den * intersection >= num * union."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def least_size(self, n):
        return -(-self.num * n // self.den)

    def overlap(self, n, m):
        return -(-self.num * (n + m) // (self.num + self.den))

    def subset_sizes(self, n: int) -> list[int]:
        partners = [m for m in range(1, n * self.den // self.num + 2) if min(n, m) >= self.least_size(max(n, m))]
        return sorted({self.overlap(n, m) for m in partners})

    def probes(self, n: int) -> int:
        return n - self.least_size(n) + 1

    def indexed(self, n: int) -> int:
        return n - self.overlap(n, n) + 1


def shingle_sets(texts: list[str | None], k: int, known: Hashes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its words' hashes, its distinct shingles in the order of hashes, and where each first occurs."""
    for t in texts:
        words = np.fromiter(map(known.__getitem__, (t or "").encode().lower().split()), dtype=np.uint64)
        n = len(words)
        width = min(k, n)
        h = words[: n - width + 1].copy() if n else words
        for j in range(1, width):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j : n - width + 1 + j])
        if 0 < n < k:
            h = mix(h + np.uint64(n))
        shingles, first = np.unique(h, return_index=True)
        yield words, shingles, first


def node_of(shingles: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


def classes_of(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each hash class; FULL stands for that many or more. Larger sets have more classes, some eight shingles each."""
    bits = min(16, max(6, (len(shingles) // 8).bit_length()))
    return np.minimum(np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), FULL).astype("<u2").tobytes()


def folded(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """Counts by fewer classes; a class that isn't known exactly stays unknown."""
    parts = counts.reshape(n_classes, -1).astype(np.int64)
    return np.where((parts == FULL).any(axis=1), 1 << 40, parts.sum(axis=1))


class Classes:
    """The class counts of some sets, for bounds on their overlaps."""

    def __init__(self, packed: list[bytes]):
        self.counts = [np.frombuffer(p, dtype="<u2") for p in packed]
        self.length = np.array([len(c) for c in self.counts], dtype=np.int64)
        self.tables: dict[int, np.ndarray] = {}

    def table(self, n_classes: int) -> np.ndarray:
        """Rows of all sets that have so many classes or more."""
        if n_classes not in self.tables:
            self.tables[n_classes] = np.stack([folded(c, n_classes) if len(c) >= n_classes else np.zeros(n_classes, np.int64) for c in self.counts])
        return self.tables[n_classes]

    def most_overlap(self, i: int, others: np.ndarray) -> np.ndarray:
        """Upper bounds on the overlap of set i with others."""
        out = np.zeros(len(others), dtype=np.int64)
        common = np.minimum(self.length[others], self.length[i])
        for k in np.unique(common).tolist():
            at = np.flatnonzero(common == k)
            t = self.table(k)
            out[at] = np.minimum(t[others[at]], t[i]).sum(axis=1)
        return out


def _survey(k: int, small: int):
    """Rows of documents (id, n, node, classes; the shingles of small sets) and pieces of the two sketches."""
    names = ["id", "th", "n", "node", "classes", "shingles", "piece", "cells"]

    def pieces(kind: int, cells: list[np.ndarray], size: int) -> pa.RecordBatch:
        table = np.bincount(np.concatenate(cells).astype(np.int64), minlength=size).astype("<u4").reshape(-1, min(PIECE, size))
        m = len(table)
        return pa.record_batch([*(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())), pa.array(range(kind * 1000, kind * 1000 + m), pa.int32()), pa.array([zlib.compress(r.tobytes(), 1) for r in table], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, n_held = Hashes(), ([], []), 0
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(1), CUT):
                ids, th = (batch.column(c).slice(at, len(texts)) for c in (0, 2))
                at += len(texts)
                ns, nodes, classes, packed = [], [], [], []
                for words, shingles, _ in shingle_sets(texts, k, known):
                    ns.append(len(shingles))
                    nodes.append(node_of(shingles))
                    classes.append(classes_of(shingles))
                    packed.append(shingles.tobytes() if 0 < len(shingles) <= small else None)
                    held[0].append(shingles & np.uint64(SHINGLE_CELLS - 1))
                    held[1].append(words & np.uint64(WORD_CELLS - 1))
                    n_held += len(words)
                m = len(ns)
                yield pa.record_batch([ids, th, pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(classes, pa.binary()), pa.array(packed, pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
                if n_held >= BUFFERED:
                    yield pieces(0, held[0], SHINGLE_CELLS)
                    yield pieces(1, held[1], WORD_CELLS)
                    held, n_held = ([], []), 0
        if n_held:
            yield pieces(0, held[0], SHINGLE_CELLS)
            yield pieces(1, held[1], WORD_CELLS)

    return run


def _sum_pieces(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(c), dtype="<u4").astype(np.int64) for c in table["cells"].to_pylist())
    return pa.table({"piece": table["piece"].slice(0, 1), "cells": pa.array([zlib.compress(total.astype("<i8").tobytes(), 1)], pa.binary())})


class Order:
    """Ranks shingles, rare first. hot: a bit for each cell; words: log2 of each cell's share of all words; total: log2 of all."""

    def __init__(self, shingle_counts: np.ndarray, word_counts: np.ndarray):
        mean = shingle_counts.sum() / max(1, len(shingle_counts))
        self.least_hot = max(48.0, 4 * mean)
        self.hot = np.packbits(shingle_counts >= self.least_hot, bitorder="little")
        total = max(1, int(word_counts.sum()))
        self.words = np.log2(np.maximum(word_counts, 1) / total).astype(np.float32)
        self.total = float(np.log2(total))

    def is_hot(self, shingles: np.ndarray) -> np.ndarray:
        cell = shingles & np.uint64(SHINGLE_CELLS - 1)
        return (self.hot[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def ranks(self, words: np.ndarray, shingles: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A number for each shingle that orders it among all, and whether it is hot."""
        if len(words) >= k:
            w = self.words[words & np.uint64(WORD_CELLS - 1)]
            expected = w[: len(w) - k + 1].copy()
            for j in range(1, k):
                expected += w[j : len(w) - k + 1 + j]
            level = np.clip(expected[first] + self.total + 8, 0, 31).astype(np.uint64)
        else:
            level = np.zeros(len(shingles), dtype=np.uint64)
        hot = self.is_hot(shingles)
        return (hot.astype(np.uint64) << np.uint64(63)) | (level << np.uint64(58)) | (mix(shingles) >> np.uint64(6)), hot


def light_keys(shingles: np.ndarray, rule: Rule) -> list[int]:
    """A key for each subset of each size that a set alike could have in common with this one."""
    out = []
    for c in rule.subset_sizes(len(shingles)):
        if c <= len(shingles):
            for part in combinations(shingles.tolist(), c):
                out.append(xxhash.xxh3_64_intdigest(np.array(part, dtype=np.uint64).tobytes(), seed=c))
    return out


def choose_boundary(costs: dict[int, tuple[int, int, int]], rule: Rule) -> int:
    """The size up to which sets are light. costs: by size, the number of sets, their list entries, and the entries they'd meet there."""
    best, boundary, light = None, 0, 0
    for x in range(LIGHT + 1):
        if x in costs:
            light += costs[x][0] * sum(comb(x, c) for c in rule.subset_sizes(x) if c <= x)
        heavy = sum(e + met for n, (_, e, met) in costs.items() if n > x)
        cross = sum(costs[n][1] for n in costs if n <= x and n >= rule.least_size(x + 1))
        if best is None or light + heavy + cross < best:
            best, boundary = light + heavy + cross, x
    return boundary


def _emit(order, k: int, rule: Rule, boundary: int):
    """Keys of each document's set: key, salt, node, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, o = Hashes(), order.value
        crossing = rule.least_size(boundary + 1)
        for batch in batches:
            for texts in _portions(batch.column(0), CUT):
                keys, salts, nodes, ns = [], [], [], []
                for words, shingles, first in shingle_sets(texts, k, known):
                    n = len(shingles)
                    if not n:
                        continue
                    node = node_of(shingles)
                    took = []
                    if n <= boundary:
                        took.append((np.array(light_keys(shingles, rule), dtype=np.uint64), None))
                    if n > boundary or n >= crossing:
                        rank, hot = o.ranks(words, shingles, first, k)
                        take = rule.probes(n) if n > boundary else rule.indexed(n)
                        at = np.argsort(rank, kind="stable")[:take]
                        took.append((shingles[at], hot[at]))
                    for key, hot in took:
                        keys.append(key.view(np.int64))
                        salts.append(np.zeros(len(key), np.int32) if hot is None else np.where(hot, 1 + node % SALTS, 0).astype(np.int32))
                        nodes.append(np.full(len(key), node))
                        ns.append(np.full(len(key), n))
                if keys:
                    yield pa.record_batch([pa.array(np.concatenate(keys), pa.int64()), pa.array(np.concatenate(salts), pa.int32()), pa.array(np.concatenate(nodes), pa.int64()), pa.array(np.concatenate(ns), pa.int64())], names=["key", "salt", "node", "n"])

    return run


def _lists(rule: Rule):
    """From entries sorted by key, salt, size and node: links to the first and the next of a list, and members of longer lists.

    Memory is one batch: of a list only its first and its last set are carried on.
    """
    names = ["a", "b", "key", "centre"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, salt, first node and size, last node and size, rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            key, salt, node, n = (np.asarray(batch.column(i)) for i in range(4))
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            going_on = last is not None and (last[0], last[1]) == (key[0], salt[0])
            new[0] = not going_on
            again = np.zeros(len(key), dtype=bool)  # copies of a set
            again[1:] = ~new[1:] & (node[1:] == node[:-1])
            again[0] = going_on and last[4] == node[0]
            keep = ~again
            end = (key[-1], salt[-1])
            key, salt, node, n, new = key[keep], salt[keep], node[keep], n[keep], new[keep]
            if not len(key):
                continue
            list_no = np.cumsum(new) - (0 if going_on else 1)
            start = np.flatnonzero(new)
            first_node, first_n = (np.concatenate([[last[i]], x[start]]) if going_on else x[start] for i, x in ((2, node), (3, n)))
            first_node, first_n = first_node[list_no], first_n[list_no]
            previous_node, previous_n = np.roll(node, 1), np.roll(n, 1)
            if going_on:
                previous_node[0], previous_n[0] = last[4], last[5]
            follows = ~new
            star = follows & (first_n >= rule.least_size(n))
            chain = follows & (previous_n >= rule.least_size(n)) & (previous_node != first_node)
            # members of lists: all but those of single sets; a list's first is told by the second
            second = follows & (previous_node == first_node)
            centre = second & (salt > 0)
            alone = new & (salt > 0)  # a salted list's first meets the firsts of the other salts
            a = np.concatenate([first_node[star], previous_node[chain], node[follows], first_node[second], first_node[centre], node[alone]])
            b = np.concatenate([node[star], node[chain]])
            m = len(a) - len(b)
            k = np.concatenate([key[follows], key[second], key[centre], key[alone]])
            c = np.concatenate([np.zeros(follows.sum() + second.sum(), bool), np.ones(centre.sum() + alone.sum(), bool)])
            yield pa.record_batch(
                [pa.array(a, pa.int64()), pa.array(np.concatenate([b, np.zeros(m, np.int64)]), pa.int64(), mask=np.concatenate([np.zeros(len(b), bool), np.ones(m, bool)])),
                 pa.array(np.concatenate([np.zeros(len(b), np.int64), k]), pa.int64()), pa.array(np.concatenate([np.zeros(len(b), bool), c]), pa.bool_())], names=names,
            )
            last = (*end, first_node[-1], first_n[-1], node[-1], n[-1])

    return run


def _bounded(rule: Rule):
    """Pairs whose classes allow the overlap that their sizes require."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            need = rule.overlap(np.asarray(b.column(2)), np.asarray(b.column(3)))
            ok = np.zeros(b.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(*(b.column(c).to_pylist() for c in (4, 5)), strict=True)):
                x, y = np.frombuffer(x, dtype="<u2"), np.frombuffer(y, dtype="<u2")
                k = min(len(x), len(y))
                ok[i] = np.minimum(folded(x, k), folded(y, k)).sum() >= need[i]
            yield pa.record_batch([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))], names=["a", "b"])

    return run


def _verified(rule: Rule):
    """Pairs that are alike, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(j)[i].as_py(), dtype="<u8") for j in (2, 3))
                if len(np.intersect1d(x, y, assume_unique=True)) >= rule.overlap(len(x), len(y)):
                    a.append(batch.column(0)[i].as_py())
                    b.append(batch.column(1)[i].as_py())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


class Forest:
    """Union-find over whatever is hashable."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        p = self.parent
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[x] = y
        return x != y


def _possible(rule: Rule, i: int, right: np.ndarray, label: np.ndarray, n: np.ndarray, classes: Classes) -> np.ndarray:
    """Those on the right that aren't of i's component and that size and bound allow to be alike."""
    r = right[(label[right] != label[i]) & (np.minimum(n[right], n[i]) >= rule.least_size(np.maximum(n[right], n[i])))]
    return r[classes.most_overlap(i, r) >= rule.overlap(n[r], n[i])] if len(r) else r


def _block_suspects(rule: Rule):
    """Links that join all sets of a block that the bound allows to be alike: no more links than sets."""

    def run(table: pa.Table) -> pa.Table:
        node, label, n, side = (table[c].to_numpy() for c in ("node", "label", "n", "side"))
        classes = Classes(table["classes"].to_pylist())
        forest, a, b = Forest(), [], []
        right = np.flatnonzero(side != 0)
        for i in np.flatnonzero(side != 1):
            for j in _possible(rule, i, right, label, n, classes).tolist():
                if forest.join(int(i), j):
                    a.append(int(node[i]))
                    b.append(int(node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _block_links(rule: Rule):
    """Links between components within a block, by whole sets: once two components are linked, no more of theirs are sought."""

    def run(table: pa.Table) -> pa.Table:
        node, label, side = (table[c].to_numpy() for c in ("node", "label", "side"))
        sets = [np.frombuffer(s, dtype="<u8") for s in table["shingles"].to_pylist()]
        n = np.array([len(s) for s in sets])
        classes = Classes([classes_of(s) for s in sets])
        forest, a, b = Forest(), [], []
        right = np.flatnonzero(side != 0)
        for i in np.flatnonzero(side != 1):
            for j in _possible(rule, i, right, label, n, classes).tolist():
                if forest.find(label[i]) != forest.find(label[j]) and len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= rule.overlap(n[i], n[j]):
                    forest.join(label[i], label[j])
                    a.append(int(node[i]))
                    b.append(int(node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _blocks(members: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """members (key, m: how many the key has, node and columns) in blocks of at most about CELL by CELL: key, i, j, side and the columns.

    A key of up to CELL members is one block, and each member is sent once.
    """
    dealt = members.withColumn("_parts", F.ceil(F.col("m") / CELL).cast("int")).withColumn("_part", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
    dealt = dealt.select(key, "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other"), *columns)
    side = F.when(F.col("_part") == F.col("_other"), 2).when(F.col("_part") < F.col("_other"), 0).otherwise(1)
    return dealt.select(key, F.least("_part", "_other").alias("i"), F.greatest("_part", "_other").alias("j"), side.alias("side"), *columns)


def _small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """df to be broadcast if it has no more than so many (narrow) rows; else the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash of every row.

    Documents link when den * intersection >= num * union of their shingles of so many words; with fewer words
    the whole text is one. component_id is the smallest id that links lead to. kept: the row is the one that
    stays of its component, the smallest id's. text_hash is Spark's xxhash64 of the text.
    """
    spark, rule = docs.sparkSession, Rule(num, den)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(C.LAST_ID)).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    surveyed = C.materialise(rows.mapInArrow(_survey(words, LIGHT), "id long, th long, n long, node long, classes binary, shingles binary, piece int, cells binary"), "survey")
    base = surveyed.filter("piece is null").select("id", "th", "n", "node")
    # one row for each distinct set
    nodes = surveyed.filter("node is not null").groupBy("node").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("classes").alias("classes"), F.first("shingles").alias("shingles"))
    nodes = C.materialise(nodes, "nodes")

    # sketches of fixed size come to the driver
    counts = [np.zeros(SHINGLE_CELLS, np.int64), np.zeros(WORD_CELLS, np.int64)]
    for r in surveyed.filter("piece is not null").groupBy("piece").applyInArrow(_sum_pieces, "piece int, cells binary").toLocalIterator():
        part = np.frombuffer(zlib.decompress(r.cells), dtype="<i8")
        kind, at = divmod(r.piece, 1000)
        counts[kind][at * PIECE : at * PIECE + len(part)] = part
    order = Order(*counts)
    shared = spark.sparkContext.broadcast(order)
    met = spark.sparkContext.broadcast(np.minimum(counts[0], 1 << 31).astype("<u4"))

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for s in b.column(0).to_pylist():
                x = np.frombuffer(s, dtype="<u8")
                take = np.sort(met.value[x & np.uint64(SHINGLE_CELLS - 1)])[: rule.probes(len(x))]
                found.append((len(x), len(take), int(take.sum())))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3, names=["n", "entries", "met"])

    by_size = nodes.filter("shingles is not null").select("shingles").mapInArrow(cost, "n long, entries long, met long").groupBy("n").agg(F.count("*").alias("sets"), F.sum("entries").alias("entries"), F.sum("met").alias("met"))
    boundary = choose_boundary({r.n: (r.sets, r.entries, r.met) for r in by_size.collect()}, rule)
    del counts

    entries = rows.select("text").mapInArrow(_emit(shared, words, rule, boundary), "key long, salt int, node long, n long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = entries.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "n", "node").mapInArrow(_lists(rule), "a long, b long, key long, centre boolean")
    lists = C.materialise(lists, "lists")

    pairs = lists.filter("b is not null").select("a", "b")
    centres = lists.filter("b is null and centre").select("key", F.col("a").alias("node")).distinct()
    hub = centres.groupBy("key").agg(F.min("node").alias("a"))
    pairs = pairs.unionByName(centres.join(hub, "key").filter("node <> a").select("a", F.col("node").alias("b"))).distinct()

    light = nodes.select("node", "n", "classes")
    side = lambda name, df, extra: df.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in extra])
    wide = pairs.join(side("a", light, ["n", "classes"]), "a").join(side("b", light, ["n", "classes"]), "b").filter(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
    likely = C.materialise(wide.select("a", "b", "n_a", "n_b", "classes_a", "classes_b").mapInArrow(_bounded(rule), "a long, b long"), "likely-pairs")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """node, shingles of the nodes in wanted, from the first document of each."""
        ids = wanted.join(nodes.select("node", "first_id"), "node").select(F.col("first_id").alias("id"), "node").distinct()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Hashes()
            for batch in batches:
                for texts in _portions(batch.column(0), CUT):
                    found = [s for _, s, _ in shingle_sets(texts, words, known)]
                    yield pa.record_batch([pa.array([node_of(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "shingles"])

        held = C.materialise(ids.select("id").distinct(), "wanted-ids")
        there = rows.join(_small(held), "id").select("text").mapInArrow(run, "node long, shingles binary")
        out = C.materialise(there.join(wanted.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "sets")
        C.discard(held)
        return out

    def clusters(links: DataFrame) -> DataFrame:
        """node, cluster, m of the components of links."""
        found = components(links).withColumnRenamed("label", "cluster")
        return C.materialise(found.join(found.groupBy("cluster").agg(F.count("*").alias("m")), "cluster"), "clusters")

    def linked(members: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between the components of each cluster's members (cluster, m, node, label)."""
        blocks = _blocks(members.join(sets, "node"), "cluster", ["node", "label", "shingles"])
        return blocks.groupBy("cluster", "i", "j").applyInArrow(_block_links(rule), "a long, b long")

    def alike(of: DataFrame) -> DataFrame:
        """Those pairs of `of` (a, b) whose whole sets are alike."""
        full = of.join(side("a", sets, ["shingles"]), "a").join(side("b", sets, ["shingles"]), "b").select("a", "b", "shingles_a", "shingles_b")
        return full.mapInArrow(_verified(rule), "a long, b long")

    # small clusters of likely pairs: all their sets at once. In larger ones two likely pairs a set, then all those whose sets are still apart
    likely_clusters = clusters(likely)
    sets = sets_of(likely_clusters.select("node"))
    edges = linked(likely_clusters.filter(F.col("m") <= CELL).withColumn("label", F.col("node")), sets)
    large = likely_clusters.filter(F.col("m") > CELL).select(F.col("node").alias("b"))
    ranked = C.materialise(likely.join(large, "b", "left_semi").withColumn("_nth", F.row_number().over(Window.partitionBy("b").orderBy("a"))), "pairs-of-large-clusters")
    edges = C.materialise(edges.unionByName(alike(ranked.filter("_nth <= 2"))), "edges")
    rest = ranked.filter("_nth > 2").select("a", "b")
    if rest.limit(1).count():
        first = components(edges)
        for x in ("a", "b"):
            rest = rest.join(first.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")), x, "left")
        apart = C.materialise(rest.filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b"), "pairs-apart")
        more = C.materialise(edges.unionByName(alike(apart)), "edges")
        C.discard(edges, apart)
        edges = more
    C.discard(ranked)
    labels = C.materialise(components(edges), "labels")
    C.discard(sets, likely)

    # lists whose sets lie in several components, unless one cluster of whole comparisons holds them
    members = lists.filter("b is null").groupBy("key", F.col("a").alias("node")).agg(F.max("centre").alias("salted"))
    small = likely_clusters.filter(F.col("m") <= CELL).select("node", "cluster")
    members = members.join(labels, "node", "left").join(small, "node", "left").withColumn("label", F.coalesce("label", "node"))
    members = C.materialise(members.withColumn("cluster", F.coalesce("cluster", "node")), "members")
    who = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    open_keys = members.groupBy("key").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("cluster").alias("c_lo"), F.max("cluster").alias("c_hi"), who.alias("who"), F.max("salted").alias("salted"))
    # of up to three sets every two are a pair already, but not where salts deal them to several lists
    open_keys = open_keys.filter("lo <> hi and c_lo <> c_hi and (m > 3 or m = 3 and salted)")
    # lists of the same sets are one
    open_keys = C.materialise(open_keys.groupBy("who", "m").agg(F.min("key").alias("key")).select("key", "m"), "open-lists")
    if open_keys.limit(1).count():
        inside = members.select("key", "node", "label").join(open_keys, "key").join(light, "node")
        suspects = _blocks(inside, "key", ["node", "label", "n", "classes"]).groupBy("key", "i", "j").applyInArrow(_block_suspects(rule), "a long, b long")
        suspects = C.materialise(suspects.distinct(), "suspects")
        if suspects.limit(1).count():
            found = clusters(suspects)
            asked = found.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            sets = sets_of(found.select("node"))
            more = C.materialise(edges.unionByName(linked(asked, sets)), "edges")
            C.discard(sets, edges, found)
            edges, old = more, labels
            labels = C.materialise(components(edges), "labels")
            C.discard(old)
        C.discard(suspects)
    C.discard(edges, likely_clusters, members, lists, open_keys)

    # equal sets are one node, so only nodes with copies or links differ from their own id
    named = nodes.select("node", "first_id", "copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min(F.struct("first_id", "node")).alias("keeper"), F.count("*").alias("members"), F.max("copies").alias("most")).filter("members > 1 or most > 1")
    named = C.materialise(named.join(smallest, "label").select("node", F.col("keeper.first_id").alias("component"), F.col("keeper.node").alias("keeper")), "component-of-node")
    C.discard(nodes, labels)
    found = base.join(named, "node", "left")
    component = F.coalesce("component", "id")
    return found.select(F.when(F.col("id") != C.LAST_ID, F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), F.when(component != C.LAST_ID, component).alias("component_id"), (F.col("component").isNull() | ((F.col("component") == F.col("id")) & (F.col("keeper") == F.col("node")))).alias("kept"), F.col("th").alias("text_hash"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each component, all columns as they are. Rows that repeat the id and the text of a kept row stay too."""
    kept = jaccard_components(docs, **options).filter("kept").select(F.coalesce("doc_id", F.lit(C.LAST_ID)).alias("_id"), F.col("text_hash").alias("_th")).distinct()
    tagged = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(C.LAST_ID)).alias("_id"), F.xxhash64("text").alias("_th"))
    return tagged.join(kept, ["_id", "_th"], "left_semi").select("_row.*")
