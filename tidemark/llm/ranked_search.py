"""Ranked lexical search, score at a time over an impact-ordered index.

The index is made of shards, each of some documents of one input partition, so postings never move and a
frequent term is split over all shards. In a shard a term's postings are grouped by their exact impact
q = (10^9 tf) div (1000 tf + 20 m), descending; m is the document's length factor. A query's score is the sum of w q over its terms, w
being the term's weight, so w q orders the groups of all its terms.

For each query a shard takes the groups of its terms in descending order and adds them up. The next group of
each term bounds what that term can still give. Once the sum of these bounds is below the k-th best
sum so far, no document that wasn't met can be among the best, and of those met only the ones whose sum plus the bound
reaches the k-th best: their scores are completed from the groups that are left, and the k best, ties to the smaller id, are exact.
The best of all shards are ranked once more; a shard sends at most k rows a query.

Statistics (documents with a term, their terms, documents of a term) are counted over all documents. Queries are taken in blocks of
block_items, whose terms and weights go to the workers; the index may be restricted to given terms, where they are few enough to be sent.

Null texts have no terms: such documents and queries rank nothing and aren't ranked. Rows that repeat a document's id are
ranked each by itself; rows that repeat a query's id are queries of their own. A null id of a document sorts last and stays null. Texts of
any length are read whole. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .words import rows_of, utf8, words_of

#: Documents and postings of a shard.
SHARD_DOCS, SHARD_POSTINGS = 65_536, 2_000_000
#: Length factor of a document: LENGTH_BASE - LENGTH_SHARE + (LENGTH_SHARE n N) div L.
LENGTH_BASE, LENGTH_SHARE, TF_SCALE, TF_HALF = 100, 50, 1000, 20

_RAW = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("docs", pa.binary()), ("lens", pa.binary()), ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int64())), ("at", pa.binary()), ("tf", pa.binary())])
_RAW_SQL = "n_docs long, n_terms long, docs binary, lens binary, terms array<binary>, dfs array<bigint>, at binary, tf binary"
_SHARD = pa.schema([("docs", pa.binary()), ("terms", pa.list_(pa.binary())), ("groups", pa.binary()), ("impacts", pa.binary()), ("ends", pa.binary()), ("at", pa.binary())])
_SHARD_SQL = "docs binary, terms array<binary>, groups binary, impacts binary, ends binary, at binary"
_FOUND = pa.schema([("qid", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


@dataclass
class Index:
    """shards: the table of shards; terms: term, df; n_docs and n_terms: N and L."""

    shards: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int

    def drop(self) -> None:
        C.discard(self.shards, self.terms)


def _pack(docs: list[int], lens: list[int], counts: list[Counter]) -> pa.RecordBatch:
    """One shard before its impacts are known: postings by term, then by document."""
    found: dict[bytes, tuple[list[int], list[int]]] = {}
    for i, c in enumerate(counts):
        for t, n in c.items():
            at, tf = found.setdefault(t, ([], []))
            at.append(i)
            tf.append(n)
    at = np.concatenate([np.array(a, np.int32) for a, _ in found.values()]) if found else np.zeros(0, np.int32)
    tf = np.concatenate([np.array(b, np.int64) for _, b in found.values()]) if found else np.zeros(0, np.int64)
    row = [sum(n > 0 for n in lens), sum(lens), np.array(docs, np.int64).tobytes(), np.array(lens, np.int64).tobytes(), list(found), [len(a) for a, _ in found.values()], at.tobytes(), tf.tobytes()]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _RAW, strict=True)], schema=_RAW)


def length_factors(lens: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each length; exact where the product leaves 64 bits."""
    if len(lens) and LENGTH_SHARE * int(lens.max()) * n_docs >= 1 << 63:
        return np.array([LENGTH_BASE - LENGTH_SHARE + (LENGTH_SHARE * int(n) * n_docs) // n_terms for n in lens], np.int64)
    return LENGTH_BASE - LENGTH_SHARE + (LENGTH_SHARE * lens * n_docs) // max(n_terms, 1)


def order_by_impact(dfs: np.ndarray, at: np.ndarray, tf: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
    """groups (where each term's groups end), impacts and ends of the groups, and the documents in that order."""
    term = np.repeat(np.arange(len(dfs)), dfs)
    q = (1_000_000_000 * tf) // (TF_SCALE * tf + TF_HALF * m[at])
    order = np.lexsort((at, -q, term))
    term, q, at = term[order], q[order], at[order]
    last = np.flatnonzero(np.append((term[1:] != term[:-1]) | (q[1:] != q[:-1]), True)) if len(q) else np.zeros(0, np.int64)
    return np.searchsorted(term[last], np.arange(len(dfs)), side="right"), q[last], last + 1, at


def build(docs: DataFrame, terms: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", max_terms: int = 1_000_000) -> Index:
    """The index of docs. terms (column term, UTF-8 bytes): those that will be asked for, used if there are at most max_terms of them."""
    spark = docs.sparkSession
    wanted = None
    if terms is not None:
        few = terms.select("term").distinct().limit(max_terms + 1).collect()
        wanted = spark.sparkContext.broadcast(frozenset(bytes(r.term) for r in few)) if len(few) <= max_terms else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = None if wanted is None else wanted.value
        ids: list[int] = []
        lens: list[int] = []
        counts: list[Counter] = []
        held = 0
        for doc, text in rows_of(batches):
            words = words_of(text)
            if not words:
                continue
            c = Counter(words if only is None else filter(only.__contains__, words))
            ids.append(C.LAST_ID if doc is None else doc)
            lens.append(len(words))
            counts.append(c)
            held += len(c)
            if held >= SHARD_POSTINGS or len(ids) >= SHARD_DOCS:
                yield _pack(ids, lens, counts)
                ids, lens, counts, held = [], [], [], 0
        if ids:
            yield _pack(ids, lens, counts)

    raw = C.materialise(docs.select(F.col(id_col).cast("long"), utf8(F.col(text_col))).mapInArrow(read, _RAW_SQL), "impact-raw")
    total = raw.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    df = raw.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.dfs").alias("df"))

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, lens, words, dfs, at, tf in rows_of(batches):
            m = length_factors(np.frombuffer(lens, np.int64), n_docs, n_terms)
            made = order_by_impact(np.array(dfs, np.int64), np.frombuffer(at, np.int32), np.frombuffer(tf, np.int64), m)
            groups, impacts, ends, at = (a.astype(t).tobytes() for a, t in zip(made, (np.int64, np.int64, np.int64, np.int32), strict=True))
            row = [ids, words, groups, impacts, ends, at]
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _SHARD, strict=True)], schema=_SHARD)

    shards = C.materialise(raw.select("docs", "lens", "terms", "dfs", "at", "tf").mapInArrow(arrange, _SHARD_SQL), "impact-shards")
    kept = C.materialise(df, "impact-terms")
    C.discard(raw)
    if wanted is not None:
        wanted.destroy()
    return Index(shards, kept, n_docs, n_terms)


class Shard:
    """One shard's postings: of each term the groups' impacts, descending, their ends, and documents."""

    def __init__(self, docs: bytes, terms: list[bytes], groups: bytes, impacts: bytes, ends: bytes, at: bytes):
        self.docs = np.frombuffer(docs, np.int64)
        self.impacts, self.ends, self.at = np.frombuffer(impacts, np.int64), np.frombuffer(ends, np.int64), np.frombuffer(at, np.int32)
        self.groups = np.concatenate([[0], np.frombuffer(groups, np.int64)])
        self.where = {t: i for i, t in enumerate(terms)}

    def search(self, query: list[tuple[bytes, int]], k: int, first: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best documents with a score above 0; the smaller id first among equals."""
        spans = [(self.groups[i], self.groups[i + 1], w) for t, w in query if w > 0 and (i := self.where.get(t)) is not None]
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        group = np.concatenate([np.arange(a, b) for a, b, _ in spans])
        impact = np.concatenate([self.impacts[a:b] * w for a, b, w in spans])
        term = np.repeat(np.arange(len(spans)), [b - a for a, b, _ in spans])
        starts = np.where(group > 0, self.ends[group - 1], 0)
        sizes = self.ends[group] - starts
        # stable: the groups of one term keep their order
        order = np.argsort(-impact, kind="stable")
        impact, term, starts, sizes = impact[order], term[order], starts[order], sizes[order]
        reached = np.cumsum(sizes)
        sums = np.zeros(len(self.docs), np.int64)
        done, step = 0, first
        candidates = None
        while done < len(impact):
            upto = int(np.searchsorted(reached, (reached[done - 1] if done else 0) + step)) + 1
            self._add(sums, impact[done:upto], starts[done:upto], sizes[done:upto])
            done, step = min(upto, len(impact)), step * 2
            # the first group left of a term bounds what the term still gives
            left, at = np.unique(term[done:], return_index=True)
            bound = int(impact[done:][at].sum()) if len(left) else 0
            met = np.count_nonzero(sums)
            if met < k or not len(left):
                continue
            kth = int(np.partition(sums, len(sums) - k)[len(sums) - k])
            if bound < kth:
                near = np.flatnonzero(sums >= kth - bound)
                if len(near) <= max(8 * k, met // 4):
                    candidates = near
                    break
        if candidates is None:
            candidates = np.flatnonzero(sums > 0)
        else:
            self._complete(sums, candidates, impact[done:], starts[done:], sizes[done:])
        score, doc = sums[candidates], self.docs[candidates]
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            score, doc = score[score >= least], doc[score >= least]
        best = np.lexsort((doc, -score))[:k]
        return doc[best], score[best]

    def _postings(self, impact: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the postings of some groups."""
        shift = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(starts - shift, sizes)
        return self.at[at], np.repeat(impact, sizes)

    def _add(self, sums: np.ndarray, impact: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        docs, gains = self._postings(impact, starts, sizes)
        np.add.at(sums, docs, gains)

    def _complete(self, sums: np.ndarray, candidates: np.ndarray, impact: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Adds what is left to the sums of the candidates alone, some groups at a time."""
        wanted = np.zeros(len(self.docs), bool)
        wanted[candidates] = True
        reached = np.cumsum(sizes)
        cut = [0, *(np.searchsorted(reached, np.arange(1 << 18, int(reached[-1]), 1 << 18)) + 1).tolist(), len(impact)] if len(impact) else []
        for a, b in zip(cut, cut[1:], strict=False):
            if a < b:
                docs, gains = self._postings(impact[a:b], starts[a:b], sizes[a:b])
                of = wanted[docs]
                np.add.at(sums, docs[of], gains[of])


def query_terms(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """qid (a number of its own for each row), item_id and the distinct terms of each query."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([list(dict.fromkeys(words_of(t.as_py()))) for t in batch.column(1)], pa.list_(pa.binary()))], names=["item_id", "terms"])

    return items.select(F.col(id_col).cast("long").alias("item_id"), utf8(F.col(text_col)).alias("text")).mapInArrow(cut, "item_id long, terms array<binary>").withColumn("qid", F.monotonically_increasing_id())


def search(index: Index, queries: DataFrame, k: int = 50, *, block_items: int = 2000) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each query (qid, item_id, terms; a written table)."""
    spark = queries.sparkSession
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * index.n_docs + 2) / (F.lit(2) * F.col("df") + 1))).cast("long")
    asked = queries.select("qid", F.explode("terms").alias("term")).join(index.terms, "term")
    weighed = C.materialise(asked.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("w")))).alias("terms")), "impact-queries")
    ids = [r.qid for r in weighed.select("qid").orderBy("qid").toLocalIterator()]
    found = None
    for first in range(0, len(ids), block_items):
        last = ids[min(first + block_items, len(ids)) - 1]
        # at most block_items queries
        block = spark.sparkContext.broadcast([(r.qid, [(bytes(t.term), t.w) for t in r.terms]) for r in weighed.filter(F.col("qid").between(ids[first], last)).collect()])

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for row in rows_of(batches):
                shard = Shard(*row)
                parts = [(q, *shard.search(terms, k)) for q, terms in block.value]
                yield pa.record_batch([pa.array(np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]), pa.int64()), pa.array(np.concatenate([p[1] for p in parts])), pa.array(np.concatenate([p[2] for p in parts]))], schema=_FOUND)

        here = index.shards.mapInArrow(run, "qid long, doc_id long, score long")
        found = here if found is None else found.unionByName(here)
    if found is None:
        found = spark.createDataFrame([], "qid long, doc_id long, score long")
    nth = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id"))
    best = C.materialise(found.withColumn("rank", nth).filter(F.col("rank") <= k), "impact-best")
    C.discard(weighed)
    doc = F.when(F.col("doc_id") != C.LAST_ID, F.col("doc_id"))
    return best.join(queries.select("qid", "item_id"), "qid").select("item_id", "rank", doc.alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The k best documents of docs (doc_id, text) for each of items (item_id, text)."""
    queries = C.materialise(query_terms(items), "impact-items")
    index = build(docs, queries.select(F.explode("terms").alias("term")))
    found = search(index, queries, k)
    index.drop()
    return found
