"""Numbers of tokens by a tokenizers file; huge texts are encoded in overlapping pieces and spliced.

A text of more than piece_chars characters is cut into pieces, each reaching `overlap` characters into the next; pieces
are dealt to all tasks. A piece is encoded with offsets and tells where words (the tokenizer's pre-tokens) begin in what it shares
with its neighbours, and how many tokens lie before. Where both pieces of a seam see a word begin, they are spliced.

Why such a boundary is stable: words are found from left to right without looking back, so once two scans begin a word at the same
place they agree from there on. The left piece is right up to its last word, by induction over the seams; so a place where
the right piece begins a word too is where it falls in step. Places count only where the text before can't change how the
text behind is normalised (the character neither combines with nor composes with what precedes), and far enough from the left
piece's end that no added token that spans the place could be cut off. If a seam has no such place, its text is
cut anew with eight times the overlap, and longer pieces where that needs it, at last in one piece: nothing is ever guessed.

This holds for tokenizers whose normalisers are NFC, lower-casing and white space, and whose words come from a pattern
without lookbehind or anchors; for others (provable) texts are encoded whole.

Null texts count as empty: no bytes, no tokens. Each row is counted by itself, repeated ids too. Texts of white space alone have as many tokens as the library says.
Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

VOCABULARY = "word_bpe_49k.json"
#: Characters encoded in one call.
BATCH_CHARS = 500_000

_SEAM = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
_PIECE = pa.schema([("row", pa.int64()), ("nth", pa.int64()), ("last", pa.bool_()), ("n", pa.int64()), ("left", _SEAM), ("right", _SEAM)])
_PIECE_SQL = "row long, nth long, last boolean, n long, left array<struct<at: long, before: long>>, right array<struct<at: long, before: long>>"


def provable(config: dict) -> bool:
    """Whether a tokenizer's words are found in a way for which common boundaries are proven stable."""

    def parts(node: dict | None, inner: str) -> list[dict]:
        return [] if node is None else [p for x in node[inner] for p in parts(x, inner)] if node["type"] == "Sequence" else [node]

    for n in parts(config.get("normalizer"), "normalizers"):
        blank = n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " "
        if n["type"] not in ("NFC", "Lowercase") and not blank:
            return False
    cutters = 0
    for p in parts(config.get("pre_tokenizer"), "pretokenizers"):
        if p["type"] == "ByteLevel":
            if p.get("add_prefix_space"):
                return False
            cutters += bool(p.get("use_regex", True))
        elif p["type"] == "Split":
            pattern = p["pattern"].get("Regex")
            if pattern is None or re.search(r"\(\?<|\\[bBAGzZK]|[$]|(?<!\[)\^", pattern) or not (p["behavior"] == "Isolated" and not p["invert"] or p["behavior"] == "Removed" and p["invert"]):
                return False
            cutters += 1
        else:
            return False
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in config.get("added_tokens") or [])
    return cutters == 1 and plain and not config.get("truncation") and not config.get("padding")


@cache
def _composing() -> frozenset[str]:
    """Characters that can be the later part of a composed one."""
    found = set(map(chr, [*range(0x1100, 0x1200), *range(0xA960, 0xA980), *range(0xD7B0, 0xD800)]))
    for c in range(0x110000):
        d = unicodedata.decomposition(chr(c))
        if d and d[0] != "<":
            found.update(chr(int(x, 16)) for x in d.split()[1:])
    return frozenset(found)


@cache
def begins(c: str) -> bool:
    """Whether text from the character c on is normalised alike whatever precedes it."""
    return c.isascii() or (unicodedata.category(c) != "Cn" and not unicodedata.combining(c) and c not in _composing() and all(not unicodedata.combining(x) and x not in _composing() for x in unicodedata.normalize("NFD", c)[:1]))


class Counter:
    """One tokenizer in a worker."""

    def __init__(self, config: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(config)
        self.longest = max((len(t["content"]) for t in json.loads(config).get("added_tokens") or []), default=0)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def piece(self, text: str, stride: int, overlap: int, first: bool, last: bool) -> tuple[int, list[dict], list[dict]]:
        """The number of tokens of a piece, and where words begin, with the tokens before, in what it shares with the pieces around it."""
        e = self.model.encode(text, add_special_tokens=False)
        spans, words = e.offsets, e.word_ids
        n = len(spans)
        starts = [i for i in range(n) if i == 0 or (words[i] != words[i - 1] and spans[i][0] >= spans[i - 1][1])]
        left = [] if first else [{"at": spans[i][0], "before": i} for i in starts if spans[i][0] < overlap and begins(text[spans[i][0]])]
        right: list[dict] = []
        if not last and starts:
            end = min(spans[starts[-1]][0], len(text) - self.longest)
            right = [{"at": p - stride, "before": i} for i in starts if i and stride <= (p := spans[i][0]) < end and begins(text[p])]
        return n, left, right


_counters: dict[int, Counter] = {}


def counter_for(config: str) -> Counter:
    if hash(config) not in _counters:
        _counters.clear()
        _counters[hash(config)] = Counter(config)
    return _counters[hash(config)]


def cut(text: str, stride: int, overlap: int) -> Iterator[tuple[int, bool, str]]:
    """The pieces of a text: number, whether it is the last, and the text with its overlap."""
    n = max(1, -(-max(len(text) - overlap, 0) // stride))
    for i in range(n):
        yield i, i == n - 1, text[i * stride :] if i == n - 1 else text[i * stride : (i + 1) * stride + overlap]


def _seams(todo: DataFrame, config, stride: int, overlap: int) -> DataFrame:
    """row, n_tokens (null where a seam had no boundary) of the texts of todo (row, text), cut with this stride and overlap."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0), batch.column(1), strict=True):
                for nth, last, piece in cut(text.as_py(), stride, overlap):
                    yield pa.record_batch([pa.array([row.as_py()], pa.int64()), pa.array([nth], pa.int64()), pa.array([last]), pa.array([piece])], names=["row", "nth", "last", "piece"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(config.value)
        for batch in batches:
            for row, nth, last, piece in zip(*batch.columns, strict=True):
                made = counter.piece(piece.as_py(), stride, overlap, nth.as_py() == 0, last.as_py())
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip((row.as_py(), nth.as_py(), last.as_py(), *made), _PIECE, strict=True)], schema=_PIECE)

    dealt = todo.select("row", "text").mapInArrow(pieces, "row long, nth long, last boolean, piece string").repartition("row", "nth")
    told = dealt.mapInArrow(measure, _PIECE_SQL)
    after = told.withColumn("theirs", F.lead("left").over(Window.partitionBy("row").orderBy("nth")))
    at = F.array_min(F.array_intersect(F.transform("right", lambda x: x["at"]), F.transform("theirs", lambda x: x["at"])))
    before = lambda side: F.get(F.filter(side, lambda x: x["at"] == F.col("at")), F.lit(0))["before"]
    share = F.when(F.col("last"), F.col("n")).otherwise(before("right") - before("theirs"))
    return after.withColumn("at", at).groupBy("row").agg(F.when(F.count(share) == F.count("*"), F.sum(share)).alias("n_tokens"))


def count_tokens(docs: DataFrame, *, vocabulary: str | None = None, piece_chars: int = 65_536, overlap: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of each document."""
    if not 0 < overlap <= piece_chars:
        raise ValueError("overlap must lie between 1 and piece_chars")
    # a vocabulary file of fixed size, read where the driver is
    with open(C.data_file(vocabulary, VOCABULARY), encoding="utf-8") as f:
        text = f.read()
    spark = docs.sparkSession
    config = spark.sparkContext.broadcast(text)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    huge = F.length("text") > piece_chars if provable(json.loads(text)) else F.lit(False)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(config.value)
        for batch in batches:
            counts, held, size = [], [], 0
            for t in batch.column(2):
                held.append(t.as_py())
                size += len(held[-1])
                if size >= BATCH_CHARS:
                    counts += counter.counts(held)
                    held, size = [], 0
            counts += counter.counts(held)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    found = rows.filter(~huge).mapInArrow(whole, "doc_id long, n_bytes long, n_tokens long")
    todo = C.materialise(rows.filter(huge).withColumn("row", F.monotonically_increasing_id()), "tokens-huge")
    stride = piece_chars
    while not todo.isEmpty():
        counted = C.materialise(_seams(todo, config, stride, overlap), "tokens-spliced")
        found = found.unionByName(todo.join(counted.filter("n_tokens is not null"), "row").select("doc_id", "n_bytes", "n_tokens"))
        todo = C.materialise(todo.join(counted.filter("n_tokens is null"), "row", "left_semi"), "tokens-huge")
        overlap *= 8
        stride = max(stride, overlap)
    return found
