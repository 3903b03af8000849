"""Language-model scores from a log-frequency Bloom filter.

Words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased), word pairs and triples of all training documents are counted
whole, in shards of the hash space. A count c is kept as its level 1 + floor(log2 c): the filter
holds (n-gram, 1) up to (n-gram, level), and a level is read back by probing for 1, 2, ...
until one is missing (Talbot and Osborne). Each shard of counts becomes a segment of the filter,
sized by what it holds. A filter of at most max_broadcast bytes goes to the workers by broadcast. Of a larger
one the segments stay where they are: texts become numbers of their portion's distinct words once, the distinct probes of each portion
are sent to their shards and bare levels come back, each once, whatever the filter's size. Both ways read the same levels. Keys of pairs
and triples have 48 bits, and sorted keys travel as differences in as few bytes as they need: two keys meet in one about once in
a million, which is little beside the filter's own false positives. Words keep 64 bits, as their counts are exact.

Every count that the model uses is read from the filter. A level stands for the smallest count that it may mean where it is a
numerator, and for the largest where it is a history's, so that the probabilities after a history never sum above 1
(but for the filter's false positives). The probability of a word after two others is (c3 + mu3 p2) / (c2 + mu3), with
p2 = (c2 + mu2 p1) / (c1 + mu2) and p1 = (c1 + 1) / (N + V + 1). mu2 and mu3 are those under which the whole training data, each
token left out in turn, has as many unseen continuations as n-grams that occur once; they follow from the histograms of
levels. A text starts after a start mark and ends with an end mark.

The base score uses exact counts. Those of the most frequent words, at most top_words of
them, are broadcast; the others are sent to their shard of the
exact counts and come back as sums. The model doesn't use them.

A null text is empty: only its end is scored. A null id is in the fold of the empty text. Rows
that repeat an id are scored each by its own text, and each counts for training. Without
training rows N and V are 0. Other columns aren't read.
"""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Words of 64 bits that an entry reaches in the filter, and bits that it sets in each.
REACHED, SET = 2, 3
#: Words whose hashes a worker remembers.
REMEMBERED = 100_000
#: Tokens that a task counts before it sends counts on.
COUNTED = 2_000_000
#: Shards whose counts it sends at once.
SENT_ROWS = 100
#: Characters of text that are scored at once, and that ask the filter's shards together.
SCORED, ASKED = 500_000, 3_000_000
#: In how many rounds portions ask; only one round's questions and answers are on disk at a time.
ROUNDS = 4
#: What keys of pairs and triples have of 64 bits.
KEPT = np.uint64(0xFFFFFFFFFFFF0000)
WORD, PAIR, TRIPLE = 0, 1, 2
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def give_back() -> None:
    """Returns memory that is free within a worker to the system: workers are used again, by tasks that need it elsewhere."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def token_hashes(texts: list[str | None], known: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, ends included, one after the other; where each text ends."""
    words: list[int] = []
    ends = []
    end = int(END)
    for t in texts:
        # bytes are lower-cased and split by ASCII's rules: A-Z and [\x20\x09-\x0D]
        words += map(known.__getitem__, (t or "").encode().lower().split())
        words.append(end)
        ends.append(len(words))
    return np.array(words, dtype=np.uint64), np.array(ends, dtype=np.int64)


def before_each(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each, the start mark at the start of a text."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[0] = START
    out[ends[:-1]] = START
    return out


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second) & KEPT


def _shift(kind: int) -> np.uint64:
    return np.uint64(0 if kind == WORD else 16)


def _first_of(shard: np.ndarray, shards: int) -> np.ndarray:
    """The smallest key of each shard."""
    return ((shard.astype(np.uint64) << np.uint64(32)) + np.uint64(shards - 1)) // np.uint64(shards) << np.uint64(32)


def narrow(values: np.ndarray) -> tuple[int, np.ndarray]:
    """The bytes that each of the unsigned values needs, and those bytes as rows."""
    wide = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    return wide, values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]


def widen(data: bytes, wide: int) -> np.ndarray:
    """The values of bytes that were written column by column."""
    columns = np.frombuffer(data, dtype=np.uint8).reshape(wide, -1)
    out = np.zeros((columns.shape[1], 8), dtype=np.uint8)
    out[:, :wide] = columns.T
    return out.reshape(-1).view("<u8")


def pack(keys: np.ndarray, first: np.ndarray, kind: int, cuts: list[tuple[int, int]]) -> list[bytes]:
    """Sorted keys between cuts, none of them empty, as differences from one to the next; those at cuts from first. A byte of width leads."""
    gaps = np.empty_like(keys)
    gaps[1:] = keys[1:] - keys[:-1]
    at = np.array([a for a, _ in cuts], dtype=np.int64)
    gaps[at] = keys[at] - first
    wide, rows = narrow(gaps >> _shift(kind))
    return [bytes((wide,)) + rows[a:b].T.tobytes() for a, b in cuts]


def unpack(data: bytes, first: int, kind: int) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    return (np.cumsum(widen(data[1:], data[0]), dtype=np.uint64) << _shift(kind)) + np.uint64(first)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def triple_keys(pairs: np.ndarray, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the triples that end at each token, and whether there is one: not where a text starts."""
    before = np.empty_like(pairs)
    before[1:] = pairs[:-1]
    before[0] = 0
    there = np.ones(len(tokens), dtype=bool)
    there[starts] = False
    return pair_keys(before ^ START, tokens), there


#: The smallest and the largest count of a level.
LOW = np.array([0.0] + [2.0 ** (q - 1) for q in range(1, 64)])
HIGH = np.array([0.0] + [2.0**q - 1 for q in range(1, 64)])


def log_probabilities(words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, starts: np.ndarray, start_level: int, total: float, mu: tuple[float, float]) -> np.ndarray:
    """log10 of each token's probability, from the levels of its word, its pair and its triple. total: N + V + 1."""
    first, second = np.zeros(len(words)), np.zeros(len(words))
    first[1:], second[1:] = HIGH[words[:-1]], HIGH[pairs[:-1]]
    first[starts], second[starts] = HIGH[start_level], 0.0
    p = (LOW[words] + 1) / total
    p = (np.minimum(LOW[pairs], first) + mu[0] * p) / (first + mu[0])
    return np.log10((np.minimum(LOW[triples], second) + mu[1] * p) / (second + mu[1]))


def prior_weight(history: list[int], once: int) -> float:
    """The mu under which tokens left out in turn are unseen as often as n-grams occur once. history: how many histories have each level."""
    n = np.array(history, dtype=np.float64)
    c = (LOW + HIGH)[: len(n)] / 2

    def unseen(mu: float) -> float:
        return float((n * c * mu / (np.maximum(c - 1, 0) + mu)).sum())

    lo, hi = 1e-2, 1e6
    if unseen(hi) <= once:
        return hi
    for _ in range(100):
        mid = math.sqrt(lo * hi)
        lo, hi = (mid, hi) if unseen(mid) < once else (lo, mid)
    return lo


def _entries(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys + np.uint64(level * 0x632BE59BD9B4E019 % (1 << 64)))


def _places(h: np.ndarray, words: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The word that an entry's hash reaches among so many, and the mask of its bits there."""
    one, low = np.uint64(1), np.uint64(63)
    mask = (one << (h & low)) | (one << (h >> np.uint64(6) & low)) | (one << (h >> np.uint64(12) & low))
    return (h >> np.uint64(32)) * words >> np.uint64(32), mask


def build_segment(keys: np.ndarray, levels: np.ndarray, bits_each: int) -> bytes:
    """A Bloom filter with (key, 1) up to (key, its level) for each key. An entry's bits lie in two words, which costs two reads instead of six."""
    words = np.uint64(max(2, int(levels.sum()) * bits_each // 64 + 1))
    bits = np.zeros(int(words) * 64, dtype=bool)
    level = 1
    while len(keys):
        h = _entries(keys, level)
        for _ in range(REACHED):
            at = (h >> np.uint64(32)) * words >> np.uint64(32) << np.uint64(6)
            for i in range(SET):
                bits[at + (h >> np.uint64(6 * i) & np.uint64(63))] = True
            h = mix(h)
        level += 1
        more = levels >= level
        keys, levels = keys[more], levels[more]
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """The segments of some shards, one after the other."""

    def __init__(self, shards: int, segments: dict[int, bytes]):
        self.shards = shards
        self.size = np.zeros(shards, dtype=np.uint64)
        self.start = np.zeros(shards, dtype=np.uint64)
        at = 0
        for s in sorted(segments):
            self.start[s], self.size[s] = at, len(segments[s]) // 8
            at += len(segments[s]) // 8
        self.data = b"".join(segments[s] for s in sorted(segments))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key; 0 where the filter doesn't hold it, or its shard isn't here."""
        data = np.frombuffer(self.data, dtype=np.uint64)
        out = np.zeros(len(keys), dtype=np.int64)
        shard = shard_of(keys, self.shards)
        size, start = self.size[shard], self.start[shard]
        at = np.flatnonzero(size)
        level = 1
        while len(at) and level < 63:
            h = _entries(keys[at], level)
            for _ in range(REACHED):
                word, mask = _places(h, size[at])
                hit = np.flatnonzero(data[start[at] + word] & mask == mask)
                at, h = at[hit], mix(h[hit])
            out[at] = level
            level += 1
        return out


def _tally(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys held, in order, and their counts. held is emptied."""
    keys = np.concatenate(held)
    held.clear()
    keys.sort()
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[starts], np.diff(starts, append=len(keys)).astype(np.uint32)


def _count(shards: int):
    """Counts of words, pairs and triples, one row for each kind and shard that a task's tokens reach."""

    def rows(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """One kind after the other, SENT_ROWS shards at a time; what is held of a kind goes when it is counted."""
        for kind in (WORD, PAIR, TRIPLE):
            k, c = _tally(held[kind])
            # those of count 1 without their counts
            for part, n in ((k[c == 1], None), (k[c > 1], c[c > 1])):
                reached, cuts = _by_shard(part, shards)
                for i in range(0, len(cuts), SENT_ROWS):
                    some = cuts[i : i + SENT_ROWS]
                    a, b = (some[0][0], some[-1][1])
                    there = reached[i : i + SENT_ROWS]
                    inside = [(x - a, y - a) for x, y in some]
                    keys = pack(part[a:b], _first_of(there, shards), kind, inside)
                    counts = [b""] * len(some)
                    if n is not None:
                        wide, rows = narrow(n[a:b])
                        counts = [bytes((wide,)) + rows[x:y].T.tobytes() for x, y in inside]
                    yield pa.record_batch([pa.array([kind] * len(some), pa.int32()), pa.array(there, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["kind", "shard", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, n = Hashes(), [[], [], []], 0
        for batch in batches:
            for texts in _portions(batch.column(0), SCORED):
                tokens, ends = token_hashes(texts, known)
                pairs = pair_keys(before_each(tokens, ends), tokens)
                triples, there = triple_keys(pairs, tokens, np.concatenate([[0], ends[:-1]]))
                for kind, keys in ((WORD, tokens), (PAIR, pairs), (TRIPLE, triples[there])):
                    held[kind].append(keys)
                n += len(tokens)
                if n >= COUNTED:
                    yield from rows(held)
                    n = 0
        if n:
            yield from rows(held)
        known.clear()
        give_back()

    return run


def _portions(column: pa.Array, chars: int) -> Iterator[list[str | None]]:
    """The texts of a column, about so many characters at a time."""
    texts, size = [], 0
    for t in column:
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= chars:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _sum_shard(bits: int, shards: int):
    def run(table: pa.Table) -> pa.Table:
        """The counts of one kind and shard, with its segment of the filter. Only words keep their counts."""
        kind, first = table["kind"][0].as_py(), int(_first_of(np.array([table["shard"][0].as_py()]), shards)[0])
        parts = [unpack(k, first, kind) for k in table["keys"].to_pylist()]
        counts = np.concatenate([widen(c[1:], c[0]) if c else np.ones(len(k), dtype=np.uint64) for k, c in zip(parts, table["counts"].to_pylist(), strict=True)]).astype(np.int64)
        keys = np.concatenate(parts)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        levels = level_of(counts)
        per_level = np.bincount(levels, minlength=64)[:64].tolist()
        return pa.table({
            "kind": pa.array([kind], pa.int32()), "shard": table["shard"].slice(0, 1), "types": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64()),
            "per_level": pa.array([per_level], pa.list_(pa.int64())), "segment": pa.array([build_segment(keys, levels, bits)], pa.binary()),
            "keys": pa.array([keys.tobytes() if kind == WORD else b""], pa.binary()), "counts": pa.array([counts.astype("<i8").tobytes() if kind == WORD else b""], pa.binary()),
        })

    return run


SHARD = "kind int, shard int, types long, tokens long, per_level array<long>, segment binary, keys binary, counts binary"


def _frequent(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(c, dtype="<i8")
                take = counts >= least
                yield pa.record_batch([pa.array([np.frombuffer(k, dtype="<u8")[take].tobytes()], pa.binary()), pa.array([counts[take].tobytes()], pa.binary())], names=["keys", "counts"])

    return run


def _look_up(keys: np.ndarray, counts: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The counts of the keys asked for, among sorted keys; -1 where a key isn't there."""
    if not len(keys):
        return np.full(len(asked), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, counts[at], -1)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2, bytes_per_shard: int = 2_000_000, top_words: int = 1_000_000, max_broadcast: int = 192_000_000, bits: int = 8) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row. bits: of the filter, for each entry."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (C.fold(F.col(id_col), folds) == held_fold).alias("held_out"))
    size, trained = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))).first()
    shards = max(8, -(-size // bytes_per_shard))
    counted = rows.filter(~F.col("held_out")).select("text").mapInArrow(_count(shards), "kind int, shard int, keys binary, counts binary")
    # the counts that were exchanged are the largest thing on disk, and nothing reads them again
    table = C.materialise(counted.groupBy("kind", "shard").applyInArrow(_sum_shard(bits, shards), SHARD), "ngram-counts", keep_exchanged=False)
    words = table.filter(F.col("kind") == WORD)
    n, v, filter_bytes = table.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == WORD, F.col(c))), F.lit(0)) for c in ("tokens", "types")], F.coalesce(F.sum(F.octet_length("segment")), F.lit(0))).first()

    # at most 64 levels for each kind
    levels = [[0] * 64 for _ in (WORD, PAIR, TRIPLE)]
    for r in table.select("kind", F.posexplode("per_level").alias("level", "n")).groupBy("kind", "level").agg(F.sum("n").alias("n")).collect():
        levels[r.kind][r.level] = r.n
    model = Model(shards, float(n + v + 1), int(level_of(np.array([trained]))[0]) if trained else 0, (prior_weight(levels[WORD], levels[PAIR][1]), prior_weight(levels[PAIR], levels[TRIPLE][1])))

    # exact counts of the most frequent words: as many levels from the top as top_words allows
    least, total = 1 << 62, 0
    for level in range(63, 0, -1):
        total += levels[WORD][level]
        if total > top_words:
            break
        least = 1 << (level - 1)
    top = words.select("keys", "counts").mapInArrow(_frequent(least), "keys binary, counts binary").filter("length(keys) > 0").collect()
    top_keys = np.concatenate([np.frombuffer(r[0], dtype="<u8") for r in top] or [np.zeros(0, np.uint64)])
    top_counts = np.concatenate([np.frombuffer(r[1], dtype="<i8") for r in top] or [np.zeros(0, np.int64)])
    order = np.argsort(top_keys)
    frequent = sc.broadcast((top_keys[order], top_counts[order]))
    del top, top_keys, top_counts

    state = rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "doc_id", "held_out", "text")
    final = "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, shard int, keys binary, uids binary"
    sent, used = None, [frequent]
    if filter_bytes <= max_broadcast:
        # one kind after the other, so that the driver holds no segment twice but those of one kind
        held = sc.broadcast(tuple(Filter(shards, {r.shard: bytes(r.segment) for r in table.filter(F.col("kind") == kind).select("shard", "segment").toLocalIterator()}) for kind in (WORD, PAIR, TRIPLE)))
        used.append(held)
        state = C.materialise(state.mapInArrow(_score_by_broadcast(held, frequent, model), final), "lm-scores")
    else:
        # portions are rows of a megabyte or two: small row groups keep few of them in memory
        sent = C.materialise(state.mapInArrow(_heads, HEADS), "lm-texts", compression="zstd", **{"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 4})
        states = []
        for i in range(ROUNDS):
            some = sent.filter(F.pmod(F.xxhash64("pid"), F.lit(ROUNDS)) == i)
            asked = some.select("pid", "ends", "words", "tokens").mapInArrow(_probes(shards), "pid long, kind int, shard int, keys binary")
            where = ["kind", "shard"]
            answers = asked.groupBy(*where).cogroup(table.select(*where, "segment").groupBy(*where)).applyInArrow(_answer(shards), "pid long, kind int, shard int, levels binary")
            states.append(C.materialise(some.groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(_assemble(frequent, model), final), "lm-scores", keep_exchanged=False))
        state = reduce(DataFrame.unionByName, states)
    # what follows reads tables alone
    for shared in used:
        shared.destroy()
    if sent is not None:
        C.discard(sent)

    rare = state.filter("shard is not null").select("shard", "keys", "uids")
    exact = words.select("shard", F.col("keys").alias("word_keys"), F.col("counts").alias("word_counts"))
    sums = rare.groupBy("shard").cogroup(exact.groupBy("shard")).applyInArrow(_exact_sums, "uid long, more_known long, more_base double")
    sums = sums.groupBy("uid").agg(F.sum("more_known").alias("more_known"), F.sum("more_base").alias("more_base"))
    found = state.filter("shard is null").join(sums, "uid", "left")
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score",
    )


def _exact_sums(rare: pa.Table, exact: pa.Table) -> pa.Table:
    """For each row of docs, how many of its rare words this shard knows, and the sum of log10(c + 1)."""
    uids = np.concatenate([np.frombuffer(u, dtype="<i8") for u in rare["uids"].to_pylist()] or [np.zeros(0, np.int64)])
    asked = np.concatenate([np.frombuffer(k, dtype="<u8") for k in rare["keys"].to_pylist()] or [np.zeros(0, np.uint64)])
    keys = np.concatenate([np.frombuffer(k, dtype="<u8") for k in exact["word_keys"].to_pylist()] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(c, dtype="<i8") for c in exact["word_counts"].to_pylist()] or [np.zeros(0, np.int64)])
    c = np.maximum(_look_up(keys, counts, asked), 0)
    who, at = np.unique(uids, return_inverse=True)
    known = np.bincount(at, weights=c > 0, minlength=len(who)).astype(np.int64)
    base = np.bincount(at, weights=np.log10(c + 1.0), minlength=len(who))
    return pa.table({"uid": pa.array(who, pa.int64()), "more_known": pa.array(known, pa.int64()), "more_base": pa.array(base, pa.float64())})


@dataclass
class Model:
    """What scores need besides the filter. total: N + V + 1."""

    shards: int
    total: float
    start_level: int
    mu: tuple[float, float]


NAMES = ["uid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "shard", "keys", "uids"]
HEADS = "pid long, uids binary, ids binary, nulls binary, held binary, ends binary, words binary, tokens binary"


def _scored(uid: np.ndarray, doc_id: pa.Array, held_out: pa.Array, tokens: np.ndarray, ends: np.ndarray, levels: list[np.ndarray], frequent: tuple[np.ndarray, np.ndarray], model: Model) -> Iterator[pa.RecordBatch]:
    """The rows of some documents; then, by shard, their words that no exact count is at hand for."""
    starts = np.concatenate([[0], ends[:-1]])
    distinct, back = np.unique(tokens, return_inverse=True)
    exact = _look_up(*frequent, distinct)[back]
    logs = log_probabilities(*levels, starts, model.start_level, model.total, model.mu)
    sure = exact >= 0
    n_tokens = ends - starts
    base = np.add.reduceat(np.where(sure, np.log10(np.maximum(exact, 0) + 1.0), 0.0), starts) - n_tokens * math.log10(model.total)
    known = np.add.reduceat((sure & (exact > 0)).astype(np.int64), starts)
    m = len(ends)
    yield pa.record_batch(
        [pa.array(uid, pa.int64()), doc_id, held_out, pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.add.reduceat(logs, starts), pa.float64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())],
        names=NAMES,
    )
    # the filter has no false negatives: a word of level 0 has no count
    rare = np.flatnonzero(~sure & (levels[WORD] > 0))
    if len(rare):
        keys, owner = tokens[rare], np.repeat(uid, n_tokens)[rare]
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        there, cuts = _by_shard(keys, model.shards)
        k = len(there)
        yield pa.record_batch(
            [*(pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())), pa.array(there, pa.int32()),
             pa.array([keys[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([owner[a:b].tobytes() for a, b in cuts], pa.binary())], names=NAMES,
        )


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The shards that sorted keys reach, in order, and where each one's keys lie."""
    to = shard_of(keys, shards)
    first = np.flatnonzero(np.diff(to, prepend=-1))
    return to[first], list(zip(first.tolist(), [*first[1:].tolist(), len(to)], strict=False))


def _ngrams(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, triples, and whether a triple is there."""
    pairs = pair_keys(before_each(tokens, ends), tokens)
    return pairs, *triple_keys(pairs, tokens, np.concatenate([[0], ends[:-1]]))


def _score_by_broadcast(held, frequent, model: Model):
    """Levels from the filter that every worker has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        (words, pairs, triples), known = held.value, Hashes()
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(3), SCORED):
                part = batch.slice(at, len(texts))
                at += len(texts)
                tokens, ends = token_hashes(texts, known)
                pair, triple, there = _ngrams(tokens, ends)
                distinct, back = np.unique(tokens, return_inverse=True)
                pair_levels, triple_levels = pairs.levels(pair), np.zeros(len(tokens), dtype=np.int64)
                # a triple is in the filter only if its pairs are
                ask = np.flatnonzero(there & (pair_levels > 0))
                triple_levels[ask] = triples.levels(triple[ask])
                yield from _scored(np.asarray(part.column(0)), part.column(1), part.column(2), tokens, ends, [words.levels(distinct)[back], pair_levels, triple_levels], frequent.value, model)

    return run


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each portion of text a row with its documents, its distinct words in order, and its tokens as numbers of those."""
    known = Hashes()
    for batch in batches:
        at = 0
        for texts in _portions(batch.column(3), ASKED):
            part = batch.slice(at, len(texts))
            at += len(texts)
            tokens, ends = token_hashes(texts, known)
            words, back = np.unique(tokens, return_inverse=True)
            wide, rows = narrow(back.astype(np.uint64))
            uid = np.asarray(part.column(0))
            row = (
                int(uid[0]), uid.astype("<i8").tobytes(), np.asarray(part.column(1).fill_null(0)).astype("<i8").tobytes(), np.asarray(part.column(1).is_null()).tobytes(), np.asarray(part.column(2)).astype(bool).tobytes(),
                ends.astype("<i8").tobytes(), words.tobytes(), bytes((wide,)) + rows.T.tobytes(),
            )
            yield pa.record_batch([pa.array([x], pa.int64() if i == 0 else pa.binary()) for i, x in enumerate(row)], names=[x.split()[0] for x in HEADS.split(", ")])
    known.clear()
    give_back()


def _read(words: bytes, tokens: bytes, ends: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A portion's distinct words, its tokens as numbers of them and as hashes, and its ends."""
    distinct = np.frombuffer(words, dtype="<u8")
    back = widen(tokens[1:], tokens[0]).astype(np.int64)
    return distinct, back, distinct[back], np.frombuffer(ends, dtype="<i8")


def _probes(shards: int):
    """For each portion, kind and shard a row with the distinct keys to be looked up, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pid, ends, words, tokens in zip(*batch.columns, strict=True):
                distinct, _, tokens, ends = _read(words.as_py(), tokens.as_py(), ends.as_py())
                pair, triple, there = _ngrams(tokens, ends)
                for kind, keys in ((WORD, distinct), (PAIR, np.unique(pair)), (TRIPLE, np.unique(triple[there]))):
                    to, cuts = _by_shard(keys, shards)
                    if cuts:
                        packed = pack(keys, _first_of(to, shards), kind, cuts)
                        yield pa.record_batch([pa.array([pid.as_py()] * len(to), pa.int64()), pa.array([kind] * len(to), pa.int32()), pa.array(to, pa.int32()), pa.array(packed, pa.binary())], names=["pid", "kind", "shard", "keys"])
        give_back()

    return run


def _answer(shards: int):
    def run(asked: pa.Table, segments: pa.Table) -> pa.Table:
        """The levels of the keys that the portions ask of one shard, in the order of the keys."""
        n, pids = asked.num_rows, asked["pid"]
        kind, shard = (asked["kind"][0].as_py(), asked["shard"][0].as_py()) if n else (0, 0)
        first = int(_first_of(np.array([shard]), shards)[0])
        parts = [unpack(k, first, kind) for k in asked["keys"].to_pylist()]
        keys = np.concatenate(parts or [np.zeros(0, np.uint64)])
        levels = Filter(1, {0: segments["segment"][0].as_py()}).levels(keys) if segments.num_rows and n else np.zeros(len(keys), dtype=np.int64)
        cuts = np.cumsum([0] + [len(k) for k in parts]).tolist()
        levels = levels.astype(np.uint8).tobytes()
        return pa.table({"pid": pids, "kind": asked["kind"], "shard": asked["shard"], "levels": pa.array([levels[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())})

    return run


def _assemble(frequent, model: Model):
    def run(heads: pa.Table, answers: pa.Table) -> pa.Table:
        """The scores of one portion's documents."""
        get = lambda c, t: np.frombuffer(heads[c][0].as_py(), dtype=t)
        uid, ids, nulls, held = (get(c, t) for c, t in (("uids", "<i8"), ("ids", "<i8"), ("nulls", bool), ("held", bool)))
        _, back, tokens, ends = _read(*(heads[c][0].as_py() for c in ("words", "tokens", "ends")))
        pair, triple, there = _ngrams(tokens, ends)
        kinds, shard, levels = np.asarray(answers["kind"]), np.asarray(answers["shard"]), answers["levels"]

        def answered(kind: int) -> np.ndarray:
            """Levels of the distinct keys in order: a shard's keys lie together, before those of the next."""
            mine = np.flatnonzero(kinds == kind)
            return np.frombuffer(b"".join(levels[i].as_py() for i in mine[np.argsort(shard[mine])].tolist()), dtype=np.uint8).astype(np.int64)

        triple_levels = np.zeros(len(tokens), dtype=np.int64)
        triple_levels[there] = answered(TRIPLE)[np.unique(triple[there], return_inverse=True)[1]]
        pair_levels = answered(PAIR)[np.unique(pair, return_inverse=True)[1]]
        triple_levels[pair_levels == 0] = 0
        return pa.Table.from_batches(_scored(uid, pa.array(ids, pa.int64(), mask=nulls), pa.array(held, pa.bool_()), tokens, ends, [answered(WORD)[back], pair_levels, triple_levels], frequent.value, model))

    return run
