"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are runs of letters, lower-cased. A token's evidence is the number of distinct
contexts (token before, token, token after) it has in toxic and in other labelled texts, so
that copies of a text don't count again. Its score is the log-odds of the two classes under a
hierarchy of Dirichlet priors: of `prior` contexts shared like those of its prefix of seven
letters, whose prior is shared like the prefix of six, and so down to three letters and to the classes as a whole. So
inflected forms that the sample lacks are judged by their stem, and words of little evidence
stay neutral. Log-odds nearer to 0 than `least_weight` count as 0, at every size of sample. A drift is taken off, so
that the expected score of ordinary text is negative. In a text, too, a context counts once. A linear-time scan
finds all maximal scoring segments of a text (Ruzzo and Tompa). The best segments of clean
texts follow an extreme-value law; lambda and K are fitted on the half of the sample that
gave no counts. A segment's evidence is how far lambda S exceeds ln(K n), the size that chance brings about in
n tokens; it is significant if the number of chance finds, K n exp(-lambda S), is small. The document's score is a
logistic function, fitted on that same half, of the evidence of its best segment and of the sum of the evidence of all
its segments.

A null or empty text, or one without letters, has no segments and gets the score of such texts. Texts are
scanned whole. Rows that repeat an id are scored each by its own text. Without labels of
both classes every score is the smoothed share of toxic labels. Other columns than
doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import labelled

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the prefixes that stand in for a word.
STEMS = (3, 4, 5, 6, 7)
#: Words whose weights a worker remembers.
REMEMBERED = 400_000
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end exclusive, sum) in linear time; runs of negative scores cost one addition each."""
    found: list[list] = []  # [begin, end, sum before, sum with]
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(b, e, right - left) for b, e, left, right, _ in found]


class Lookup(dict):
    """Weights of tokens as they were asked for, up to a bound: the token's own, else that of its longest known prefix, else None. None as well where they are neutral."""

    def __init__(self, weights: dict[str, float], stems: dict[str, float], neutral: float):
        super().__init__()
        self.weights, self.stems, self.neutral = weights, stems, neutral

    def __missing__(self, token: str) -> float | None:
        if len(self) >= REMEMBERED:
            self.clear()
        w = self.weights[token] if token in self.weights else next((self.stems[token[:n]] for n in STEMS[::-1] if len(token) > n and token[:n] in self.stems), None)
        w = self[token] = None if w == self.neutral else w
        return w


@dataclass
class ToxicModel:
    """weights: of tokens and of their prefixes, drift taken off; others score -drift."""

    weights: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    drift: float = 0.4
    lam: float = 1.0
    k: float = 1.0
    significant: float = 0.05
    logit: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, 0.0]))
    cut: float = 0.5
    lookup: Lookup | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "lookup": None}

    def segments(self, tokens: list[str]) -> list[tuple[int, int, float]]:
        """Segments of the text; only tokens that have a weight are visited, the gaps between them score by their length.

        A context counts once in a text, as in the evidence; the tokens of its repeats are neutral.
        """
        if self.lookup is None:
            self.lookup = Lookup(self.weights, self.stems, -self.drift)
        at, contexts = [], set()
        for i, w in enumerate(map(self.lookup.__getitem__, tokens)):
            if w is not None:
                context = (*tokens[max(0, i - 1) : i + 2],)
                if context not in contexts:
                    contexts.add(context)
                    at.append((i, w))
        if not at:
            return []
        scores, place, last = [], [], -1
        for i, w in at:
            if i - last > 1:
                scores.append(-self.drift * (i - last - 1))
                place.append(last + 1)
            scores.append(w)
            place.append(i)
            last = i
        return [(place[b], place[e - 1] + 1, s) for b, e, s in maximal_segments(scores)]

    def expected(self, score: float, n: int) -> float:
        """Chance finds of this score in n tokens."""
        return self.k * n * float(np.exp(-self.lam * score))

    def features(self, scores: list[float], n: int) -> tuple[float, float]:
        """Logs of the best segment's evidence and of the sum of all evidence."""
        evidence = [e for e in (self.lam * s - np.log(self.k * n) for s in scores) if e > 0]
        return float(np.log1p(max(evidence, default=0.0))), float(np.log1p(sum(evidence)))

    def judge(self, text: str) -> tuple[float, list[dict]]:
        """The text's score and its significant passages, by code point."""
        tokens = [t.lower() for t in WORD.findall(text)]
        n = len(tokens)
        segments = self.segments(tokens)
        x = np.array([self.features([s for _, _, s in segments], n)])
        passages = [(b, e, s) for b, e, s in segments if self.expected(s, n) < self.significant]
        if passages:
            spans = [m.span() for m in WORD.finditer(text)]
            passages = [{"start": spans[b][0], "end": spans[e - 1][1], "score": s, "expected": self.expected(s, n)} for b, e, s in passages]
        return float(labelled.probability(x, self.logit)[0]), passages


def _fit_tail(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and K from the best segment scores of clean texts, by two quantiles, which a few mislabelled texts don't move."""
    lam, (low, high) = 1.0, (0.5, 0.9)
    if len(best) < 20 or best.std() == 0:
        return lam, 1.0
    law = lambda q: -np.log(-np.log(q))
    for _ in range(50):
        a, b = np.quantile(best - np.log(n) / lam, (low, high))
        lam = 0.5 * lam + 0.5 * float((law(high) - law(low)) / max(b - a, 1e-6))
    mode = np.quantile(best - np.log(n) / lam, low) - law(low) / lam
    return lam, float(np.exp(np.clip(lam * mode, -300, 300)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, label, context) of each batch."""
    for batch in batches:
        seen = set()
        for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            t = [w.lower() for w in WORD.findall(text.as_py())]
            for a, b, c in zip(["", *t], t, [*t[1:], ""], strict=False):
                seen.add((b, y, xxhash.xxh3_64_intdigest(f"{a} {b} {c}") - (1 << 63)))
        words, ys, contexts = zip(*seen, strict=True) if seen else ((), (), ())
        yield pa.record_batch([pa.array(words, pa.string()), pa.array(ys, pa.int32()), pa.array(contexts, pa.int64())], names=["word", "y", "context"])


def _entries(counts: DataFrame, prior: float, root: float, least: float) -> DataFrame:
    """entry, word (whether it is one, else a prefix), w: log-odds under the hierarchy of priors, 0 where nearer to 0 than least.

    counts: word, bad, good. Entries that are neutral like all their prefixes are left out: a lookup finds nothing for them
    either way. One shuffle, by the first letters, serves the sums of all prefixes.
    """
    rows = counts.withColumns({f"p{n}": F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEMS})
    for n in STEMS[::-1]:
        alike = Window.partitionBy(*[f"p{m}" for m in STEMS if m <= n])
        rows = rows.withColumns({f"{c}{n}": F.sum(c).over(alike) for c in ("bad", "good")})
    logit = lambda s: F.log(s) - F.log1p(-s) - F.lit(float(np.log(root / (1 - root))))
    rows, found = rows.withColumns({"share": F.lit(root), "strong": F.lit(False)}), []
    for n in [*STEMS, ""]:
        there = F.col(f"p{n}").isNotNull() if n else F.lit(True)
        here = (F.col(f"bad{n}") + prior * F.col("share")) / (F.col(f"bad{n}") + F.col(f"good{n}") + prior)
        rows = rows.withColumn("share", F.when(there, here).otherwise(F.col("share"))).withColumn(f"w{n}", logit(F.col("share")))
        rows = rows.withColumn("strong", F.col("strong") | (F.abs(f"w{n}") >= least)).withColumn(f"strong{n}", there & F.col("strong"))
        found.append(F.struct(F.col(f"p{n}" if n else "word").alias("entry"), F.lit(not n).alias("word"), F.when(F.abs(f"w{n}") >= least, F.col(f"w{n}")).otherwise(0.0).alias("w"), F.col(f"strong{n}").alias("strong")))
    return rows.select(F.inline(F.array(*found))).filter("strong").select("entry", "word", "w").distinct()


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = 12_000, prior: float = 12.0, drift: float = 0.4, least_weight: float = 1.0, clean_loss: float = 0.005) -> ToxicModel:
    """Learns from about max_rows labelled rows: one half gives the counts, the other the tail, the calibration and the cut.

    What it broadcasts is bounded by the words of these rows. The cut is the lowest score, at most 0.5, that no more than
    clean_loss of the clean rows of the second half reach.
    """
    sample = C.materialise(labelled.training_sample(docs, labels, "toxic", max_rows=max_rows), "toxic-sample")
    contexts = sample.filter("half = 0").select("text", "y").mapInArrow(_contexts, "word string, y int, context long").distinct()
    counts = C.materialise(contexts.groupBy("word").agg(F.count_if(F.col("y") == 1).alias("bad"), F.count_if(F.col("y") != 1).alias("good")), "toxic-counts")
    bad, good = counts.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    model = ToxicModel(drift=drift)
    if bad and good:
        for r in _entries(counts, prior, bad / (bad + good), least_weight).toLocalIterator():
            (model.weights if r.word else model.stems)[r.entry] = r.w - drift
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = weights.value
        for batch in batches:
            rows = []
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                t = [w.lower() for w in WORD.findall(text.as_py())]
                rows.append((y, len(t), [s for _, _, s in m.segments(t)]))
            ys, ns, scores = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([pa.array(ys, pa.int32()), pa.array(ns, pa.int64()), pa.array(scores, pa.list_(pa.float64()))], names=["y", "n", "scores"])

    # about max_rows / 2 rows
    rows = sample.filter("half = 1").select("text", "y").mapInArrow(measure, "y int, n long, scores array<double>").collect()
    y = np.array([r.y == 1 for r in rows], dtype=float)
    clean = [(max(r.scores), r.n) for r in rows if r.y != 1 and r.scores]
    if clean:
        model.lam, model.k = _fit_tail(np.array([c[0] for c in clean]), np.array([c[1] for c in clean], dtype=float))
    x = np.array([model.features(r.scores, r.n) for r in rows]).reshape(-1, 2)
    model.logit = labelled.fit_logistic(x, y)
    model.cut = _cut(labelled.probability(x, model.logit)[y == 0], clean_loss)
    C.discard(sample, counts)
    return model


def _cut(clean: np.ndarray, loss: float) -> float:
    """The lowest score, at most 0.5, that no more than this share of the clean rows' scores reach."""
    if not len(clean):
        return 0.5
    order = np.sort(clean)[::-1]
    return float(min(0.5, np.nextafter(order[min(int(loss * len(order)), len(order) - 1)], 1.0)))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted and the significant passages (start, end, score, expected) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            judged = [m.judge(t.as_py() or "") for t in batch.column(1)]
            passages = pa.array([p for _, p in judged], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])))
            yield pa.record_batch([batch.column(0), pa.array([s for s, _ in judged], pa.float64()), passages], names=["doc_id", "score", "passages"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, score double, passages {PASSAGES}")
    return found.select("doc_id", (C.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float | None = None, **options) -> DataFrame:
    """The rows of docs whose text isn't judged toxic, with all their columns, in one pass. threshold: the model's cut unless given."""
    fitted = fit(docs, labels, **options)
    model, threshold = docs.sparkSession.sparkContext.broadcast(fitted), fitted.cut if threshold is None else threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield batch.filter(pa.array([m.judge(t.as_py() or "")[0] < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
