"""Quality by compression.

Two zstandard dictionaries are trained, one from good and one from bad labelled texts. A text
is compressed with each, in blocks of `block_bytes`, as a compressor that has seen much of a long text owes little to its
dictionary. The difference of the two compressed sizes, normalised by the text's size and by the sum of both sizes,
goes through a logistic function fitted on the half of the sample that trained no dictionary. Nothing else enters the score.

A null or empty text has differences of next to 0. Texts are compressed whole. Rows that repeat an id are
scored each by its own text. Where a class gives too little text for a dictionary, its text
itself serves as one. Without labels of both classes every score is the smoothed share of
good labels. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import labelled

PIECE, FEATURES = 4096, 2


def _train(size: int, level: int):
    def run(table: pa.Table) -> pa.Table:
        """The dictionary of one class, from its whole texts in pieces, in the order of their hashes."""
        order = np.argsort(table["h"].to_numpy(), kind="stable")
        pieces: list[bytes] = []
        for i in order:
            b = table["text"][int(i)].as_py().encode()
            pieces += [b[k : k + PIECE] for k in range(0, len(b), PIECE)]
        try:
            data, kind = zstandard.train_dictionary(size, pieces, level=level).as_bytes(), 1
        except zstandard.ZstdError:
            data, kind = b"\n".join(pieces)[:size], 0
        return pa.table({"y": pa.array([table["y"][0].as_py()], pa.int32()), "kind": pa.array([kind], pa.int32()), "data": pa.array([data], pa.binary())})

    return run


class Judge:
    """Compressors with the dictionaries of bad (0) and good (1) text."""

    def __init__(self, dictionaries: dict[int, tuple[int, bytes]], level: int, block: int, logit: np.ndarray):
        self.given, self.level, self.block, self.logit = dictionaries, level, block, logit
        self.compressors: list = []

    def __getstate__(self):
        return {**self.__dict__, "compressors": []}

    def features(self, text: str) -> tuple[float, ...]:
        if not self.compressors:
            for y in (0, 1):
                kind, data = self.given[y]
                d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if kind else zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=self.level)
                self.compressors.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        b = text.encode()
        blocks = [b[i : i + self.block] for i in range(0, len(b), self.block)] or [b]
        bad, good = (sum(len(c.compress(x)) for x in blocks) for c in self.compressors)
        return (bad - good) / (len(b) + 20), (bad - good) / (bad + good)

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.given) < 2:
            return labelled.probability(np.zeros((len(texts), FEATURES)), self.logit)
        return labelled.probability(np.array([self.features(t) for t in texts]).reshape(-1, FEATURES), self.logit)


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = 8_000, dictionary_bytes: int = 110_000, level: int = 3, block_bytes: int = 1024) -> Judge:
    """Learns from about max_rows labelled rows: one half trains the dictionaries, the other the calibration."""
    sample = C.materialise(labelled.training_sample(docs, labels, "quality", max_rows=max_rows, seed=5), "quality-sample")
    texts = sample.filter("half = 0 and text <> ''").select("text", "y", F.xxhash64("doc_id").alias("h"))
    rows = texts.groupBy("y").applyInArrow(_train(dictionary_bytes, level), "y int, kind int, data binary").collect()
    judge = Judge({int(r.y == 1): (r.kind, bytes(r.data)) for r in rows}, level, block_bytes, np.zeros(FEATURES + 1))
    plain = docs.sparkSession.sparkContext.broadcast(judge)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = plain.value
        for batch in batches:
            x = [j.features(t.as_py()) if len(j.given) == 2 else (0.0,) * FEATURES for t in batch.column(0)]
            yield pa.record_batch([batch.column(1), pa.array([list(f) for f in x], pa.list_(pa.float64()))], names=["y", "x"])

    # about max_rows / 2 rows of three numbers
    rows = sample.filter("half = 1").select("text", "y").mapInArrow(measure, "y int, x array<double>").collect()
    judge.logit = labelled.fit_logistic(np.array([r.x for r in rows]).reshape(-1, FEATURES), np.array([r.y == 1 for r in rows], dtype=float), ridge=1e-6)
    C.discard(sample)
    return judge


def score_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    judge = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = judge.value
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(j.scores([t.as_py() or "" for t in batch.column(1)]), pa.float64())], names=["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", (C.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
