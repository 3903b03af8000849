"""What the two classifiers share: bounded samples of labelled rows and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C


def _uniform(seed: int, doc_id: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11).cast("double") * F.lit(2.0**-53)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, *, max_rows: int, folds: int = 5, seed: int = 1) -> DataFrame:
    """doc_id, text, y, half (0 or 1) of about max_rows labelled rows whose fold isn't 0, drawn by a hash of the id.

    Where a document has several labels the largest counts; labels that are null, or of documents that aren't there, don't.
    """
    known = labels.filter(F.col(label).isNotNull() & (C.fold(F.col("doc_id"), folds) != 0)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n = known.count()
    drawn = known.filter(_uniform(seed, F.col("doc_id")) < F.lit(min(1.0, max_rows / max(n, 1))))
    half = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(2)).cast("int")
    # at most about max_rows rows of two numbers
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id").withColumn("half", half)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights, the intercept last, by Newton's method; with one class or none only a smoothed intercept."""
    n, k = x.shape if x.size else (len(y), x.shape[1] if x.ndim == 2 else 0)
    w = np.zeros(k + 1)
    base = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(base / (1 - base))
    if not 0 < y.sum() < n:
        return w
    a = np.hstack([x, np.ones((n, 1))])
    penalty = ridge * n * np.eye(k + 1)
    penalty[-1, -1] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - penalty @ w
        curve = (a * (p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(k + 1)
        step = np.linalg.solve(curve, gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
