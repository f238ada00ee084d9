"""Labelled rows for fitting: the split by crc32 and a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows kept out of all fitting: crc32 of the id as text is divisible by FOLDS (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of labelled rows that are not held out; about `max_rows` when there are more.

    Rows are picked by a hash of their id, so the same ones come back on every run and in every partitioning.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(rows, "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic regression, by Newton's method; the bias is not penalised."""
    if not len(y):
        return np.zeros(x.shape[1]), 0.0
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge * len(y) / 100), 1e-3)
    for _ in range(steps):
        p = sigmoid(a @ w)
        gradient = a.T @ (p - y) + penalty * w
        curve = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))
