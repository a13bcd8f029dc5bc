"""Hashed linear models: bounded training samples, follow-the-regularised-leader, scoring.

A model is a float32 vector of 2**bits weights and a bias; its size is fixed by
``bits``, so that it can be broadcast whatever the corpus. A document's features
enter with the value 1/sqrt(number of its features), so a score is
``bias + sum(weights) / sqrt(n)`` - a sparse dot product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .runtime import arrow_map, binary


@dataclass
class Linear:
    weights: np.ndarray
    bias: float = 0.0

    def margins(self, index: np.ndarray, bound: np.ndarray) -> np.ndarray:
        n = np.maximum(np.diff(bound), 1)
        return self.bias + A.per_row(self.weights[index].astype(np.float64), bound) / np.sqrt(n)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def sample_ids(labels: DataFrame, label: str, limit: int, keep: Column | None = None) -> DataFrame:
    """(doc_id, y) of at most ``limit`` labelled rows, chosen by a hash of doc_id.

    Null ids and labels are left out; of several labels of one id the largest counts.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    rows = rows.where(keep) if keep is not None else rows
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def training_rows(docs: DataFrame, ids: DataFrame, bits: int, **features) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Sparse feature rows of the sampled documents: (feature numbers, values, label), in order of id."""

    def rows(batch: pa.RecordBatch) -> dict:
        data, off = A.column_bytes(batch.column("text"))
        index, count = [], []
        for _, _, d, o in A.blocks(data, off):
            found, bound = A.ngram_features(d, o, bits, **features)
            for i in range(len(o) - 1):
                u, c = np.unique(found[bound[i] : bound[i + 1]], return_counts=True)
                index.append(u.astype(np.int32))
                count.append((c / np.sqrt(max(c.sum(), 1))).astype(np.float32))
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "index": binary(index), "value": binary(count)}

    joined = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("y").cast("int").alias("y"))
    got = arrow_map(joined, rows, "doc_id string, y int, index binary, value binary").toArrow()
    views = [_views(got.column(c), t) for c, t in (("index", np.int32), ("value", np.float32))]
    out = list(zip(got.column("doc_id").to_pylist(), *views, got.column("y").to_pylist(), strict=True))
    out.sort(key=lambda r: (r[0], len(r[1])))
    return [r[1:] for r in out]


def _views(column: pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    """The binary values of a column as arrays over its own buffers, without a copy."""
    out = []
    for chunk in column.chunks:
        data, off = A.column_bytes(chunk)
        out += [data[a:b].view(dtype) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
    return out


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], size: int, *, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> Linear:
    """Logistic regression by per-coordinate FTRL-proximal updates, one row at a time.

    z and n are kept for each coordinate; the weight is the closed-form minimiser
    of the linearised loss plus the L1 and L2 terms, and is zero while |z| <= l1.
    """
    z, n = np.zeros(size), np.zeros(size)
    zb = nb = 0.0
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            index, value, y = rows[k]
            zi, ni = z[index], n[index]
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)
            b = -zb / ((beta + np.sqrt(nb)) / alpha)
            loss = 1.0 / (1.0 + np.exp(-min(max(b + float(w @ value), -35.0), 35.0))) - y
            g = loss * value
            g2 = g * g
            z[index] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[index] = ni + g2
            zb += loss - (np.sqrt(nb + loss * loss) - np.sqrt(nb)) / alpha * b
            nb += loss * loss
    w = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    return Linear(w.astype(np.float32), float(-zb / ((beta + np.sqrt(nb)) / alpha)))


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into calibrated probabilities (Newton steps on log loss)."""
    if len(y) < 10 or y.min() == y.max():
        return 1.0, 0.0
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], 1)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(30):
        p = sigmoid(a * margin + b)
        grad = x.T @ (p - target) + 1e-3 * np.array([a - 1, b])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)
