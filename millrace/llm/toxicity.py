"""Toxicity by a classifier chain over hashed word features.

The labels hold one flag, so the chain's categories are found in the training
sample: term families are picked greedily, each the word feature that marks the
most toxic rows not yet covered while hardly marking clean ones. Category k is
"toxic and of family k"; the last category is the flag itself. Categories are
predicted in order. The linear model of each is an FTRL-trained logistic
regression that sees the words and the probabilities of all earlier categories;
in training these are out-of-fold predictions, so that later models learn from
probabilities as honest as those at scoring time.

Defined results. Null and empty texts have no features and score by the biases.
Repeated rows score alike. Without rows labelled toxic every score is near 0 and
nothing is flagged. Only ``doc_id`` and ``text`` are read. Texts are scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .linear import Linear, fit_ftrl, sample_ids, sigmoid
from .runtime import arrow_map, binary, prepare

BITS = 18
MAX_TRAINING_ROWS = 3000
FAMILIES = 3
FOLDS = 5
#: Probability of the last category from which a row is flagged.
FLAG_AT = 0.3

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def word_features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and rows of every letter-digit run: the whole run and its 4-, 5- and 6-byte beginnings."""
    start, end = A.spans(_IN_WORD[data], off)
    row = np.searchsorted(off, start, "right") - 1
    low = A.LOWER[data]
    index, rows = [A.span_hash(low, start, end)], [row]
    for n in (4, 5, 6):
        long = end - start > n
        index.append(A.mix(A.span_hash(low, start[long], start[long] + n) + np.uint64(n)))
        rows.append(row[long])
    return (np.concatenate(index) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(rows)


@dataclass
class Chain:
    """One linear model per category; weights past 2**bits are those of earlier probabilities."""

    models: list[Linear]
    bits: int = BITS

    def probabilities(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rows x categories."""
        n, base = len(off) - 1, 1 << self.bits
        index, row = word_features(data, off, self.bits)
        used = np.zeros(base, bool)
        for m in self.models:
            used |= m.weights[:base] != 0
        here = used[index]
        key = np.unique(row[here] * base + index[here])  # presence, not counts
        row, index = key // base, key % base
        out = np.zeros((n, len(self.models)))
        for k, m in enumerate(self.models):
            z = m.bias + np.bincount(row, m.weights[index].astype(np.float64), n)
            out[:, k] = sigmoid(z + out[:, :k] @ m.weights[base : base + k].astype(np.float64))
        return out


def _with(rows: list, y: np.ndarray, before: np.ndarray, base: int) -> list:
    extra = np.arange(base, base + before.shape[1])
    return [(np.concatenate([i, extra]), np.concatenate([np.ones(len(i)), before[k]]), y[k]) for k, i in enumerate(rows)]


def _families(rows: list[np.ndarray], y: np.ndarray, base: int, count: int) -> list[np.ndarray]:
    clean = np.zeros(base, np.int64)
    for i, t in zip(rows, y, strict=True):
        if not t:
            clean[i] += 1
    left, out = [k for k in range(len(y)) if y[k]], []
    for _ in range(count):
        seen = np.zeros(base, np.int64)
        for k in left:
            seen[rows[k]] += 1
        best = int((seen - 5 * clean).argmax()) if left else -1
        if best < 0 or seen[best] - 5 * clean[best] < 5:
            break
        out.append(np.array([bool(t) and best in i for i, t in zip(rows, y, strict=True)]))
        left = [k for k in left if best not in rows[k]]
    return out


def fit_chain(rows: list[np.ndarray], y: np.ndarray, bits: int = BITS, families: int = FAMILIES) -> Chain:
    """Fits the chain on rows of distinct feature numbers and their flags."""
    base = 1 << bits
    if not y.any():
        return Chain([Linear(np.zeros(base + 1, np.float32), -10.0)], bits)
    targets = [*_families(rows, y, base, families), y.astype(bool)]
    size, before, models = base + len(targets), np.zeros((len(rows), 0)), []
    fold = np.arange(len(rows)) % FOLDS
    options = {"epochs": 4, "alpha": 0.3, "l1": 3.0, "l2": 0.1}  # few weights: a toxic word is rare among harmless ones
    for target in targets:
        all_rows = _with(rows, target.astype(float), before, base)
        models.append(fit_ftrl(all_rows, size, **options))
        held = np.full(len(rows), 0.5)
        for f in range(FOLDS if len(targets) > len(models) else 0):
            m = fit_ftrl([r for r, g in zip(all_rows, fold, strict=True) if g != f], size, **options)
            for k in np.flatnonzero(fold == f):
                index, value, _ = all_rows[k]
                held[k] = sigmoid(np.array(m.bias + float(m.weights[index] @ value)))
        before = np.column_stack([before, held])
    return Chain(models, bits)


def train(docs: DataFrame, labels: DataFrame, *, limit: int = MAX_TRAINING_ROWS, bits: int = BITS) -> Chain:
    """Fits on at most ``limit`` labelled rows."""
    prepare(docs.sparkSession)

    def rows(batch: pa.RecordBatch) -> dict:
        parts = []
        for _, _, d, o in A.blocks(*A.column_bytes(batch.column("text"))):
            index, row = word_features(d, o, bits)
            parts += [np.unique(index[row == k]) for k in range(len(o) - 1)]
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "index": binary(parts)}

    ids = sample_ids(labels, "toxic", limit)
    joined = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y")
    got = arrow_map(joined, rows, "doc_id string, y int, index binary").toArrow()
    found = sorted(zip(*(got.column(c).to_pylist() for c in ("doc_id", "y", "index")), strict=True), key=lambda r: (r[0], len(r[2])))
    return fit_chain([np.frombuffer(r[2], np.int64) for r in found], np.array([r[1] for r in found], np.int64), bits)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, toxic_score, toxic (0/1) and the probabilities of the earlier categories of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def rows(batch: pa.RecordBatch) -> dict:
        p = np.concatenate([shared.value.probabilities(d, o) for _, _, d, o in A.blocks(*A.column_bytes(batch.column("text")))])
        flat = pa.array(p[:, :-1].reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * (p.shape[1] - 1)), flat)
        return {"doc_id": batch.column("doc_id"), "toxic_score": p[:, -1], "toxic": (p[:, -1] > FLAG_AT).astype(np.int32), "category_scores": lists}

    source = docs.select("doc_id", "text")
    return arrow_map(source, rows, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, toxic_score double, toxic int, category_scores array<double>")
