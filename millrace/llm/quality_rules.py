"""Quality rules: fixed base rules, then a calibrated hashed n-gram model against a fixed threshold.

Base figures follow the whole text: words are runs of bytes other than space and
\\t \\n \\v \\f \\r. The model is a hashed word and character n-gram logistic
regression fitted on labelled quality rows; its margins are calibrated (Platt) on
a fifth of the sample that the fit has not seen, and a row is kept when its
calibrated probability of quality reaches ``KEEP_AT``.

Defined results. Null and empty texts have no words, so the base rules fail
them. Repeated rows are judged alike. Without labels the model keeps whatever
passes the base rules. All columns pass through ``keep_rows`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrays as A
from .linear import Linear, fit_ftrl, platt, sample_ids, sigmoid, training_rows
from .runtime import arrow_map, prepare

BITS = 18
MAX_TRAINING_ROWS = 3000
#: Least calibrated probability of quality that is kept.
KEEP_AT = 0.3
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass
class RuleModel:
    linear: Linear
    slope: float
    offset: float

    def probability(self, index: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.linear.margins(index, bound) + self.offset)


def train(docs: DataFrame, labels: DataFrame, *, limit: int = MAX_TRAINING_ROWS, bits: int = BITS) -> RuleModel:
    prepare(docs.sparkSession)
    rows = training_rows(docs, sample_ids(labels, "quality", limit), bits, chars=True)
    fit = [r for k, r in enumerate(rows) if k % 5]
    held = [r for k, r in enumerate(rows) if not k % 5]
    model = fit_ftrl(fit, 1 << bits)
    margin = np.array([model.bias + float(model.weights[i] @ v) for i, v, _ in held])
    return RuleModel(model, *platt(margin, np.array([float(y) for *_, y in held])))


def base_figures(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of every row."""
    n = len(off) - 1
    start, end = A.words(data, off)
    bound = np.searchsorted(start, off)
    row = np.repeat(np.arange(n), np.diff(bound))
    inside = ~A.IS_SPACE[data]
    n_words = np.diff(bound)
    repeated = np.bincount(row[A.repeated_windows(A.span_hash(data, start, end), row)], minlength=n)
    ls, le, lrow = A.lines(data, off)
    cover = np.concatenate([[0], np.cumsum(inside)])
    full = cover[le] > cover[ls]
    ls, le, lrow = ls[full], le[full], lrow[full]
    key = A.mix(A.span_hash(data, ls, le) + lrow.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first = np.unique(key, return_index=True)[1]
    dup = np.bincount(lrow, minlength=n) - np.bincount(lrow[first], minlength=n)
    return {
        "n_words": n_words,
        "word_chars": A.per_row((inside & ((data & 0xC0) != 0x80)).astype(np.int64), off),
        "n_symbols": A.per_row(IS_SYMBOL[data].astype(np.int64), off),
        "n_dup_lines": dup,
        "n_repeat_words": repeated,
        "base_failed": (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words),
    }


FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, quality_probability double"


def _judged(text: pa.Array, model: RuleModel) -> dict[str, np.ndarray]:
    bits = int(len(model.linear.weights)).bit_length() - 1
    parts: list[dict[str, np.ndarray]] = []
    for _, _, d, o in A.blocks(*A.column_bytes(text)):
        x = base_figures(d, o)
        p = model.probability(*A.ngram_features(d, o, bits, chars=True))
        parts.append(x | {"kept": ~x["base_failed"] & (p >= KEEP_AT), "quality_probability": p})
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def judge(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The figures, the base verdict and the final verdict of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id")} | _judged(batch.column("text"), shared.value)

    source = docs.select("doc_id", "text")
    return arrow_map(source, rows, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {FIGURES}")


def keep_rows(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The rows of docs, with all their columns, that the rules keep."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_judged(batch.column(at), shared.value)["kept"]))

    return docs.mapInArrow(rows, docs.schema)
