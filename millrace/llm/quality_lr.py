"""Quality classifier: hashed word n-gram logistic regression trained with FTRL-proximal.

Defined results. Null and empty texts have no features and score the sigmoid of
the bias. Repeated rows score alike, each on its own row. Without labelled rows
the model is all zeros and every score is 0.5. Only ``doc_id`` and ``text`` are
read, so extra columns of any name do no harm. Long texts are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from . import arrays as A
from .linear import Linear, fit_ftrl, sample_ids, sigmoid, training_rows
from .runtime import arrow_map, prepare

BITS = 18
#: Most labelled rows that the classifier is fitted on (documented bound).
MAX_TRAINING_ROWS = 4000
THRESHOLD = 0.3


def train(docs: DataFrame, labels: DataFrame, keep: Column | None = None, *, limit: int = MAX_TRAINING_ROWS, bits: int = BITS, label: str = "quality") -> Linear:
    """Fits on at most ``limit`` labelled rows for which ``keep`` (over labels) holds."""
    prepare(docs.sparkSession)
    return fit_ftrl(training_rows(docs, sample_ids(labels, label, limit, keep), bits), 1 << bits)


def score(docs: DataFrame, model: Linear, *extra: Column) -> DataFrame:
    """doc_id, quality_score and ``extra`` columns of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bits = int(len(model.weights)).bit_length() - 1
    source = docs.select("doc_id", *extra, "text")
    names = [f for f in source.schema.fields if f.name != "text"]

    def rows(batch: pa.RecordBatch) -> dict:
        data, off = A.column_bytes(batch.column("text"))
        out = [sigmoid(shared.value.margins(*A.ngram_features(d, o, bits))) for _, _, d, o in A.blocks(data, off)]
        return {f.name: batch.column(f.name) for f in names} | {"quality_score": np.concatenate(out)}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names)
    return arrow_map(source, rows, f"{schema}, quality_score double")
