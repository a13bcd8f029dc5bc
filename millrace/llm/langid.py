"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of 1-, 2- and 3-grams of code points (lower-cased, each whole text) are
gathered with Spark from a bounded sample of each language, smoothed into a
log-probability matrix of ``languages x 2**bits`` float32, broadcast, and summed
over the n-grams of each text in numpy. The prior is a language's share of all rows to
learn from, sampled or not.

Defined results. A null text, and one without a letter (Unicode category L), is ``und`` with score 0.
Without learned languages every text is ``und``. Ties go to the language that
sorts first. Repeated rows are predicted alike. Only ``doc_id``, ``text`` and, for
learning, ``lang`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .runtime import arrow_map, prepare

BITS = 14
#: About so many documents of one language are counted, at most (documented bound).
MAX_ROWS_PER_LANGUAGE = 1000
SMOOTHING = 0.5
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")  # and other numbers, which ``isalpha`` (category L) tells apart
_MULTIPLIERS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def grams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1-, 2- and 3-grams of code points of all texts (row by row within each size), and their rows' bounds."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bound = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    shift = np.uint32(32 - bits)
    one = (code * _MULTIPLIERS[0] + np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1)
    parts, bounds = [one >> shift], [bound]
    left = np.full(len(code), True)
    left[bound[1:-1][bound[1:-1] < len(code)]] = False
    h, fits = code, None
    for size, m in ((2, _MULTIPLIERS[1]), (3, _MULTIPLIERS[2])):
        if len(code) < size:
            break
        h = (h[:-1] * _MULTIPLIERS[0] + code[size - 1 :]) * m
        h ^= h >> np.uint32(15)
        fits = left[1:] if fits is None else fits[:-1] & left[size - 1 :]
        parts.append(((h * np.uint32(0x165667B1)) >> shift)[fits])
        place = np.concatenate([[0], np.cumsum(fits)])
        bounds.append(place[np.minimum(bound, len(place) - 1)])
    return parts, bounds


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # languages x buckets
    prior: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages or not texts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bits = int(self.log_probability.shape[1]).bit_length() - 1
        score = np.tile(self.prior, (len(texts), 1))
        for index, bound in zip(*grams(texts, bits), strict=True):
            for k in range(len(self.languages)):
                score[:, k] += A.per_row(self.log_probability[k][index], bound)
        best = score.argmax(1)
        share = 1.0 / np.exp(np.clip(score - score.max(1, keepdims=True), -700, 0)).sum(1)
        letters = np.array([any(m[0].isalpha() for m in _LETTER.finditer(t)) for t in texts])
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)], np.where(letters, share, 0.0)


def _lowered(column: pa.Array) -> list[str]:
    return [(t or "").lower() for t in column.to_pylist()]


def _runs(texts: list[str], limit: int = 1 << 18) -> Iterator[list[str]]:
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def train(docs: DataFrame, keep: Column | None = None, *, limit: int = MAX_ROWS_PER_LANGUAGE, bits: int = BITS) -> LanguageModel:
    """Counts about ``limit`` documents of each non-null language for which ``keep`` holds, all if it has no more.

    A row is in the sample if a hash of its doc_id is below its language's sampling
    rate; the rates come from pre-aggregated counts, one number a language, so that a hot
    language is never gathered. Repeated rows count as often as they occur.
    """
    prepare(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = (rows.where(keep) if keep is not None else rows).select("doc_id", F.col("lang").alias("language"), "text")
    sizes = {r.language: r.n for r in rows.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), _lowered(batch.column(1)), strict=True):
                mine = total.setdefault(language, np.zeros(1 << bits, np.int64))
                for index in grams([text], bits)[0]:
                    np.add.at(mine, index, 1)
        for language, mine in sorted(total.items()):
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(mine[at])], ["language", "bucket", "n"])

    rates = docs.sparkSession.createDataFrame([(k, limit / n) for k, n in sorted(sizes.items())], "language string, rate double")
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / F.lit(2.0**63) < F.col("rate")
    sample = rows.join(F.broadcast(rates), "language").where(drawn).select("language", "text")  # one rate a language, as the model has one row
    counts = sample.mapInArrow(count, "language string, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts.column("language").to_pylist()))
    table = np.full((len(languages), 1 << bits), SMOOTHING)
    place = {x: k for k, x in enumerate(languages)}
    rows = np.array([place[x] for x in counts.column("language").to_pylist()], np.int64)
    np.add.at(table, (rows, counts.column("bucket").to_numpy()), counts.column("n").to_numpy())
    logp = np.log(table) - np.log(table.sum(1, keepdims=True))
    share = np.array([sizes[x] for x in languages], np.float64)
    return LanguageModel(languages, logp.astype(np.float32), np.log(share / max(share.sum(), 1.0)))


def identify(docs: DataFrame, model: LanguageModel, *extra: Column) -> DataFrame:
    """doc_id, ``extra`` columns, lang_pred and score of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select("doc_id", *extra, "text")
    names = [f for f in source.schema.fields if f.name != "text"]

    def rows(batch: pa.RecordBatch) -> dict:
        said, score = [], []
        for run in _runs(_lowered(batch.column("text"))):
            a, b = shared.value.predict(run)
            said += a
            score.append(b)
        return {f.name: batch.column(f.name) for f in names} | {"lang_pred": pa.array(said, pa.string()), "score": np.concatenate(score)}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names)
    return arrow_map(source, rows, f"{schema}, lang_pred string, score double")
