"""Arrow-batched pandas UDFs over the kernels. Lexicons travel in the closures; they are small."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .text import none_if_blank


#: Bytes of an Arrow batch of texts.
BATCH_BYTES = 1 << 20

# types are objects, not DDL text: that would need a session when this module is imported
_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())


def _record(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TEXT) for n in names])


def short_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches by bytes: ten thousand whole texts at once, the default, take a worker's memory as tables grow."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def text_map(function: Callable[[str], str], concerns: str | None = None) -> Callable[[Column], Column]:
    """A text-to-text UDF; null stays null. Texts that the pattern ``concerns`` is not found in do not leave the JVM."""

    @F.pandas_udf(_TEXT)
    def run(s: pd.Series) -> pd.Series:
        return s.map(function, na_action="ignore")

    return lambda c: none_if_blank(F.coalesce(run(F.when(F.regexp_like(c, F.lit(concerns)), c)), c) if concerns else run(c))


normalize_unicode = text_map(K.normalize_unicode, r"[<&]|[^\x00-\x7F]")
collapse_repeats = text_map(K.collapse_repeats)


def explain_emoji(lexicon: dict[str, tuple[str, str]]) -> Callable[[Column], Column]:
    @F.pandas_udf(_record("content", "emojis", "sentiment"))
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([K.explain_emoji(t, lexicon) if t is not None else (None, None, None) for t in s], columns=["content", "emojis", "sentiment"], dtype=object)

    return run


@F.pandas_udf(_TEXTS)
def emoji_units(s: pd.Series) -> pd.Series:
    return s.map(lambda t: [u for run in K.EMOJI_RUN.findall(t or "") for u in K.emoji_units(run)])


def expand_abbreviations(lexicon: dict) -> Callable[[Column], Column]:
    if not lexicon:
        return lambda c: c
    pattern = K.whole_words(lexicon)
    return text_map(lambda t: K.expand_abbreviations(t, lexicon, pattern))


def correct_spelling(errors: dict, allowed: frozenset, vocabulary: dict) -> Callable[[Column], Column]:
    """text -> struct(text, detail); the answers are remembered by token within a batch."""

    @F.pandas_udf(_record("text", "detail"))
    def run(s: pd.Series) -> pd.DataFrame:
        memo: dict = {}
        rows = [K.correct_spelling(t, errors, allowed, vocabulary, memo) if t is not None else (None, []) for t in s]
        return pd.DataFrame([(t, "; ".join(f"{a} -> {b}" for a, b in f)) for t, f in rows], columns=["text", "detail"], dtype=object)

    return run


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([K.similarity(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(T.BooleanType())
def is_syllable(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t is not None and K.is_syllable(t)).astype(bool)


@F.pandas_udf(_TEXT)
def telex_decode(s: pd.Series) -> pd.Series:
    return s.map(K.telex_decode, na_action="ignore")


@F.pandas_udf(_TEXTS)
def split_chunks(s: pd.Series) -> pd.Series:
    return s.map(lambda t: K.split_chunks(t or ""))
