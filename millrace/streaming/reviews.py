"""Extension: the row-local operators over streams, and exact dedup under a watermark.

The batch rules are expressions, so they apply to a stream as they are. Keep-first dedup over an
unbounded stream needs a bound in time: within the watermark the first arrival stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import blank, trim_all
from ..operators import coarse, normalize, structure
from ..schema import ANONYMOUS, AUTHOR, CONTENT


def read_stream(spark: SparkSession, path: str, schema, source: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(source).load(path)


def clean_stream(df: DataFrame) -> DataFrame:
    """Misplaced fields, empty rows, spaces, special characters, symbol-only rows."""
    for step in (structure.fix_field_misalignment, structure.drop_empty_rows, normalize.strip_extra_whitespace, normalize.remove_meaningless_special_chars, coarse.drop_symbol_only):
        df = df.transform(step)
    return df


def dedup_stream(df: DataFrame, event_time: str, delay: str = "1 day", content: str = CONTENT, author: str = AUTHOR) -> DataFrame:
    """Drops rows whose (author, content) has come within the watermark; rows without a key get one of their own."""
    who, text = trim_all(F.col(author)), trim_all(F.col(content))
    keyless = blank(who) | blank(text) | (F.lower(who) == ANONYMOUS)
    key = F.when(keyless, F.uuid()).otherwise(F.sha2(F.concat_ws("\x00", who, text), 256))
    return df.withWatermark(event_time, delay).withColumn("__key", key).dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def windowed_counts(df: DataFrame, event_time: str, keys: list[str], width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return df.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """A Parquet sink that takes what is there and stops; each file is committed once."""
    return df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
