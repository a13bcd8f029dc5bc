"""Session set-up, durable cuts of lineage and Arrow plumbing shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: whole documents are long, so batches are short.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Sets what the operators rely on: short Arrow batches, and a checkpoint folder.

    The folder is the cluster's ``spark.checkpoint.dir``; a temporary one is set
    only where that is unset and the master is local, as in tests.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    context.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))  # workers on this host find the package
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared checkpoint folder."""
    return f"{prepare(spark).sparkContext._jsc.sc().getCheckpointDir().get()}/tables/{name}{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialises df once in the shared checkpoint folder, so later reads survive lost executors."""
    prepare(df.sparkSession)
    out = df.checkpoint(eager=True)
    release(df.sparkSession)
    return out


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, for many rows: a compressed Parquet table in the shared checkpoint folder."""
    spark = df.sparkSession
    path = shared_path(spark, "")
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished steps, and gives the driver's free memory back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Gives the free memory of a worker, which the next stages use again, back to its host."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Longer Arrow batches for actions on narrow rows."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        prepare(spark)


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str, after: Callable[[], None] = give_back) -> DataFrame:
    """``mapInArrow`` for a function from a batch to a dict of equally long columns; ``after`` runs at the end of each task."""
    names = [x.split()[0] for x in re.split(r",\s*(?![^(<]*[)>])", schema)]  # commas inside types do not count

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (out[k] for k in names)], names)
                del out
            del batch
        after()

    return df.mapInArrow(over, schema)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of doc_id and text, nulls told apart: together the identity of a row's contents."""
    parts = [F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def bucket_of(doc_id, modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in parts], pa.binary())
