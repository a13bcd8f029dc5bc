"""Near-dedup of whole texts by SimHash, MinHash beyond its radius, and exact Jaccard similarity of word shingles.

Texts are linked from a Jaccard similarity of ``line_dedup.SIMILARITY`` = 0.8 of
their sets of ``WIDTH`` = 5-word shingles (words lower-cased, A-Z; a shorter text is
its own only shingle). Of each connected component the row with the least doc_id stays.

Candidates come from two searches, whose links meet in one union-find:

* SimHash, by the operator of ``simhash``: the 64-bit fingerprint of the same shingles, its covering family,
  stars and union-find. Texts whose fingerprints lie in one component are a bucket.
* ``BANDS`` bands of ``ROWS`` MinHash values, each over all shingles, so that a value
  agrees with probability J whatever the length: a pair at 0.8 misses all bands with
  probability 5e-8. SimHash alone would lose most pairs near 0.8: their fingerprints differ
  in about ten of 64 bits, and a covering family of radius r has 2**(r + 1) - 1 masks.

Candidates of both are verified exactly, and buckets that still span components pair
by pair, as lines are: fingerprints alone remove no text.

Defined results. Texts without words (null, empty, white space) are linked with each
other only. Rows equal in doc_id and text count as repeats, of which one stays. Null
ids come last in order. All columns pass through. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from . import simhash
from .graph import connected
from .line_dedup import candidates, keyed_rows, linked, once
from .runtime import arrow_map, batches_of, cut, fresh, prepare, row_key, stored

WIDTH = 5
ROWS = 4
BANDS = 32
#: Texts are longer than lines: fewer at once where a bucket is verified in full.
BLOCK = 128
_K = np.uint64(0x9FB21C651E98DF25)
_SALT = A.mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)).reshape(-1, 2)
_SALT[:, 1] |= np.uint64(1)


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a block, and the rows' bounds in them."""
    start, end = A.words(data, off)
    return A.span_hash(A.LOWER[data], start, end), np.searchsorted(start, off)


def _shingles(unit: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all rows, with repeats, and their number in each row."""
    counts = np.diff(bound)
    number = np.where(counts > 0, np.maximum(counts - WIDTH + 1, 1), 0)
    padded = np.append(unit, np.zeros(WIDTH, np.uint64))
    first = A.ranges(bound[:-1], number)
    left = np.repeat(bound[1:], number) - first  # words from the shingle's first to the end of its row
    key = np.zeros(len(first), np.uint64)
    for k in range(WIDTH):
        key = key * _K + np.where(left > k, padded[first + k], np.uint64(0))
    return A.mix(key), number


def _nodes(unit: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """A hash of each row's sequence of words."""
    counts = np.diff(bound)
    place = np.arange(len(unit)) - np.repeat(bound[:-1], counts)
    total = np.append(np.uint64(0), np.cumsum(A.mix(unit + place.astype(np.uint64) * _K)))
    return A.mix(total[bound[1:]] - total[bound[:-1]] + counts.astype(np.uint64))


def signatures(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Band keys (rows x bands); every row has shingles."""
    at = np.cumsum(number) - number
    out = np.empty((len(number), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(number), band, np.uint64)
        for flip, factor in _SALT[band * ROWS : (band + 1) * ROWS]:
            key = key * _K + np.minimum.reduceat((hashes ^ flip) * factor, at)
        out[:, band] = A.mix(key)
    return out


def _bands(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, off in A.blocks(*A.column_bytes(column), limit=1 << 16):
        unit, bound = _words(data, off)
        hashes, number = _shingles(unit, bound)
        some = np.flatnonzero(number)
        if len(some):
            node, first = np.unique(_nodes(unit, bound)[some], return_index=True)
            rows = some[first]
            start = np.cumsum(number) - number
            yield signatures(hashes[A.ranges(start[rows], number[rows])], number[rows]), node


def _text_hashes(texts: list[str]) -> list[np.ndarray]:
    unit, bound = _words(*A.column_bytes(pa.array(texts, pa.string())))
    hashes, number = _shingles(unit, bound)
    end = np.cumsum(number)
    return [hashes[e - n : e] for e, n in zip(end.tolist(), number.tolist(), strict=True)]


def prints(keyed: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, node, fp) of every row; node is the hash of its words, fp the fingerprint of its shingles."""

    def rows(batch: pa.RecordBatch) -> dict:
        node, fp = [], []
        for _, _, data, off in A.blocks(*A.column_bytes(batch.column(3))):
            unit, bound = _words(data, off)
            hashes, number = _shingles(unit, bound)
            node.append(_nodes(unit, bound))
            fp.append(simhash.majority(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), number))
        return {"k1": batch.column(0), "k2": batch.column(1), "doc_id": batch.column(2), "node": np.concatenate(node).view(np.int64), "fp": np.concatenate(fp).view(np.int64)}

    return arrow_map(keyed, rows, f"k1 long, k2 long, doc_id {keyed.schema['doc_id'].dataType.simpleString()}, node long, fp long")


def fingerprint_stars(every: DataFrame) -> DataFrame:
    """(a, b, key) of the texts (node, fp) whose fingerprints SimHash links: each component as a star; b is its least node."""
    nodes = cut(every.groupBy("node").agg(F.min("fp").alias("fp")))
    roots = connected(simhash.link_edges(nodes.select("fp").distinct())).withColumnRenamed("node", "fp")
    nodes = cut(nodes.join(roots, "fp", "left").select("node", F.coalesce("root", "fp").alias("key")))
    least = nodes.groupBy("key").agg(F.min("node").alias("b"))
    return nodes.join(least, "key").where("node <> b").select(F.col("node").alias("a"), "b", F.xxhash64("key").alias("key"))


def keep_one(docs: DataFrame) -> DataFrame:
    """All columns of one row of each component of near-duplicates: the one with the least doc_id."""
    spark = prepare(docs.sparkSession)
    keyed = keyed_rows(docs)
    every = stored(prints(keyed))
    stars = fingerprint_stars(every)
    with batches_of(spark, 64):
        edges = stored(candidates(keyed, _bands).union(stars))

    def bodies(nodes: DataFrame) -> DataFrame:
        place = every.groupBy("node").agg(F.min("k1").alias("k1"), F.min_by("k2", "k1").alias("k2")).join(nodes, "node")
        return once(keyed.select("k1", "k2", F.col("text").alias("body")).join(place, ["k1", "k2"]).select("node", "body"), nodes)

    found, _ = linked(edges, bodies, _text_hashes, BLOCK)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")
    least = every.groupBy("node").agg(F.min(order).alias("first")).join(found, "node", "left")
    chosen = least.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select("first.k1", "first.k2")
    rows = every.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    k1, k2, n = (fresh(x, docs.columns) for x in ("k1", "k2", "n"))
    chosen = cut(chosen.join(rows, ["k1", "k2"]).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("n").alias(n)))
    keys = row_key(docs)
    marked = docs.withColumns({k1: keys[0], k2: keys[1]})
    kept = marked.join(chosen.where(F.col(n) == 1), [k1, k2], "left_semi").select(*(f"`{c}`" for c in docs.columns))
    several = chosen.where(F.col(n) > 1)
    if several.isEmpty():
        return kept
    return kept.union(marked.join(several, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*(f"`{c}`" for c in docs.columns)))
