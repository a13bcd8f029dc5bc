"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint holds, bit by bit, the majority of the XXH64 hashes of a text's
word shingles. Fingerprints within ``RADIUS`` = 3 differing bits are linked.

Candidate search is a covering family of 15 masks: every bit position b gets a
non-zero vector m(b) of 4 bits, and mask v (1..15) keeps the positions with
<m(b), v> = 1 mod 2. The at most three vectors of the positions in which two
fingerprints differ cannot span all four dimensions, so some v is orthogonal to
all of them and that mask sees no difference: every linked pair meets in some
table, for certain.

Distinct fingerprints only are searched; copies follow theirs. A bucket of more
than ``MAX_BUCKET`` fingerprints is not gathered: its members go on to a covering
family over the bits that its mask ignores, and once more; after three levels a
bucket can hold at most 2**8 distinct fingerprints. Each bucket is reported as
stars, not pairs, and components are found by distributed union-find.

Defined results. A text without words (null, empty, white space) has fingerprint
zero and is linked like any other. Repeated rows each keep their row. Rows with
null doc_id are linked, but name no component unless all members have none (then
null). An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .graph import connected, local_roots
from .runtime import arrow_map, batches_of, cut, fresh, prepare

RADIUS = 3
MAX_BUCKET = 512
WIDTH = 3
SEED = 42
LEVELS = 3


def fingerprints_of(data: np.ndarray, off: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """64-bit fingerprints of the rows of a block."""
    start, end = A.words(data, off)
    if not len(start):
        return np.zeros(len(off) - 1, np.uint64)
    bound = np.searchsorted(start, off)
    size = end - start + 1
    low = np.append(A.LOWER[data], np.uint8(32))[A.ranges(start, size)]
    stop = np.cumsum(size) - 1
    low[stop] = 32
    begin = stop - size + 1
    counts = np.diff(bound)
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    first = A.ranges(bound[:-1], shingles)
    last = np.minimum(first + width - 1, np.repeat(bound[1:], shingles) - 1)
    text, digest = low.tobytes(), xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(text[s:e], SEED) for s, e in zip(begin[first].tolist(), stop[last].tolist(), strict=True)]), np.uint8).reshape(-1, 8)
    return majority(hashes, shingles)


def majority(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The fingerprint of each row from its shingles' hashes (shingles x 8 bytes, highest first, one row after another); zero without shingles."""
    out = np.zeros(len(shingles), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        at = (np.cumsum(shingles) - shingles)[some]
        ones = np.add.reduceat(np.unpackbits(hashes, axis=1), at, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > shingles[some][:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH, *, keep_columns: bool = False, column: str = "simhash") -> DataFrame:
    """doc_id (or all columns) and the fingerprint as a signed long in ``column``, of every row."""
    prepare(docs.sparkSession)
    source = docs if keep_columns else docs.select("doc_id", "text")
    names = [f.name for f in source.schema.fields if keep_columns or f.name != "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.concatenate([fingerprints_of(d, o, width) for _, _, d, o in A.blocks(*A.column_bytes(batch.column(batch.schema.names.index("text"))))])
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), pa.array(found.view(np.int64))], [*names, column])

    schema = source.select(*names).withColumn(column, F.lit(0).cast("long")).schema
    return source.mapInArrow(rows, schema)


@cache
def covering_masks(outer: int = 0) -> tuple[int, ...]:
    """The 15 masks over the bits that ``outer`` lacks, each joined with ``outer``."""
    free = [b for b in range(64) if not outer >> b & 1]
    out = []
    for v in range(1, 2 ** (RADIUS + 1)):
        out.append(outer | sum(1 << b for k, b in enumerate(free) if ((1 + k % 15) & v).bit_count() & 1))
    return tuple(out)


def _keyed(nodes: DataFrame) -> DataFrame:
    """(mask, key, fp) of every (mask, fp) under the covering family inside its mask."""

    def rows(batch: pa.RecordBatch) -> dict:
        outer, fp = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
        kinds, which = np.unique(outer, return_inverse=True)
        masks = np.array([covering_masks(int(x)) for x in kinds.tolist()], np.uint64)[which]
        return {"mask": masks.ravel().view(np.int64), "key": (masks & fp[:, None]).ravel().view(np.int64), "fp": np.repeat(fp, masks.shape[1]).view(np.int64)}

    return arrow_map(nodes.select("mask", "fp"), rows, "mask long, key long, fp long")


def _stars(bucketed: DataFrame) -> DataFrame:
    """Star edges of the links inside buckets of bounded size."""

    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        a, b, step, at = [], [], 1, np.arange(len(fp))
        while True:
            at = at[at + step < len(fp)]
            at = at[(mask[at] == mask[at + step]) & (key[at] == key[at + step])]
            if not len(at):
                break
            near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= RADIUS]
            a.append(fp[near])
            b.append(fp[near + step])
            step += 1
        if not sum(map(len, a)):
            return None
        node, root = local_roots(np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.uint64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(k).to_numpy().view(np.uint64)]) for k, h in enumerate(held)]
            tail = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            end = tail[-1] + 1 if len(tail) else 0  # the last bucket may go on in the next batch
            if end and (out := links(*(h[:end] for h in held))) is not None:
                yield out
            held = [h[end:] for h in held]
        if len(held[0]) and (out := links(*held)) is not None:
            yield out

    # dealt out by another expression than that of the join below: else the planner takes the join's order for granted,
    # leaves this exchange and sort out, and adaptive execution may still turn the join into a broadcast, which tears buckets apart
    dealt = bucketed.select("mask", "key", "fp").repartition(F.xxhash64("mask", "key")).sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(rows, "a long, b long")


def link_edges(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) as the links within RADIUS do."""
    spark, edges = nodes.sparkSession, None
    level = nodes.select(F.lit(0).cast("long").alias("mask"), "fp")
    with batches_of(spark, 20_000):
        for k in range(LEVELS):
            keyed = _keyed(level)
            sizes = cut(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
            members = keyed.join(sizes, ["mask", "key"])
            few = cut(_stars(members if k == LEVELS - 1 else members.where(F.col("n") <= MAX_BUCKET)))
            edges = few if edges is None else edges.union(few)
            if k == LEVELS - 1 or sizes.where(F.col("n") > MAX_BUCKET).isEmpty():
                return edges
            level = cut(members.where(F.col("n") > MAX_BUCKET).select("mask", "fp"))
    return edges


def components(prints: DataFrame) -> DataFrame:
    """(simhash, root, component_id) of every distinct fingerprint of rows (doc_id, simhash); root tells components apart."""
    nodes = cut(prints.groupBy(F.col("simhash").alias("fp")).agg(F.min("doc_id").alias("least")))
    roots = connected(link_edges(nodes)).withColumnRenamed("node", "fp")
    nodes = cut(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return nodes.join(least, "root").select(F.col("fp").alias("simhash"), "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, simhash and component_id (least doc_id reachable by links) of every row."""
    prints = cut(fingerprints(docs, width))
    return prints.join(components(prints), "simhash").select("doc_id", "simhash", "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """All columns of one row of each component: the one with the least doc_id.

    Rows with equal doc_id and fingerprint count as repeats, of which one stays; so
    does one row of a component whose ids are all null.
    """
    prints = cut(fingerprints(docs, width))
    each = prints.groupBy("doc_id", "simhash").agg(F.count(F.lit(1)).alias("n")).join(components(prints), "simhash")
    each = each.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # an id may stand on rows of several fingerprints, in one component or in more
    chosen = each.groupBy("root").agg(F.first("doc_id").alias("doc_id"), F.min("simhash").alias("simhash"))
    rows = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    ident, fp, mine = (fresh(x, docs.columns) for x in ("id", "fp", "print"))
    chosen = cut(chosen.join(rows, chosen["doc_id"].eqNullSafe(rows["doc_id"])).select(chosen["doc_id"].alias(ident), F.col("simhash").alias(fp), rows["rows"].alias(fresh("rows", docs.columns))))
    many = F.col(chosen.columns[2]) > 1
    single = chosen.where(~many & F.col(ident).isNotNull()).select(ident)
    kept = docs.join(single, docs["doc_id"] == single[ident], "left_semi")
    several = chosen.where(many | F.col(ident).isNull()).select(ident, fp)
    if several.isEmpty():
        return kept
    marked = fingerprints(docs.join(several, docs["doc_id"].eqNullSafe(several[ident]), "left_semi"), width, keep_columns=True, column=mine)
    marked = marked.join(several, marked["doc_id"].eqNullSafe(several[ident]) & (marked[mine] == several[fp]), "left_semi")
    return kept.union(marked.dropDuplicates(["doc_id", mine]).select(*docs.columns))
