"""Distributed union-find: connected components by alternating large and small stars.

Each round is a grouped minimum and a join on the node, so a hub with very many
neighbours is pre-aggregated and its join partition can be split; no
neighbourhood is collected. Every round is materialised in the shared checkpoint
folder. The number of rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import batches_of, cut


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of all non-root nodes of the graph with edges a-b; roots are the least nodes."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while len(u):
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while (root[root] != root).any():
            root = root[root]
        differ = root[u] != root[v]
        u, v = u[differ], v[differ]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contract(edges: DataFrame) -> DataFrame:
    """Replaces the edges of each partition, in runs of bounded size, by stars."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            a, b = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            node, root = local_roots(a, b)
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

        for batch in batches:
            held.append([batch.column(k).to_numpy() for k in (0, 1)])
            n += batch.num_rows
            if n >= 1 << 20:
                yield out()
                held, n = [], 0
        if held:
            yield out()

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(runs, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), longs; root is the component's least node."""
    with batches_of(edges.sparkSession, 50_000):
        now = cut(_contract(edges.where("a <> b")).distinct())
    mark = None
    while True:
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = cut(small.where("a <> b").distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
