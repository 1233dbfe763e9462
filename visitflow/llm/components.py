"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import Scratch

#: Edges that one task contracts together.
CHUNK_EDGES = 500_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the edges: the smallest node it hangs together with, by pointer jumping."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        # Only roots move; an edge that another one outdoes is still there in the next turn.
        high, low = np.maximum(root[x], root[y]), np.minimum(root[x], root[y])
        np.minimum.at(root, high, low)
        while (jumped := root[root] != root).any():
            root[jumped] = root[root[jumped]]
        keep = root[x] != root[y]
        x, y = x[keep], y[keep]
    return nodes, nodes[root]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's edges as stars (a = the smallest node of a piece, b): never more edges than nodes."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        node, root = roots(table.column("a").to_numpy(), table.column("b").to_numpy())
        out = node != root
        return pa.RecordBatch.from_arrays([pa.array(root[out]), pa.array(node[out])], ["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_EDGES:
            yield star(held)
            held, rows = [], 0
    if rows:
        yield star(held)


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of the edges (a, b): ``root`` is the smallest node reachable.

    Each task first contracts its edges to stars. Every node then points to the smallest
    node it has an edge to, and pointers are shortened until each node points to a root.
    Edges between roots are what is left to settle: the higher root points to the lowest one
    beside it, until no such edge is left. A node of many edges meets the joins as many rows
    of one key, which adaptive execution splits.
    """
    stars = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    stars = scratch.stored(stars.mapInArrow(_stars, "a long, b long").distinct(), "edges")
    labels = stars.select(F.col("b").alias("node"), F.col("a").alias("root")).union(stars.select("a", "a"))
    labels = _flat(labels.groupBy("node").agg(F.min("root").alias("root")), scratch)
    while True:
        ends = labels.select(F.col("node").alias("a"), F.col("root").alias("x"))
        between = stars.join(ends, "a").join(ends.toDF("b", "y"), "b").where("x <> y")
        between = between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        stars = scratch.stored(between.mapInArrow(_stars, "a long, b long").distinct(), "edges")
        if not stars.head(1):
            return labels
        lower = stars.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
        labels = _flat(labels.join(lower, "node", "left").select("node", F.coalesce("low", "root").alias("root")), scratch)


def _flat(labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node takes its root's root, until every root is its own."""
    while True:
        labels = scratch.stored(labels, "labels")
        up = labels.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("up"))
        if not labels.join(up, "root", "left_semi").head(1):
            return labels
        labels = labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
