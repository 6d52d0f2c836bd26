"""Connected components of an edge table, by alternating large-star and small-star steps.

First each task contracts its share of the edges, about ``EDGES_PER_TASK`` of them, to stars of its own.  A table
of a single share is done then; else rounds follow whose every step is a groupBy and a join.  Tables are staged
between rounds, and only two numbers a round (edge count and checksum) reach the driver.  The result is a star per
component: each node points to its smallest one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import releasing, stage_table

MAX_ROUNDS = 60
EDGES_PER_TASK = 1_000_000


def stars_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of the edges, by label minima and pointer jumping."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return nodes, nodes[label]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        node, root = stars_of(*(np.concatenate(x) for x in zip(*held)))
        other = node != root
        yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(root[other])], ["u", "v"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); ``component`` is its smallest node.

    Self-loops and repeated edges are allowed.  Nodes without an edge are not returned."""
    given = stage_table(edges.select("u", "v").filter("u <> v"), "cc-edges")
    shares = -(-given.count() // EDGES_PER_TASK)
    if not shares:
        return given.select(F.col("u").alias("node"), F.col("v").alias("component"))
    stars = stage_table(given.coalesce(shares).mapInArrow(releasing(_contract), "u long, v long"), "cc-edges")
    state = _state(stars) if shares > 1 else None
    for _ in range(MAX_ROUNDS):
        if shares == 1:
            break
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        stars = stage_table(small.select("e.u", "e.v").filter("u <> v").distinct(), "cc-edges")
        now = _state(stars)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    roots = stars.select("v").distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
