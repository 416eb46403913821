"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import save

#: Edges that one task contracts.
PART_EDGES = 1 << 20


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating stars: neighbours are hung on the smallest one around.

    large: larger neighbours of each node; else smaller ones and the node. Only minima are
    grouped, with partial aggregates; a node with very many neighbours is split by the join.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u")
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node that each reaches over them."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
        left = root[x] != root[y]
        x, y = x[left], y[left]
    return nodes, nodes[root]


def _contracted(batches) -> Iterator[pa.RecordBatch]:
    """The edges of a part as stars around the smallest nodes."""
    pairs = [[batch.column(i).to_numpy() for i in (0, 1)] for batch in batches]
    if pairs:
        nodes, roots = smallest_reachable(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
        hung = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(roots[hung])], names=["u", "v"])


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``edges`` (a, b).

    Edges are first contracted in parts of about PART_EDGES each. If there are several parts, large-star
    and small-star steps follow in turn until nothing changes; each turn is written to the shared
    folder. The number of turns follows the logarithm of the longest chain.
    """
    own = save(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v"), "edges")
    parts = -(-own.count() // PART_EDGES)
    own = save(spark, own.coalesce(max(1, parts)).mapInArrow(_contracted, "u long, v long"), "contracted")
    before = None
    while parts > 1:
        own = save(spark, _stars(_stars(own, True), False), "stars")
        state = own.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = own.select(F.col("v").alias("node")).distinct()
    return own.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
