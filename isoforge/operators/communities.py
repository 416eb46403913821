"""Communities of a weighted graph by modularity, with a resolution.

Q = sum over communities of (weight inside / m) - resolution * (degrees / 2m)^2. Each level moves nodes between
communities, splits communities that have come apart, and makes each one a node of the next, smaller graph.

A round of moves is one job: for each node the weight to each community around it, and the best one by
gain. Nodes move at the same time, so only a share of them, by hash, may move in a round. Their
gains are those of single moves; Q itself is taken in the next round, and a round after which it is less
is undone and tried again with a smaller share. So Q never falls.

Graphs become smaller by each level. One of at most FEW_EDGES is brought to its end by a single task, which moves
the same nodes by the same gains, one after the other.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoforge.sources.shared import Saved

#: Edges of a graph, both ways, that one task takes.
FEW_EDGES = 1 << 18
#: Rounds of a level, levels, least gain of Q that a round is worth, and the smallest share of nodes that is tried.
ROUNDS, LEVELS, LEAST, SMALLEST = 12, 6, 1e-5, 1 / 16


@dataclass
class Communities:
    """``labels`` (node, community), each community named by its smallest node, and the modularity after every round that was kept."""

    labels: DataFrame
    modularity: list[float] = field(default_factory=list)


def undirected(edges: DataFrame) -> DataFrame:
    """a, b, w both ways, weights of repeated edges summed; loops (a = b) stay as they are."""
    both = edges.filter("a != b").select(F.inline(F.array(F.struct("a", "b", "w"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "w"))))
    return both.unionByName(edges.filter("a = b").select("a", "b", "w")).groupBy("a", "b").agg(F.sum("w").alias("w"))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Q of ``labels`` (node, community) on ``edges`` (a, b, w), each given once; a loop counts twice at its node."""
    one, two = labels.select(F.col("node").alias("a"), F.col("community").alias("ca")), labels.select(F.col("node").alias("b"), F.col("community").alias("cb"))
    own = edges.join(one, "a").join(two, "b")
    inside = own.agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)), F.sum("w")).first()
    ends = own.select(F.explode(F.array("ca", "cb")).alias("c"), "w").groupBy("c").agg(F.sum("w").alias("d"))
    squares = ends.agg(F.sum(F.col("d") * F.col("d"))).first()[0]
    return inside[0] / inside[1] - resolution * squares / (2 * inside[1]) ** 2 if inside[1] else 0.0


def _round(nodes: DataFrame, edges: DataFrame, two_m: float, resolution: float) -> DataFrame:
    """node, degree, community, own (weight into its community but itself), best, gain: with the community totals of ``nodes`` as they stand."""
    totals = nodes.groupBy("community").agg(F.sum("degree").alias("total"))
    nodes = nodes.join(totals, "community").select("node", "degree", "community", "total")
    # Totals travel with the nodes, and a node's edges are brought together once for both sums and the join.
    met = edges.filter("a != b").join(nodes.select(F.col("node").alias("b"), F.col("community").alias("c"), "total"), "b").select(F.col("a").alias("node"), "c", "w", "total")
    near = met.repartition("node").groupBy("node", "c").agg(F.sum("w").alias("w"), F.max("total").alias("total"))
    own = nodes.select("node", "degree", "community", (F.col("total") - F.col("degree")).alias("rest"))
    # What a node adds to Q, times m: weight into a community less the share that its degree makes likely.
    worth = F.col("w") - resolution * F.col("degree") * F.col("total") / two_m
    found = own.join(near, "node", "left").groupBy("node", "degree", "community", "rest").agg(
        F.coalesce(F.sum(F.when(F.col("c") == F.col("community"), F.col("w"))), F.lit(0.0)).alias("own"),
        F.max(F.when(F.col("c") != F.col("community"), F.struct(worth.alias("worth"), F.col("c").alias("c")))).alias("top"),
    )
    gain = F.col("top.worth") - (F.col("own") - resolution * F.col("degree") * F.col("rest") / two_m)
    return found.select("node", "degree", "community", "own", F.col("top.c").alias("best"), F.coalesce(gain, F.lit(0.0)).alias("gain"))


def _quality(state: DataFrame, two_m: float, loops: float, resolution: float) -> tuple[float, int]:
    """Q as a round's rows show it, and the number of nodes that would move."""
    inside, movers = state.agg(F.sum("own"), F.count(F.when(F.col("gain") > 1e-12 * two_m, 1))).first()
    squares = state.groupBy("community").agg(F.sum("degree").alias("t")).agg(F.sum(F.col("t") * F.col("t"))).first()[0]
    return (inside + loops) / two_m - resolution * squares / two_m**2, movers


def _moves(saved: Saved, nodes: DataFrame, edges: DataFrame, two_m: float, loops: float, resolution: float, history: list[float], seed: int) -> DataFrame:
    """Nodes with their communities after the rounds of one level."""
    share, best = 0.5, saved(_round(nodes, edges, two_m, resolution))
    quality, movers = _quality(best, two_m, loops, resolution)
    history.append(quality)
    for i in range(ROUNDS):
        if not movers or share < SMALLEST:
            break
        lucky = F.pmod(F.xxhash64("node", F.lit(seed * 100 + i)), F.lit(1024)) < int(1024 * share)
        # Two single nodes would only swap names: the one with the larger name moves.
        moved = F.when((F.col("gain") > 1e-12 * two_m) & lucky & ((F.col("own") > 0) | (F.col("community") != F.col("node")) | (F.col("best") < F.col("community"))), F.col("best")).otherwise(F.col("community"))
        state = saved(_round(best.select("node", "degree", moved.alias("community")), edges, two_m, resolution))
        now, left = _quality(state, two_m, loops, resolution)
        if now < quality - 1e-12:
            share /= 2
            continue
        gained, best, movers = now - quality, state, left
        quality = max(now, quality)
        history.append(quality)
        if gained < LEAST and share >= 0.5:
            share /= 2
    return best.select("node", "degree", "community")


def connected_labels(saved: Saved, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with each community parted into its connected parts, each named by its smallest node."""
    one, two = nodes.select(F.col("node").alias("a"), F.col("community").alias("ca")), nodes.select(F.col("node").alias("b"), F.col("community").alias("cb"))
    inside = saved(edges.filter("a != b").join(one, "a").join(two, "b").filter("ca = cb").select("a", "b"))
    part = nodes.select("node", F.col("node").alias("part"))
    while True:
        # The smallest part around each node, then the part of that part's name: paths halve with each turn.
        around = inside.join(part.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("part").alias("least"))
        new = part.join(around.withColumnRenamed("a", "node"), "node", "left").select("node", "part", F.least("part", F.coalesce("least", "part")).alias("next"))
        jump = new.select(F.col("node").alias("next"), F.col("next").alias("further"))
        new = saved(new.join(jump, "next").select("node", F.col("part").alias("before"), F.least("next", "further").alias("part")))
        part = new.select("node", "part")
        if new.filter("part != before").isEmpty():
            return nodes.join(part, "node").select("node", "degree", F.col("part").alias("community"))


def moved_in_turn(starts: np.ndarray, targets: np.ndarray, weights: np.ndarray, degree: np.ndarray, resolution: float) -> np.ndarray:
    """Each node's community after single moves of the best gain; a move calls up the neighbours that aren't in that community."""
    community, total, two_m = list(range(len(degree))), degree.tolist(), float(degree.sum())
    degrees, waiting, queue = degree.tolist(), [True] * len(degree), deque(range(len(degree)))
    while queue:
        i = queue.popleft()
        waiting[i] = False
        own, around = targets[starts[i] : starts[i + 1]].tolist(), {}
        for j, w in zip(own, weights[starts[i] : starts[i + 1]].tolist(), strict=True):
            if j != i:
                around[community[j]] = around.get(community[j], 0.0) + w
        now = community[i]
        total[now] -= degrees[i]
        scale = resolution * degrees[i] / two_m
        stay = around.get(now, 0.0) - scale * total[now]
        worth, best = max(((w - scale * total[c], -c) for c, w in around.items()), default=(stay, -now))
        if worth > stay + 1e-12 * two_m:
            community[i] = -best
            for j in own:
                if community[j] != -best and not waiting[j]:
                    waiting[j] = True
                    queue.append(j)
        total[community[i]] += degrees[i]
    return np.array(community)


def _parts(community: np.ndarray, row: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smallest node of each connected part of each community."""
    part, inside = np.arange(len(community)), community[row] == community[target]
    row, target = row[inside], target[inside]
    while True:
        new = part.copy()
        np.minimum.at(new, row, part[target])
        new = new[new]
        if np.array_equal(new, part):
            return part
        part = new


def _to_the_end(batches, resolution: float) -> Iterator[pa.RecordBatch]:
    """old, community of a small graph's edges (a, b, w), both ways: levels of moves until none is worth it."""
    columns = [[b.column(i).to_numpy() for i in range(3)] for b in batches]
    if not columns:
        return
    a, b, w = (np.concatenate(c) for c in zip(*columns, strict=True))
    order = np.lexsort((b, a))
    names, a = np.unique(a[order], return_inverse=True)
    b, w = np.searchsorted(names, b[order]), w[order]
    label = np.arange(len(names))
    while True:
        n = int(a.max()) + 1
        degree = np.bincount(a, np.where(a == b, 2 * w, w), n)
        found = _parts(moved_in_turn(np.searchsorted(a, np.arange(n + 1)), b, w, degree, resolution), a, b)
        kept, found = np.unique(found, return_inverse=True)
        label = found[label]
        if len(kept) == n:
            break
        w = np.where((found[a] == found[b]) & (a != b), w / 2, w)
        pairs, at = np.unique(found[a] * len(kept) + found[b], return_inverse=True)
        w, a, b = np.bincount(at, w), pairs // len(kept), pairs % len(kept)
    first = np.full(int(label.max()) + 1, len(names))
    np.minimum.at(first, label, np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[first[label]])], names=["old", "community"])


def modularity_communities(edges: DataFrame, resolution: float = 1.0, few_edges: int = FEW_EDGES) -> Communities:
    """Communities of a graph of ``edges`` (a, b, w): long nodes, weights above 0, each edge once or several times.

    Every community is connected. Nodes without edges aren't there; a loop counts for its node's degree. An
    empty graph gives no rows. A higher resolution gives more and smaller communities.
    """
    spark = edges.sparkSession
    saved, history = Saved(spark), []
    graph = saved(undirected(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.col("w").cast("double").alias("w")).filter("w > 0")))
    nodes = graph.groupBy("a").agg(F.sum(F.when(F.col("a") == F.col("b"), 2 * F.col("w")).otherwise(F.col("w"))).alias("degree")).withColumnRenamed("a", "node")
    nodes = saved(nodes.withColumn("community", F.col("node")))
    two_m = nodes.agg(F.sum("degree")).first()[0]
    labels = nodes.select("node", "community")
    if not two_m:
        return Communities(labels, history)
    n = nodes.count()
    whole = graph
    for level in range(LEVELS):
        if graph.count() <= few_edges:
            last = graph.coalesce(1).mapInArrow(lambda b: _to_the_end(b, resolution), "old long, community long")
            labels = saved(labels.withColumnRenamed("community", "old").join(last, "old").select("node", "community"))
            history.append(modularity(whole.filter("a <= b"), labels, resolution))
            break
        loops = graph.filter("a = b").agg(F.sum(2 * F.col("w"))).first()[0] or 0.0
        moved = connected_labels(saved, _moves(saved, nodes, graph, two_m, loops, resolution, history, level), graph)
        labels = saved(labels.withColumnRenamed("community", "old").join(moved.select(F.col("node").alias("old"), "community"), "old").select("node", "community"))
        named = moved.select("node", "community")
        coarse = graph.join(named.withColumnRenamed("node", "a").withColumnRenamed("community", "ca"), "a").join(named.withColumnRenamed("node", "b").withColumnRenamed("community", "cb"), "b")
        # Both directions are rows, so that edges inside a community are there twice; loops once.
        weight = F.when((F.col("ca") == F.col("cb")) & (F.col("a") != F.col("b")), F.col("w") / 2).otherwise(F.col("w"))
        graph = saved(coarse.groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum(weight).alias("w")))
        nodes = saved(moved.groupBy("community").agg(F.sum("degree").alias("degree")).select(F.col("community").alias("node"), "degree", "community"))
        before, n = n, nodes.count()
        if n == before or n == 1:
            break
    return Communities(labels, history)
