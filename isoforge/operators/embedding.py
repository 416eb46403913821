"""The neighbour graph of cells: weights by local scales, and coordinates from its Laplacian."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoforge.sources.shared import Saved

CELL = ["sampleID", "CB"]
#: Halvings of the interval that holds a cell's scale, and the least scale as a share of its mean distance.
HALVINGS, LEAST_SCALE = 64, 1e-3
#: Columns of the block that power iteration works on, products between two looks at it, looks at most, and the residual that ends it.
BLOCK, PRODUCTS, ROUNDS, RESIDUAL = 8, 8, 8, 1e-3


def local_scales(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest, scale) of each row of distances: sum of exp(-(d - nearest)+ / scale) is log2 of their number."""
    positive = np.where(distances > 0, distances, np.inf)
    nearest = np.where(np.isfinite(positive.min(1)), positive.min(1), 0.0)
    beyond, target = np.maximum(distances - nearest[:, None], 0), np.log2(distances.shape[1])
    low, high = np.zeros(len(distances)), np.full(len(distances), np.inf)
    scale = np.ones(len(distances))
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(HALVINGS):
            more = np.exp(-beyond / scale[:, None]).sum(1) > target
            high, low = np.where(more, scale, high), np.where(more, low, scale)
            scale = np.where(np.isfinite(high), (low + high) / 2, scale * 2)
    return nearest, np.maximum(scale, LEAST_SCALE * np.maximum(distances.mean(1), 1e-300))


def _weighted(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        lengths = np.diff(lists.offsets.to_numpy())
        own = lists.flatten()
        d = own.field(own.type.get_field_index("distance")).to_numpy(zero_copy_only=False)
        out, begins = np.zeros(len(d)), np.cumsum(lengths) - lengths
        for n in np.unique(lengths[lengths > 0]):
            rows = np.flatnonzero(lengths == n)
            at = begins[rows][:, None] + np.arange(n)
            nearest, scale = local_scales(d[at])
            out[at] = np.exp(-np.maximum(d[at] - nearest[:, None], 0) / scale[:, None])
        row = pa.array(np.repeat(np.arange(len(lengths)), lengths))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), own.field(own.type.get_field_index("neighbour")), pa.array(out)], names=[*CELL, "neighbour", "w"])


def fuzzy_graph(neighbours: DataFrame) -> DataFrame:
    """one, other (structs of sampleID and CB, one < other), w: weights of both directions a and b together as a + b - ab."""
    lists = neighbours.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("rank", "distance", "neighbour"))).alias("near"))  # k of each cell
    directed = lists.mapInArrow(_weighted, "sampleID string, CB string, neighbour struct<sampleID:string,CB:string>, w double")
    cell = F.struct(*CELL)
    pairs = directed.select(F.least(cell, "neighbour").alias("one"), F.greatest(cell, "neighbour").alias("other"), "w").groupBy("one", "other")
    return pairs.agg(F.sum("w").alias("s"), F.min("w").alias("b"), F.max("w").alias("a"), F.count("*").alias("n")).select("one", "other", F.when(F.col("n") > 1, F.col("s") - F.col("a") * F.col("b")).otherwise(F.col("s")).alias("w"))


def numbered_graph(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, cell) and (a, b, w) by numbers: a cell's hash, and that with its names where cells share one."""
    cells = graph.select(F.explode(F.array("one", "other")).alias("cell")).distinct()
    hashed = cells.select(F.xxhash64("cell").alias("h"), "cell").groupBy("h").agg(F.array_sort(F.collect_list("cell")).alias("own"))
    nodes = hashed.select("h", F.posexplode("own").alias("i", "cell")).select(F.when(F.col("i") == 0, F.col("h")).otherwise(F.xxhash64("h", "i")).alias("node"), "cell")
    a, b = (nodes.select(F.col("node").alias(n), F.col("cell").alias(c)) for n, c in (("a", "one"), ("b", "other")))
    return nodes, graph.join(a, "one").join(b, "other").select("a", "b", "w")


@dataclass
class Spectrum:
    """``vectors`` (node, degree, u1, u2, ...): eigenvectors of the normalised adjacency after the first; their values, residuals and the rounds that it took."""

    vectors: DataFrame
    values: np.ndarray
    residuals: np.ndarray
    rounds: int


def _gram(df: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """Products of columns, summed over all rows."""
    row = df.agg(*(F.sum(F.col(x) * F.col(y)) for x in left for y in right)).first()
    return np.array([v or 0.0 for v in row]).reshape(len(left), len(right))


def _combined(df: DataFrame, names: list[str], matrix: np.ndarray, out: str) -> list:
    return [sum((F.col(n) * float(matrix[i, j]) for i, n in enumerate(names)), F.lit(0.0)).alias(f"{out}{j}") for j in range(matrix.shape[1])]


def spectral(edges: DataFrame, k: int = 2, block: int = BLOCK, products: int = PRODUCTS, rounds: int = ROUNDS, residual: float = RESIDUAL) -> Spectrum:
    """The ``k`` leading eigenvectors, but for the first, of S = D^-1/2 W D^-1/2 for ``edges`` (a, b, w), each given once.

    Block power iteration: a product multiplies ``block`` columns at once, in one join. Between two looks the products
    follow Chebyshev's recurrence, which damps values from -1 up to the least one that the block has found, and so needs
    far fewer than plain powers. A look solves the small problem within the block (Rayleigh-Ritz): only products
    of columns, block x block numbers, reach the driver. The first eigenvector, the root of the degrees, is parted.
    A residual is the length of S u - value u for u of length 1. A sign makes the entry of the smallest node positive.
    """
    saved = Saved(edges.sparkSession)
    both = edges.select(F.inline(F.array(F.struct("a", "b", "w"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "w"))))
    degree = saved(both.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("degree")))
    total, n = degree.agg(F.sum("degree"), F.count("*")).first()
    width = min(block, max(n - 1, 1))
    own, other = degree.select(F.col("node").alias("a"), F.col("degree").alias("da")), degree.select(F.col("node").alias("b"), F.col("degree").alias("db"))
    s = saved(both.join(own, "a").join(other, "b").select("a", "b", (F.col("w") / F.sqrt(F.col("da") * F.col("db"))).alias("s")))
    x, p, y = ([f"{c}{i}" for i in range(width)] for c in "xpy")
    start = [((F.pmod(F.xxhash64("node", F.lit(i)), F.lit(1 << 20)) / (1 << 19)) - 1.0).alias(c) for i, c in enumerate(x)]
    state = saved(degree.select("node", "degree", F.sqrt(F.col("degree") / (total or 1.0)).alias("t"), *start))
    parted = _gram(state, ["t"], x)[0]
    state = state.select("node", "degree", "t", *((F.col(c) - F.col("t") * float(a)).alias(c) for c, a in zip(x, parted, strict=True)))
    values, errors, turn, high = np.zeros(width), np.ones(width), 0, 0.5

    def multiplied(df: DataFrame) -> DataFrame:
        """With S x beside x."""
        sums = s.join(df.select(F.col("node").alias("b"), *x), "b").groupBy(F.col("a").alias("node")).agg(*(F.sum(F.col("s") * F.col(c)).alias(d) for c, d in zip(x, y, strict=True)))
        return df.join(sums, "node")

    for turn in range(1, rounds + 1):
        # T(j+1) = 2 (S - middle) / half T(j) - T(j-1) on the interval that is damped.
        middle, half = (high - 1) / 2, (high + 1) / 2
        for j in range(products):
            made = multiplied(state)
            next_ = [((F.col(d) - middle * F.col(c)) / half * (2 if j else 1) - (F.col(q) if j else 0.0)).alias(c) for c, d, q in zip(x, y, p, strict=True)]
            state = saved(made.select("node", "degree", "t", *next_, *(F.col(c).alias(q) for c, q in zip(x, p, strict=True))))
        looked = saved(multiplied(state).select("node", "degree", "t", *x, *y))
        gram, cross, square, along = _gram(looked, x, x), _gram(looked, x, y), _gram(looked, y, y), _gram(looked, ["t"], x)[0]
        gram, cross, square = (g - np.outer(along, along) for g in (gram, cross, square))  # S keeps the parted vector
        length = np.sqrt(np.maximum(np.diag(gram), 1e-300))
        scale, turned = np.linalg.eigh(gram / np.outer(length, length))
        good = scale > 1e-10 * max(scale.max(initial=0.0), 1e-300)
        basis = turned[:, good] / np.sqrt(scale[good]) / length[:, None]
        values, rotation = np.linalg.eigh(basis.T @ ((cross + cross.T) / 2) @ basis)
        order = np.argsort(-values)
        values, basis = values[order], basis @ rotation[:, order]
        errors = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", basis, square, basis) - values**2, 0))
        width = basis.shape[1]
        centred = looked.select("node", "degree", "t", *((F.col(c) - F.col("t") * float(a)).alias(c) for c, a in zip(x, along, strict=True)))
        state = centred.select("node", "degree", "t", *_combined(centred, x, basis, "x"))
        x, p, y = x[:width], p[:width], y[:width]
        high = float(min(max(values[-1], -0.5), values[min(k, width) - 1] - 1e-3))
        if (errors[:k] <= residual).all():
            break
    kept = min(k, width)
    state = saved(state)
    first = state.agg(*(F.min_by(F.signum(c), F.when(F.abs(c) > 1e-9, F.col("node"))) for c in x[:kept])).first()
    columns = [(F.col(c) * float(f or 1.0)).alias(f"u{i}") for i, (c, f) in enumerate(zip(x[:kept], first, strict=True), 1)]
    return Spectrum(saved(state.select("node", "degree", *columns)), values[:kept], errors[:kept], turn)


def embed_cells(neighbours: DataFrame, residual: float = RESIDUAL) -> DataFrame:
    """sampleID, CB, UMAP_1, UMAP_2: coordinates of each cell from the fuzzy graph's Laplacian; 0 where there are fewer vectors.

    They are what the usual embedding starts from: eigenvectors over the root of the degree, scaled to a largest size of 10.
    No neighbours give no rows.
    """
    saved = Saved(neighbours.sparkSession)
    nodes, edges = numbered_graph(saved(fuzzy_graph(neighbours)))
    nodes = saved(nodes)
    found = spectral(saved(edges), residual=residual)
    names = [f"u{i + 1}" for i in range(len(found.values))]
    raw = found.vectors.select("node", *((F.col(c) / F.sqrt("degree")).alias(c) for c in names))
    most = raw.agg(*(F.max(F.abs(c)) for c in names)).first() if names else []
    scaled = [(F.col(c) * (10.0 / m if m else 1.0)).alias(f"UMAP_{i}") for i, (c, m) in enumerate(zip(names, most, strict=True), 1)]
    scaled += [F.lit(0.0).alias(f"UMAP_{i}") for i in range(len(names) + 1, 3)]
    return raw.select("node", *scaled).join(nodes, "node").select("cell.*", "UMAP_1", "UMAP_2")
