"""Nearest neighbours of cells, exact at any number of cells, from lists with bounds.

Cells are dealt into lists by their nearest centre, and lists that lie near each other into blocks of bounded size. A
block's own cells give each a first bound on its k-th distance. By the triangle inequality a list whose centre is
farther than that bound and the list's radius together holds no nearer cell; a cell visits the blocks that hold any
other list, and is compared with those lists there by numpy. What travels is each cell's row, once for each block
that it visits and each slice of its own block's visitors, and k pairs back; pairs of cells are never rows before that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.sources.shared import Saved

CELL = ["sampleID", "CB"]
#: Lists at most: beyond, they become longer and have more blocks.
MOST_LISTS = 4096
#: Cells of a list, about, and of a block at most about; cells for each centre from which centres are fitted, and rounds.
LIST_CELLS, BLOCK_CELLS, FIT_CELLS, FIT_ROUNDS = 1024, 32768, 16, 4
#: Blocks at least, if each has LEAST_CELLS, and slices of visitors, each of SLICE_CELLS of all cells at least and SLICES at most, so that there are tasks enough.
BLOCKS, LEAST_CELLS, SLICES, SLICE_CELLS = 8, 2048, 16, 8192
#: Partitions at most that blocks and slices are dealt to.
MOST_TILES = 2048
#: Visitors that are compared with a block at once, and pairs that wait for their exact distances.
ROWS, WAITING = 1024, 1 << 16

_CELLS = "sampleID string, CB string, pcs array<double>, list int, d double"
_BLOCKS = "block int, slice int, kind int, list int, sampleID string, CB string, pcs array<double>, bound double"
_PAIRS = "sampleID string, CB string, neighbour struct<sampleID:string,CB:string>, distance double"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows, to about half of the digits."""
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T
    return np.sqrt(np.maximum(square, 0))


def fit_centres(sample: np.ndarray, n: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Centres of lists: the first rows, moved to the means of their cells."""
    centres = sample[:n].copy()
    for _ in range(rounds):
        at = np.concatenate([_far(sample[a : a + 1024], centres).argmin(1) for a in range(0, len(sample), 1024)])
        count = np.bincount(at, minlength=n)
        total = np.zeros_like(centres)
        np.add.at(total, at, sample)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def _assigned(batches, centres) -> Iterator[pa.RecordBatch]:
    """Each cell's list and its distance from the list's centre."""
    for batch in batches:
        x = _matrix(batch.column(2))
        at = _far(x, centres.value).argmin(1) if len(x) else np.zeros(0, np.int64)
        d = np.sqrt(((x - centres.value[at]) ** 2).sum(1)) if len(x) else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(d)], names=[*batch.schema.names, "list", "d"])


def near_lists(centres: np.ndarray, sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Lists in groups of at most ``most`` cells that lie near each other: halved across the widest coordinate while larger; longer lists stand alone."""
    out, left = [], [np.flatnonzero(sizes > 0)]
    while left:
        own = left.pop()
        if len(own) <= 1 or sizes[own].sum() <= most:
            out += [own] if len(own) else []
            continue
        x = centres[own]
        own = own[np.argsort(x[:, np.ptp(x, axis=0).argmax()], kind="stable")]
        cut = int(np.clip(np.searchsorted(np.cumsum(sizes[own]), sizes[own].sum() / 2) + 1, 1, len(own) - 1))
        left += [own[cut:], own[:cut]]
    return out


def _within(x: np.ndarray, centres: np.ndarray, radii: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which lists may hold a cell within each row's bound."""
    size = np.abs(x).max(initial=0) + np.abs(centres).max(initial=0)
    return _far(x, centres) - radii[None] <= bounds[:, None] + 1e-6 * (size * max(1, x.shape[1]) + radii[None])


class _Block:
    """Cells of a block by list, that visitors are compared with: roughly in single precision, then those within the bound exactly."""

    def __init__(self, cells: pa.Table, k: int, centres: np.ndarray, radii: np.ndarray):
        self.k, self.cells = k, cells.sort_by([("list", "ascending"), ("sampleID", "ascending"), ("CB", "ascending")]).combine_chunks().to_batches()[0]
        self.x, lists = _matrix(self.cells.column(6)), self.cells.column(3).to_numpy()
        self.lists, starts = np.unique(lists, return_index=True)
        self.starts = [*starts.tolist(), len(lists)]
        self.centres, self.radii = centres[self.lists], radii[self.lists]
        self.name = np.empty(len(lists), np.int64)  # a cell's place by name
        self.name[pc.sort_indices(self.cells.select(["sampleID", "CB"]), sort_keys=[("sampleID", "ascending"), ("CB", "ascending")]).to_numpy()] = np.arange(len(lists))
        self.places = {n: i for i, n in enumerate(zip(self.cells.column(4).to_pylist(), self.cells.column(5).to_pylist(), strict=True))}
        self.middle = self.x.mean(0)
        self.scale = np.abs(self.x - self.middle).max(initial=0) or 1.0
        y = ((self.x - self.middle) / self.scale).astype(np.float32)
        self.square = (y * y).sum(1)
        self.rough = np.ascontiguousarray(np.column_stack((y, self.square)).T)
        self.longest = float(self.square.max(initial=0))

    def _kept(self, x, row, member, far):
        """The k nearest of each row, and what is the k-th distance of rows that have so many."""
        order = np.lexsort((self.name[member], far, row))
        row, member, far = row[order], member[order], far[order]
        n = np.bincount(row, minlength=len(x))
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        row, member, far = (v[place < self.k] for v in (row, member, far))
        last = np.full(len(x), np.inf)
        last[row[place[place < self.k] == self.k - 1]] = far[place[place < self.k] == self.k - 1]
        return row, member, far, last

    def nearest(self, x: np.ndarray, bounds: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, member and distance of the k nearest members within each row's bound, of equally near ones the first by name; ``own``: the rows' own places, which don't count."""
        y = ((x - self.middle) / self.scale).clip(-1e15, 1e15).astype(np.float32)
        square = (y.astype(float) ** 2).sum(1)
        slack = 2.5e-7 * (x.shape[1] + 8) * (square + self.longest) + 1e-30
        twice, bounds = np.column_stack((-2 * y, np.ones(len(y), np.float32))), bounds.copy()
        row, member, far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        waiting, held = [], 0
        home = np.searchsorted(self.starts, own, "right") - 1 if own is not None else None
        near = _within(x, self.centres, self.radii, bounds)

        def settle():
            nonlocal row, member, far, held
            if waiting:
                r, m = (np.concatenate(v) for v in zip(*waiting, strict=True))
                d = [np.sqrt(((self.x[m[i : i + WAITING]] - x[r[i : i + WAITING]]) ** 2).sum(1)) for i in range(0, len(r), WAITING)]
                row, member, far, last = self._kept(x, np.concatenate((row, r)), np.concatenate((member, m)), np.concatenate((far, *d)))
                np.minimum(bounds, last, out=bounds)
                waiting.clear()
                held = 0

        def compare(i, rows, first=False):
            nonlocal held
            a, b = self.starts[i], self.starts[i + 1]
            for c in range(a, b, 4 * ROWS):
                e = min(c + 4 * ROWS, b)
                g = twice[rows] @ self.rough[:, c:e]
                if own is not None:
                    there = np.flatnonzero((own[rows] >= c) & (own[rows] < e))
                    g[there, own[rows][there] - c] = np.inf
                most = np.nextafter(((bounds[rows] / self.scale) ** 2 - square[rows] + slack[rows]).astype(np.float32), np.float32(np.inf))
                if first and e - c > self.k:
                    kth = np.partition(g, self.k - 1, axis=1)[:, self.k - 1]
                    most = np.minimum(most, kth + 2 * slack[rows].astype(np.float32))
                at = np.flatnonzero((g <= most[:, None]) & (g < np.inf))
                waiting.append((rows[at // (e - c)], at % (e - c) + c))
                held += len(at)
                if held > WAITING:
                    settle()

        if home is not None:  # its own list bounds what a cell seeks in others
            for i in np.unique(home).tolist():
                compare(i, np.flatnonzero(home == i), True)
            settle()
            near = _within(x, self.centres, self.radii, bounds) & (np.arange(len(self.lists))[None] != home[:, None])
        for i in range(len(self.lists)):
            rows = np.flatnonzero(near[:, i])
            if len(rows):
                compare(i, rows)
        settle()
        return row, member, far


def _compared(batches, k: int, centres, radii) -> Iterator[pa.RecordBatch]:
    """Neighbours of each block's visitors in it; of its own cells if ``kind`` says so (2). Rows come sorted by block, slice and kind."""
    at, parts, block = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if b <= a:
                continue
            if tuple(keys[a, :2]) != at:
                at, parts, block = tuple(keys[a, :2]), [], None
            if keys[a, 2] == 0:
                parts.append(batch.slice(a, b - a))
                continue
            if not parts:
                continue
            block = block or _Block(pa.Table.from_batches(parts), k, centres.value, radii.value)
            for c in range(a, b, ROWS):
                yield from _pairs(block, batch.slice(c, min(ROWS, b - c)), keys[a, 2] == 2)


def _pairs(block: _Block, visitors: pa.RecordBatch, at_home: bool) -> Iterator[pa.RecordBatch]:
    own = None
    if at_home:
        own = np.array([block.places[n] for n in zip(visitors.column(4).to_pylist(), visitors.column(5).to_pylist(), strict=True)])
    row, member, far = block.nearest(_matrix(visitors.column(6)), visitors.column(7).to_numpy(), own)
    if len(row):
        mine, other = visitors.take(pa.array(row)), block.cells.take(pa.array(member))
        both = pa.StructArray.from_arrays([other.column(4), other.column(5)], names=CELL)
        yield pa.RecordBatch.from_arrays([mine.column(4), mine.column(5), both, pa.array(far)], names=["sampleID", "CB", "neighbour", "distance"])


def _visits(batches, centres, radii, blocks, probes: int | None, slices: int) -> Iterator[pa.RecordBatch]:
    """A row of each cell for each block with a list that may hold a nearer cell than its bound, but for its own block.

    Columns of ``batches``: sampleID, CB, pcs, list, block, slice, bound. ``blocks``: lists, group by group, where groups begin, their first blocks and how many each has.
    """
    order, begins, firsts, counts = blocks.value
    for batch in batches:
        own = batch.column(4).to_numpy()
        bound = batch.column(6).to_numpy()
        for a in range(0, batch.num_rows, ROWS):
            x = _matrix(batch.column(2).slice(a, ROWS))
            near = _within(x, centres.value, radii.value, bound[a : a + ROWS])
            if probes is not None:
                far = _far(x, centres.value)
                nearest = np.argpartition(far, min(probes, far.shape[1]) - 1, axis=1)[:, :probes]
                kept = np.zeros_like(near)
                np.put_along_axis(kept, nearest, True, 1)
                near &= kept
            row, group = np.nonzero(np.logical_or.reduceat(near[:, order], begins, axis=1))
            n = counts[group]
            rows = np.repeat(row, n)
            target = np.repeat(firsts[group], n) + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            keep = np.flatnonzero(target != own[a + rows])
            for b in range(0, len(keep), 4096):
                r, t = rows[keep[b : b + 4096]], target[keep[b : b + 4096]]
                some = batch.slice(a, ROWS).take(pa.array(r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.astype(np.int32)), some.column(5), pa.array(np.ones(len(r), np.int32)), *(some.column(i) for i in (3, 0, 1, 2, 6))],
                    names=["block", "slice", "kind", "list", "sampleID", "CB", "pcs", "bound"],
                )


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*CELL).orderBy("distance", "neighbour"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select(*CELL, "neighbour", "rank", "distance")


def knn_cells(pcs: DataFrame, k: int = 15, probes: int | None = None, list_cells: int = LIST_CELLS, block_cells: int | None = None) -> DataFrame:
    """sampleID, CB, neighbour (a struct of both), rank, distance: the k nearest other cells, of equally near ones those first by name.

    Exact for any number of cells: ``probes`` bounds the lists that a cell visits, nearest centres first, and
    gives it up for that. Cells whose components are null or not finite take no part; ``pcs`` has a row for each
    cell, all of one length. With fewer cells than k + 1 all others are neighbours. No cells give no rows.
    """
    spark = pcs.sparkSession
    saved = Saved(spark)
    finite = F.forall("pcs", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cells = saved(pcs.select(*CELL, "pcs").filter(F.col("pcs").isNotNull() & finite))
    n = cells.count()
    if not n:
        return spark.createDataFrame([], "sampleID string, CB string, neighbour struct<sampleID:string,CB:string>, rank int, distance double")
    lists = min(-(-n // list_cells), MOST_LISTS)
    sample = [r["pcs"] for r in cells.orderBy(F.xxhash64(*CELL), *CELL).limit(lists * FIT_CELLS).select("pcs").collect()]  # of 16 times MOST_LISTS cells at most
    centres = spark.sparkContext.broadcast(fit_centres(np.array(sample, float).reshape(len(sample), -1), min(lists, len(sample))))
    own = saved(cells.mapInArrow(lambda b: _assigned(b, centres), _CELLS))
    stats = {r["list"]: (r["n"], r["d"]) for r in own.groupBy("list").agg(F.count("*").alias("n"), F.max("d").alias("d")).collect()}
    radii = spark.sparkContext.broadcast(np.array([stats.get(i, (0, 0.0))[1] for i in range(lists)]))
    sizes = np.array([stats.get(i, (0, 0.0))[0] for i in range(lists)])
    most = block_cells or min(BLOCK_CELLS, max(LEAST_CELLS, -(-n // BLOCKS)))
    groups = near_lists(centres.value, sizes, most)
    counts = np.array([-(-int(sizes[g].sum()) // most) for g in groups])
    firsts = np.cumsum(counts) - counts
    slices = int(max(min(SLICES, counts.sum(), n // SLICE_CELLS), 1))
    blocks = spark.sparkContext.broadcast((np.concatenate(groups), np.cumsum([0, *map(len, groups)])[:-1], firsts, counts))
    places = [(int(i), int(f), int(c)) for g, f, c in zip(groups, firsts, counts, strict=True) for i in g]
    of_list = F.broadcast(spark.createDataFrame(places, "list int, first int, blocks int"))  # a row for each list
    hashed = F.xxhash64(*CELL)
    own = own.join(of_list, "list").select(*CELL, "pcs", "list", (F.col("first") + F.pmod(hashed, F.col("blocks"))).cast("int").alias("block"), F.pmod(F.shiftright(hashed, 32), F.lit(slices)).cast("int").alias("slice"))
    own = saved(own)
    home = own.select("block", "slice", F.lit(2).alias("kind"), "list", *CELL, "pcs", F.lit(float("inf")).alias("bound"))
    members = home.select("block", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("kind"), "list", *CELL, "pcs", "bound")
    tiles = [int(min(counts.sum() * slices, MOST_TILES))] if slices > 1 else []  # a number that isn't lowered by rows' sizes, since time goes by pairs

    def compared(visitors: DataFrame) -> DataFrame:
        dealt = members.unionByName(visitors).repartition(*tiles, "block", "slice").sortWithinPartitions("block", "slice", "kind", "list")
        return saved(dealt.mapInArrow(lambda b: _compared(b, k, centres, radii), _PAIRS))

    first = compared(home)
    if int(counts.sum()) <= 1:
        return _ranked(first, k)
    bounds = first.groupBy(*CELL).agg(F.when(F.count("*") >= k, F.max("distance")).alias("bound"))
    bounded = own.join(bounds, CELL, "left").select(*CELL, "pcs", "list", "block", "slice", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    visits = bounded.mapInArrow(lambda b: _visits(b, centres, radii, blocks, probes, slices), _BLOCKS)
    return _ranked(first.unionByName(compared(visits)), k)
