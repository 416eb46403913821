"""Components and residuals of cells by genes without rows for zeros.

A standardised matrix is a sparse one plus a row that all cells share: a gene's zeros all have the value
-mean / deviation. Its centred form is D - 1 d', where D holds what the non-zeros differ by and d its
column means. Multiplying with it needs the non-zeros alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoforge.sources.shared import Saved

CELL = ["sampleID", "CB"]
#: Further directions that subspace iteration carries, rounds at most, and the change of the values that ends it.
MORE, ROUNDS, CHANGE = 10, 30, 1e-9
#: Values of a block of cells by genes that a task multiplies at once.
VALUES = 1 << 20


def gene_moments(x: DataFrame, n: int) -> DataFrame:
    """associated_gene, mean, sd (of n cells, zeros included) from the non-zeros; each cell and gene has one row."""
    sums = x.groupBy("associated_gene").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    mean = F.col("s") / n
    return sums.select("associated_gene", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") - n * mean * mean, F.lit(0.0)) / max(n - 1, 1)).alias("sd"))


def scaled_parts(x: DataFrame, n: int, most: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Non-zeros (sampleID, CB, associated_gene, d) and genes (associated_gene, zero): standardised values cut at ``most`` are zero + d, and zero elsewhere."""
    moments = gene_moments(x, n).select("associated_gene", "mean", "sd", F.coalesce(F.least(F.try_divide(-F.col("mean"), "sd"), F.lit(most)), F.lit(0.0)).alias("zero"))
    z = F.coalesce(F.least(F.try_divide(F.col("x") - F.col("mean"), F.col("sd")), F.lit(most)), F.lit(0.0))
    return x.join(moments, "associated_gene").select(*CELL, "associated_gene", (z - F.col("zero")).alias("d")), moments.select("associated_gene", "zero")


def _dense_blocks(lists: pa.Array, values: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a batch by all chosen genes, some at a time so that a block has about VALUES values: the first row, and the block."""
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    genes, own = lists.flatten().to_numpy(), values.flatten().to_numpy()
    step = max(VALUES // max(width, 1), 1)
    for a in range(0, len(lists), step):
        n = np.diff(ends[a : a + step + 1])
        block, at = np.zeros((len(n), width)), slice(ends[a], ends[a + len(n)])
        block[np.repeat(np.arange(len(n)), n), genes[at]] = own[at]
        yield a, block


def _multiplied(batches, basis, shift) -> Iterator[pa.RecordBatch]:
    """D' (D - 1 d') V by gene, and the sum of (D - 1 d') V over cells as gene -1, of each task's cells."""
    v, s = basis.value, shift.value
    out, total = np.zeros_like(v), np.zeros(v.shape[1])
    for batch in batches:
        for _, d in _dense_blocks(batch.column(0), batch.column(1), len(v)):
            y = d @ v - s
            out += d.T @ y
            total += y.sum(0)
    used = np.flatnonzero(np.abs(out).max(1) > 0)
    rows = [total.tolist(), *out[used].tolist()]
    yield pa.RecordBatch.from_arrays([pa.array([-1, *used.tolist()], pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["gene", "y"])


def _projected(batches, basis, shift) -> Iterator[pa.RecordBatch]:
    """Components of each cell."""
    v, s = basis.value, shift.value
    for batch in batches:
        y = np.zeros((batch.num_rows, v.shape[1]))
        for a, d in _dense_blocks(batch.column(2), batch.column(3), len(v)):
            y[a : a + len(d)] = d @ v - s
        pcs = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1], pa.array(y.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pcs], names=[*CELL, "pcs"])


def sparse_components(parts: DataFrame, cells: DataFrame, n_pc: int = 30, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(sampleID, CB, pcs) and (pc, variance, ratio): principal components of zero + d without dense rows.

    ``parts`` has sampleID, CB, associated_gene, d for chosen genes (thousands: their names and a matrix of genes by
    components are kept in each task); ``cells`` has all cells, those without a non-zero too. Randomised
    subspace iteration: a round is one pass over the cells' sparse rows, from which each task gives a row for each
    gene. A component's sign makes its largest loading positive. No cells or genes give no components.
    """
    spark = cells.sparkSession
    saved = Saved(spark)
    genes = [r[0] for r in parts.select("associated_gene").distinct().orderBy("associated_gene").collect()]
    number = F.broadcast(spark.createDataFrame([(g, i) for i, g in enumerate(genes)], "associated_gene string, gene int"))
    each = parts.join(number, "associated_gene").groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("gene", "d"))).alias("own"))
    own = saved(cells.select(*CELL).distinct().join(each, CELL, "left").select(*CELL, F.coalesce("own.gene", F.array().cast("array<int>")).alias("genes"), F.coalesce("own.d", F.array().cast("array<double>")).alias("d")))
    n = own.count()
    mean = np.zeros(len(genes))
    for r in own.select(F.inline(F.arrays_zip(F.col("genes").alias("g"), F.col("d").alias("d")))).groupBy("g").agg(F.sum("d").alias("s")).collect():  # a row for each gene
        mean[r["g"]] = r["s"] / n
    k = min(n_pc, len(genes), max(n - 1, 0))
    width = min(k + MORE, len(genes))
    basis, before = np.linalg.qr(np.random.default_rng(0).normal(size=(len(genes), max(width, 1))))[0], None
    ritz, values = basis, np.zeros(0)
    for _ in range(rounds if k else 0):
        v, s = spark.sparkContext.broadcast(basis), spark.sparkContext.broadcast(mean @ basis)
        sums = own.select("genes", "d").mapInArrow(lambda b, v=v, s=s: _multiplied(b, v, s), "gene int, y array<double>")
        out, total = np.zeros_like(basis), np.zeros(basis.shape[1])
        for r in sums.groupBy("gene").agg(*(F.sum(F.col("y")[i]) for i in range(basis.shape[1]))).collect():  # a row for each gene
            if r[0] < 0:
                total = np.array(r[1:])
            else:
                out[r[0]] = r[1:]
        product = (out - np.outer(mean, total)) / max(n - 1, 1)
        values, turn = np.linalg.eigh((basis.T @ product + product.T @ basis) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = basis @ turn
        if before is not None and np.abs(values[:k] - before[:k]).max() <= CHANGE * max(values[0], 1e-300):
            break
        before, basis = values, np.linalg.qr(product @ turn)[0]
    top = ritz[:, :k]
    if k:
        sign = np.sign(top[np.abs(top).argmax(0), np.arange(k)])
        top = top * np.where(sign == 0, 1, sign)
    v, s = spark.sparkContext.broadcast(top), spark.sparkContext.broadcast(mean @ top)
    scores = own.mapInArrow(lambda b: _projected(b, v, s), "sampleID string, CB string, pcs array<double>")
    whole = (own.select(F.explode("d").alias("d")).agg(F.sum(F.col("d") * F.col("d"))).first()[0] or 0.0) / max(n - 1, 1) - float(mean @ mean) * n / max(n - 1, 1)
    rows = [(i + 1, float(values[i]), float(values[i] / whole) if whole else 0.0) for i in range(k)]
    return scores, spark.createDataFrame(rows, "pc int, variance double, ratio double")


def pca_sparse(x: DataFrame, genes: DataFrame, n_pc: int = 30, most: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Components of the chosen genes' standardised values; ``x`` has sampleID, CB, associated_gene and non-zero x, ``genes`` the chosen names."""
    cells = x.select(*CELL).distinct()
    chosen = x.join(F.broadcast(genes.select("associated_gene")), "associated_gene", "left_semi")
    return sparse_components(scaled_parts(chosen, cells.count(), most)[0], cells, n_pc)


def zero_residual(r, c, total: float, theta: float, most: float):
    """The residual of a zero as a function of its cell's sum and its gene's."""
    mu = r * c / total
    return F.greatest(-mu / F.sqrt(mu + mu * mu / theta), F.lit(-most))


def pearson_parts(m: DataFrame, theta: float = 100.0) -> tuple[DataFrame, DataFrame, DataFrame, float, float]:
    """Residuals of non-zeros (sampleID, CB, associated_gene, x, zero), cells (sampleID, CB, r), genes (associated_gene, c), the total and the cut.

    ``zero`` is what the residual would be without a count. A residual that has no row is ``zero_residual`` of its cell's and gene's sums.
    """
    own = m.select(*CELL, "associated_gene", F.col("count").cast("double").alias("count"))
    cells, genes = own.groupBy(*CELL).agg(F.sum("count").alias("r")), own.groupBy("associated_gene").agg(F.sum("count").alias("c"))
    total, n = cells.agg(F.coalesce(F.sum("r"), F.lit(0.0)), F.count("*")).first()
    most = float(n) ** 0.5
    mu = F.col("r") * F.col("c") / (total or 1.0)
    z = F.greatest(F.least((F.col("count") - mu) / F.sqrt(mu + mu * mu / theta), F.lit(most)), F.lit(-most))
    both = own.join(cells, CELL).join(genes, "associated_gene")
    return both.select(*CELL, "associated_gene", z.alias("x"), zero_residual(F.col("r"), F.col("c"), total or 1.0, theta, most).alias("zero")), cells, genes, total or 1.0, most


def residual_moments(m: DataFrame, theta: float = 100.0) -> DataFrame:
    """associated_gene, mean, variance of all cells' residuals.

    Zeros are summed over the different cell sums, each counted, instead of over cells; then the non-zeros' part is put
    right from their own rows. Cell sums are counts, so that there are far fewer of them than cells.
    """
    rows, cells, genes, total, most = pearson_parts(m, theta)
    n = cells.count()
    sums = cells.groupBy("r").agg(F.count("*").alias("k"))
    # Genes meet blocks of different sums, packed into arrays: no row is made for a gene and a sum.
    packed = sums.groupBy(F.pmod(F.xxhash64("r"), F.lit(64)).alias("b")).agg(F.collect_list(F.struct("r", "k")).alias("sums"))
    per = genes.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(63)))).join(packed, "b")
    value = lambda s: zero_residual(s["r"], F.col("c"), total, theta, most)
    fold = lambda power: F.aggregate("sums", F.lit(0.0), lambda t, s: t + s["k"] * (value(s) if power == 1 else value(s) * value(s)))
    all_zero = per.select("associated_gene", fold(1).alias("s"), fold(2).alias("q")).groupBy("associated_gene").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    right = rows.groupBy("associated_gene").agg(F.sum(F.col("x") - F.col("zero")).alias("ds"), F.sum(F.col("x") * F.col("x") - F.col("zero") * F.col("zero")).alias("dq"))
    s, q = F.col("s") + F.col("ds"), F.col("q") + F.col("dq")
    return all_zero.join(right, "associated_gene").select("associated_gene", (s / n).alias("mean"), (F.greatest(q - s * s / n, F.lit(0.0)) / max(n - 1, 1)).alias("variance"))
