"""Cells by genes, and clusters of cells."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.operators.communities import Communities, modularity_communities
from isoforge.operators.embedding import embed_cells, fuzzy_graph, numbered_graph
from isoforge.operators.neighbours import knn_cells
from isoforge.operators.sparse import pca_sparse, pearson_parts
from isoforge.sources.shared import Saved

#: A cell is a barcode of one sample; cells of all samples meet in one space.
CELL = ["sampleID", "CB"]
KEYS = (*CELL, "associated_gene")


def _of_cell(m: DataFrame):
    return F.sum("count").over(W.partitionBy(*CELL))


def normalize_log1p(m: DataFrame, target: float = 1e4) -> DataFrame:
    return m.select(*KEYS, F.log1p(F.col("count") / _of_cell(m) * target).alias("x"))


def normalize_sqrt(m: DataFrame) -> DataFrame:
    return m.select(*KEYS, F.sqrt("count").alias("x"))


def dense(m: DataFrame, genes: DataFrame, value: str = "x") -> DataFrame:
    """Zeros for the chosen genes that a cell lacks: cells times chosen genes rows, so choose genes first.

    The genes, a list that its choice bounds, are one row of an array that is broadcast.
    """
    names = genes.agg(F.array_sort(F.collect_set("associated_gene")).alias("names"))
    grid = m.select(*CELL).distinct().join(F.broadcast(names)).select(*CELL, F.explode("names").alias("associated_gene"))
    return grid.join(m, list(KEYS), "left").na.fill(0.0, [value])


def normalize_pearson(m: DataFrame, genes: DataFrame, theta: float = 100.0) -> DataFrame:
    """Residuals over the chosen genes, zeros too, cut at the square root of the number of cells.

    Each cell is one row with its counts, saved; zeros are made from it where it is, so that no row of a zero is shuffled. The
    genes with their sums, a list that its choice bounds, are broadcast.
    """
    chosen = F.broadcast(genes.select("associated_gene").distinct().withColumn("__chosen", F.lit(True)))
    count = F.coalesce(F.col("count").cast("double"), F.lit(0.0))
    own = m.select(*KEYS, count.alias("count")).join(chosen, "associated_gene", "left")
    counts = F.collect_list(F.when(F.col("__chosen"), F.struct("associated_gene", "count"))).alias("own")
    packed = Saved(m.sparkSession)(own.groupBy(*CELL).agg(counts, F.coalesce(F.sum(F.when(F.col("__chosen"), F.col("count"))), F.lit(0.0)).alias("r")))
    total, n = packed.agg(F.sum("r"), F.count("*")).first()
    sums = packed.select(F.inline("own")).groupBy("associated_gene").agg(F.sum("count").alias("c"))
    sums = F.broadcast(genes.select("associated_gene").distinct().join(sums, "associated_gene", "left").na.fill(0.0, ["c"]))
    names = F.broadcast(sums.agg(F.array_sort(F.collect_list("associated_gene")).alias("names")))
    zeros = F.transform(F.array_except("names", "own.associated_gene"), lambda g: F.struct(g.alias("associated_gene"), F.lit(0.0).alias("count")))
    full = packed.join(names).select(*CELL, "r", F.inline(F.concat("own", zeros))).join(sums, "associated_gene")
    mu = F.col("r") * F.col("c") / (total or 1.0)
    z = F.coalesce(F.try_divide(F.col("count") - mu, F.sqrt(mu + mu * mu / theta)), F.lit(0.0))
    return full.select(*KEYS, F.greatest(F.least(z, F.lit(n**0.5)), F.lit(-(n**0.5))).alias("x"))


def highly_variable_genes(x: DataFrame, n_top: int = 2000, bins: int = 20) -> DataFrame:
    """associated_gene, score: dispersion against that of genes with a like mean; zeros count."""
    n = x.select(*CELL).distinct().count()
    s = x.groupBy("associated_gene").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    mean = F.col("s") / n
    stats = s.select("associated_gene", mean.alias("mean"), F.try_divide((F.col("q") / n - mean * mean) * n / max(n - 1, 1), mean).alias("d"))
    low, high = stats.agg(F.min("mean"), F.max("mean")).first()
    width = ((high or 0) - (low or 0)) / bins or 1.0
    own = W.partitionBy("bin")
    stats = stats.withColumn("bin", F.least(F.floor((F.col("mean") - (low or 0)) / width), F.lit(bins - 1)))
    z = F.try_divide(F.col("d") - F.avg("d").over(own), F.stddev_samp("d").over(own))
    return stats.select("associated_gene", F.coalesce(z, F.lit(0.0)).alias("score")).orderBy(F.desc("score"), "associated_gene").limit(n_top)


def scale_clip(full: DataFrame, most: float = 10.0) -> DataFrame:
    """Standardised by gene and cut at ``most``; each gene's mean and deviation are aggregated and joined."""
    stats = full.groupBy("associated_gene").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"))
    z = F.try_divide(F.col("x") - F.col("mean"), F.col("sd"))
    return full.join(stats, "associated_gene").select(*KEYS, F.least(F.coalesce(z, F.lit(0.0)), F.lit(most)).alias("x"))


def pca_cells(full: DataFrame, n_pc: int = 30) -> DataFrame:
    """sampleID, CB, pcs: principal components of dense rows, at most as many as genes; ``pca_sparse`` needs the non-zeros alone."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("associated_gene", "x"))), lambda s: s["x"])
    vectors = full.groupBy(*CELL).agg(ordered.alias("a"))
    width = vectors.agg(F.max(F.size("a"))).first()[0]
    if width is None:
        return vectors.select(*CELL, F.col("a").alias("pcs"))
    vectors = vectors.select(*CELL, array_to_vector("a").alias("v"))
    model = PCA(k=min(n_pc, width), inputCol="v", outputCol="p").fit(vectors)
    return model.transform(vectors).select(*CELL, vector_to_array("p").alias("pcs"))


def cluster_kmeans(pcs: DataFrame, k: int = 10, seed: int = 0) -> DataFrame:
    vectors = pcs.select(*CELL, "pcs", array_to_vector("pcs").alias("features"))
    return KMeans(k=k, seed=seed).fit(vectors).transform(vectors).select(*CELL, F.col("prediction").alias("cluster"), "pcs")


def graph_communities(neighbours: DataFrame, resolution: float = 1.0) -> tuple[DataFrame, Communities]:
    """(node, cell) and the communities of the weighted neighbour graph."""
    nodes, edges = numbered_graph(Saved(neighbours.sparkSession)(fuzzy_graph(neighbours)))
    return nodes, modularity_communities(edges, resolution)


def cluster_graph(neighbours: DataFrame, resolution: float = 1.0) -> DataFrame:
    """sampleID, CB, cluster: communities by modularity, numbered from 0 by size and then by their first cell.

    A higher resolution gives more clusters. Only names of communities, not cells, are numbered together.
    """
    nodes, found = graph_communities(neighbours, resolution)
    own = Saved(neighbours.sparkSession)(nodes.join(found.labels, "node").select("cell", "community"))
    order = own.groupBy("community").agg(F.count("*").alias("n"), F.min("cell").alias("first"))
    number = order.select("community", (F.row_number().over(W.orderBy(F.desc("n"), "first")) - 1).alias("cluster"))  # a row for each community
    return own.join(number, "community").select("cell.*", F.col("cluster").cast("string").alias("cluster"))


def cluster_labels(neighbours: DataFrame, rounds: int = 10) -> DataFrame:
    """sampleID, CB, cluster: label propagation over the neighbour graph; the most frequent label, then the smallest."""
    saved = Saved(neighbours.sparkSession)
    one = neighbours.select(F.struct(*CELL).alias("cell"), "neighbour")
    edges = saved(one.unionByName(one.select(F.col("neighbour").alias("cell"), F.col("cell").alias("neighbour"))).distinct())
    labels = edges.select("cell").distinct().withColumn("cluster", F.concat_ws(":", "cell.sampleID", "cell.CB"))
    for _ in range(rounds):
        votes = edges.join(labels.withColumnRenamed("cell", "neighbour"), "neighbour").groupBy("cell", "cluster").agg(F.count("*").alias("n"))
        new = saved(votes.groupBy("cell").agg(F.min_by("cluster", F.struct(-F.col("n"), F.col("cluster"))).alias("cluster")))
        same = new.join(labels.withColumnRenamed("cluster", "old"), "cell").filter("cluster != old").isEmpty()
        labels = new
        if same:
            break
    return labels.select("cell.*", "cluster")


def cluster_cells(
    m: DataFrame, normalization: str = "log1p", n_top: int = 2000, n_pc: int = 30, n_neighbours: int = 15, method: str = "leiden", resolution: float = 1.0, n_clusters: int = 10
) -> DataFrame:
    """Barcode, Cluster, UMAP_1 and UMAP_2 of each cell of a count matrix, cells of all samples in one space.

    ``method`` is leiden or louvain (both communities by modularity) or kmeans. Residuals of ``pearson`` are taken as zero where
    a gene lacks counts; those of the non-zeros, less what a zero would have, stand for them.
    """
    saved = Saved(m.sparkSession)
    if normalization == "pearson":
        x = pearson_parts(m)[0].select(*KEYS, (F.col("x") - F.col("zero")).alias("x"))
    else:
        x = {"log1p": normalize_log1p, "sqrt": normalize_sqrt}[normalization](m)
    x = saved(x)
    pcs = saved(pca_sparse(x, highly_variable_genes(x, n_top), n_pc)[0])
    near = saved(knn_cells(pcs, n_neighbours))
    clusters = cluster_kmeans(pcs, n_clusters) if method == "kmeans" else cluster_graph(near, resolution)
    return cluster_table(clusters.select(*CELL, "cluster"), embed_cells(near))


def cluster_table(clusters: DataFrame, coordinates: DataFrame | None = None) -> DataFrame:
    """sampleID, Barcode, Cluster and two coordinates: those given, or the first two components."""
    if coordinates is not None:
        own = clusters.join(coordinates, CELL, "left").na.fill(0.0, ["UMAP_1", "UMAP_2"])
        return own.select("sampleID", F.col("CB").alias("Barcode"), F.col("cluster").cast("string").alias("Cluster"), "UMAP_1", "UMAP_2")
    pcs = (F.col("pcs")[i].alias(f"PC{i + 1}") for i in (0, 1))
    return clusters.select("sampleID", F.col("CB").alias("Barcode"), F.col("cluster").alias("Cluster"), *pcs)
