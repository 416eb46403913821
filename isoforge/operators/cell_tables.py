"""Gene, junction-chain and junction-variation tables by cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.operators.explode import KEY, ROW


def _annotated() -> Column:
    return F.when(C.starts_novel("associated_gene"), 0).otherwise(1)


def gene_counts_by_cell(cells: DataFrame) -> DataFrame:
    """Rows of each gene and cell by category; without a ``jxnHash`` column isoforms count as chains."""
    own = cells.filter(F.col("associated_gene").isNotNull())
    by = {c: F.count(F.when(F.col("structural_category") == c, 1)).alias(c) for c in C.CATEGORIES}
    chain = "jxnHash" if "jxnHash" in cells.columns else "isoform"
    out = own.groupBy("sampleID", "associated_gene", "CB").agg(
        *by.values(), F.count("*").alias("total_read_count"), F.countDistinct(chain).alias("unique_jxnHash_counts"), F.count("structural_category").alias("__known")
    )
    return out.filter("__known > 0").drop("__known").withColumn("flag_annotated_gene", _annotated())


def majority_value(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The most frequent value of ``column`` for each key; of equally frequent ones the smallest."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(column), F.struct(-F.col("n"), F.col(column))).alias(column))


def junction_counts_by_chain(cells: DataFrame, junctions: DataFrame, placed: bool = False) -> DataFrame:
    """Junctions of each type for each sample's chains, over all cells and reads; a read's are counted before they are joined. ``placed``: rows lie by their names."""
    chain = cells.select(*ROW, "jxnHash").filter("jxnHash IS NOT NULL AND jxnHash != ''")
    chain = (chain if placed else chain.repartition(*ROW)).distinct()  # one shuffle for both, by row
    kind = junctions.select(*ROW, C.junction_type().alias("type"))
    counts = kind.groupBy(*ROW).agg(*(F.count(F.when(F.col("type") == t, 1)).alias(t) for t in C.JUNCTION_TYPES))
    return counts.join(chain, ROW).groupBy("sampleID", "jxnHash").agg(*(F.sum(t).alias(t) for t in C.JUNCTION_TYPES))


def ujc_counts_by_cell(cells: DataFrame, junctions: DataFrame, placed: bool = False, by_row: DataFrame | None = None) -> DataFrame:
    """Chains of each cell: multi-exon ones with the gene and category of most rows, mono-exon ones by gene and category.

    One aggregate by chain, cell, gene and category serves both; the majorities are taken of its rows, and the top chains of a gene
    before junctions are joined, so that rows are shuffled by cell once. ``placed``: a cell's rows lie in one partition; ``by_row``
    may hold the same rows so that they join the junctions without a shuffle.
    """
    keys, values = ["sampleID", "jxnHash", "CB"], ["associated_gene", "structural_category"]
    own = cells.filter("jxnHash IS NOT NULL AND exons IS NOT NULL").select(*keys, *values, C.multi_exon().alias("multi"))
    own = (own if placed else own.repartition(*KEY)).groupBy(*keys, *values, "multi").agg(F.count("*").alias("read_count"))
    own = own.filter("multi OR (associated_gene IS NOT NULL AND structural_category IS NOT NULL)")
    own = own.withColumns({f"__{v}": F.sum("read_count").over(W.partitionBy(*keys, "multi", v)) for v in values})
    majority = [F.min_by(v, F.when(F.col(v).isNotNull(), F.struct(-F.col(f"__{v}"), F.col(v)))).alias(v) for v in values]
    mono = [F.when(~F.col("multi"), F.col(v)).alias(f"__mono{i}") for i, v in enumerate(values)]  # a group for each of their rows
    both = own.groupBy(*keys, "multi", *mono).agg(F.sum("read_count").alias("read_count"), *majority)
    top = F.max("read_count").over(W.partitionBy("sampleID", "associated_gene", "CB"))
    flag = F.when(F.col("associated_gene").isNotNull(), (F.col("read_count") == top).cast("int"))
    chains = junction_counts_by_chain(cells, junctions) if by_row is None else junction_counts_by_chain(by_row, junctions, True)
    out = both.withColumn("flag_MEI", flag).join(chains, ["sampleID", "jxnHash"], "left")
    counts = (F.when(F.col("multi"), F.coalesce(t, F.lit(0))).otherwise(0).alias(t) for t in C.JUNCTION_TYPES)
    return out.select(*keys, "read_count", *values, *counts, "flag_MEI", _annotated().alias("flag_annotated_gene"))


_SIDES = {"start": "+", "end": "-"}


def _end(side: str, donor: str) -> Column:
    return F.struct(F.lit(donor).alias("donor"), F.col(f"{side}_coord").alias("coord"), F.abs(f"{side}_difference").cast("double").alias("d"))


def junction_cv_by_cell(cells: DataFrame, junctions: DataFrame) -> DataFrame:
    """Variation of both junction ends around each reference site in each cell: one join, each row for both its ends.

    A site of a cell has few rows, so that sums before the shuffle save nothing: junctions are shuffled by cell, chromosome and
    strand before they become two ends, and one sort by site then serves all measures; of a site's rows the first is kept.
    """
    difference = {s: F.col(f"diff_to_Ref_{s}_site") for s in _SIDES}
    places = [x for s, d in difference.items() for x in ((F.col(f"genomic_{s}_coord") + d).cast("long").alias(f"{s}_coord"), d.alias(f"{s}_difference"))]
    own = junctions.filter(" AND ".join(f"diff_to_Ref_{s}_site IS NOT NULL" for s in _SIDES)).select(*ROW, "chrom", "strand", *places)
    own = own.join(cells.select(*ROW, "associated_gene", "CB"), ROW).drop("isoform")
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # not lowered by rows' sizes, since time goes by sites
    own = own.repartition(tasks, *KEY, "chrom", "strand")
    ends = own.select(*KEY, "chrom", "strand", "associated_gene", F.inline(F.array(*(_end(s, donor) for s, donor in _SIDES.items()))))
    by = W.partitionBy("coord", "CB", "chrom", "sampleID", "strand", "donor").orderBy("d")  # the most telling first, since rows are sorted so
    site = by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = ends.withColumns({
        "mean_abs_diff": F.avg("d").over(site), "std_abs_diff": F.stddev_samp("d").over(site), "__pop": F.stddev_pop("d").over(site),
        "count": F.count("*").over(site), "genes": F.array_sort(F.collect_set("associated_gene").over(site)), "__first": F.row_number().over(by),
    }).filter("__first = 1")
    mean, genes, pop = F.col("mean_abs_diff"), F.col("genes"), F.col("__pop")
    known = (F.size(genes) > 0) & F.forall(genes, lambda g: ~g.startswith("novel"))
    return out.select(
        "sampleID", "chrom", "strand", "coord", "mean_abs_diff", "std_abs_diff", F.when(mean != 0, pop / mean).alias("cv"), "count",
        F.array_join(genes, "|").alias("associated_gene"), F.size(genes).alias("gene_count"),
        (F.size(genes) > 1).cast("int").alias("flag_multi_gene"), known.cast("int").alias("flag_annotated_gene"),
        (F.col("strand") == F.col("donor")).cast("int").alias("flag_donor"), (F.col("strand") != F.col("donor")).cast("int").alias("flag_acceptor"),
        (mean == 0).cast("int").alias("flag_mean_0"), F.coalesce((F.col("std_abs_diff") == 0).cast("int"), F.lit(0)).alias("flag_std_0"),
        (mean == 0).cast("int").alias("flag_ref_match"), ((mean != 0) & (pop == 0)).cast("int").alias("flag_cv_0"),
        ((mean != 0) & (pop > 0)).cast("int").alias("flag_cv_gt_0"), "CB",
    )
