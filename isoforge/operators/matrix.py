"""Isoform-by-cell counts, long, sample by sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.functions.columns import read_type_filter
from isoforge.operators.explode import KEY


def count_matrix(cells: DataFrame) -> DataFrame:
    """Weighted rows by cell and gene."""
    return cells.filter(F.col("associated_gene").isNotNull()).groupBy(*KEY, "associated_gene").agg(F.sum("_count").alias("count"))


def isoform_cell_counts(reads: DataFrame, groups: DataFrame) -> DataFrame:
    """Reads by isoform and cell: reads (sampleID, read_name, CB) of molecules (sampleID, molecule, isoform)."""
    own = groups.select("sampleID", F.col("molecule").alias("read_name"), "isoform")
    return reads.join(own, ["sampleID", "read_name"]).groupBy(*KEY, "isoform").agg(F.count("*").alias("count"))


def transcript_cell_counts(reads: DataFrame, novel: bool = False, ambiguous: bool = False) -> DataFrame:
    kept = reads.filter(read_type_filter("read_type", novel, ambiguous))
    return kept.groupBy("sampleID", F.col("barcode").alias("CB"), F.col("transcript").alias("isoform")).agg(F.count("*").alias("count"))


def transcript_features(reads: DataFrame, order: str = "__at") -> DataFrame:
    """Gene and type of each sample's transcripts, from their last reads."""
    last = F.max_by(F.struct("gene", "transcript_type"), order).alias("x")
    return reads.groupBy("sampleID", "transcript").agg(last).select("sampleID", "transcript", "x.*")


def umi_dedup(reads: DataFrame) -> DataFrame:
    """One read for each cell, gene and UMI: the best mapped, then the first by name."""
    best = W.partitionBy(*KEY, "GE", "UB").orderBy(F.desc("mapq"), "read_name")
    return reads.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n")
