"""Cells, molecules and junction chains for classification and junction rows, sample by sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.operators.explode import ROW


def annotate_cells_reads(cls: DataFrame, assoc: DataFrame) -> DataFrame:
    """CB and UMI by read; a ``_dupN`` row takes its primary's when the primary is in the association.

    ``assoc`` has a row for each sampleID and isoform at most. Rows are joined once, by their primary's name: a duplicate's entry is
    looked for beside its primary's, and left out where that is there.
    """
    names = F.explode(F.array_compact(F.array("isoform", C.dup_primary())))
    entry = assoc.select("sampleID", names.alias("__look"), F.col("isoform").alias("__name"), "CB", "UMI")
    is_primary = F.col("__name") == F.col("__look")
    primary_there = F.max(is_primary).over(W.partitionBy("sampleID", "__look"))
    entry = entry.withColumn("__there", primary_there).filter(is_primary | ~F.col("__there")).drop("__there")
    out = cls.drop("CB", "UMI").withColumn("__look", F.coalesce(C.dup_primary(), F.col("isoform"))).alias("c")
    same = ["c.sampleID = e.sampleID", "c.__look = e.__look", "(e.__name = e.__look OR e.__name = c.isoform)"]
    return out.join(entry.alias("e"), F.expr(" AND ".join(same)), "left").select("c.*", "e.CB", "e.UMI").drop("__look")


def annotate_cells_isoforms(cls: DataFrame, assoc: DataFrame | None = None, abundance: DataFrame | None = None) -> DataFrame:
    """A row for each isoform and valid cell, and one without a cell for an isoform that has none.

    Samples have counts in ``abundance`` or lists of barcodes in ``assoc``, which are trimmed and weigh 1 each; a
    sample that is in both gets the cells of both.
    """
    counts = None
    if abundance is not None:
        counts = abundance.select(*ROW, F.trim("CB").alias("CB"), F.col("count").cast("double").alias("_count"))
    if assoc is not None:
        lists = assoc.select(*ROW, F.explode(F.split("CB", ",")).alias("CB")).select(*ROW, F.trim("CB").alias("CB"), F.lit(1.0).alias("_count"))
        counts = lists if counts is None else counts.unionByName(lists)
    return cls.drop("CB", "FL", "_count").join(counts.filter(C.valid_cell()), ROW, "left")


def annotate_junction_cells(junctions: DataFrame, assoc: DataFrame) -> DataFrame:
    """CB by read or isoform; ``_dupN`` rows have no rule of their own here."""
    return junctions.drop("CB").join(assoc.select(*ROW, "CB"), ROW, "left")


def junction_cells_fallback(junctions: DataFrame, cls: DataFrame) -> DataFrame:
    """Cells of junctions from their isoforms' classification rows."""
    return junctions.drop("CB").join(cls.select(*ROW, "CB").distinct(), ROW, "left")


def junction_weights(junctions: DataFrame, cls: DataFrame, column: str = "_weight") -> DataFrame:
    """Each junction's weight: its isoform's sum of ``FL``, 1 if that is unknown or the isoform is."""
    weights = cls.groupBy(*ROW).agg(F.max(C.isoform_weight("FL")).alias(column))
    return junctions.join(weights, ROW, "left").withColumn(column, F.coalesce(column, F.lit(1.0)))


def row_weights(cells: DataFrame, column: str = "_weight") -> DataFrame:
    """Rows with the weight of their isoform's junctions, as ``junction_weights`` gives it."""
    return cells.withColumn(column, F.coalesce(F.max(C.isoform_weight("FL")).over(W.partitionBy(*ROW)), F.lit(1.0)))


def attach_ujc(cls: DataFrame, ujc: DataFrame) -> DataFrame:
    """Junction chain and hash by isoform; mono-exon rows get a chain of their transcript."""
    own = cls.drop("jxn_string", "jxnHash").join(ujc.select(*ROW, "jxn_string"), ROW, "left")
    mono = F.concat_ws("_", C.format_chr("chrom"), "strand", F.lit("monoexon"), F.coalesce("associated_transcript", F.lit("NA")))
    own = own.withColumn("jxn_string", F.when(F.col("exons") == 1, mono).otherwise(F.col("jxn_string")))
    return own.withColumn("jxnHash", C.ujc_hash("jxn_string"))


def ujc_from_gtf(exons: DataFrame) -> DataFrame:
    """sampleID, isoform, jxn_string: introns between consecutive exons, in order, of transcripts with several."""
    keys = ["sampleID", "transcript_id", "chrom", "strand"]
    following = F.lead("start").over(W.partitionBy(*keys).orderBy("start", "end"))
    introns = exons.withColumn("next", following).filter("next IS NOT NULL")
    pairs = F.array_sort(F.collect_list(F.struct((F.col("end") + 1).alias("a"), (F.col("next") - 1).alias("b"))))
    chain = F.array_join(F.transform("i", lambda x: F.concat_ws("_", x["a"].cast("string"), x["b"].cast("string"))), "_")
    ordered = introns.groupBy(*keys).agg(pairs.alias("i"))
    return ordered.select("sampleID", F.col("transcript_id").alias("isoform"), F.concat_ws("_", C.format_chr("chrom"), "strand", chain).alias("jxn_string"))
