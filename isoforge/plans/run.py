"""A run from files: readers, enrichment, per-cell tables, clusters, cohort and sinks, all samples in one job.

Each input is scanned once. Enriched rows and junctions with their cells are written as bucketed tables, by row
name and by cell; everything after reads these, and its joins and groups by the same keys need no shuffle.
The passes that write them count what is left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isoforge.functions.columns import valid_cell
from isoforge.operators import cell_tables as T
from isoforge.operators import clustering as K
from isoforge.operators import cohort as H
from isoforge.operators import enrich as E
from isoforge.operators.cell_summary import cell_summary, long_form
from isoforge.operators.explode import KEY, ROW, explode_junction_cells
from isoforge.operators.matrix import count_matrix
from isoforge.plans.tables import Buckets
from isoforge.sources import sinks, text
from isoforge.sources.shared import Saved


@dataclass
class Inputs:
    """Enriched rows, one for each cell, and junctions with their cells; ``watches`` hold what the passes that read them counted."""

    rows: DataFrame
    junctions: DataFrame
    watches: dict[str, Observation] = field(default_factory=dict)

    def counts(self) -> list[tuple[str, str, int]]:
        return [(what, name, n) for what, w in self.watches.items() for name, n in w.get.items()]


def enriched(spark: SparkSession, manifest: DataFrame, mode: str = "reads", gtf=None) -> Inputs:
    """Classification and junction rows of all samples of a manifest, with their cells (and chains from ``gtf`` files)."""
    files = manifest.select("sampleID", "classification_file", "junction_file", "cell_association", "abundance").collect()  # a row for each sample
    watches = {n: Observation(f"{n}-{id(manifest)}") for n in ("classification", "junctions")}
    cls = text.read_classification(spark, [r["classification_file"] for r in files], manifest, watches["classification"])
    junctions = text.read_junctions(spark, [r["junction_file"] for r in files], manifest, watches["junctions"])
    if mode == "reads":
        assoc = text.read_cell_association_reads(spark, list(dict.fromkeys(r["cell_association"] for r in files)), manifest)
        cls = E.annotate_cells_reads(cls, assoc).withColumn("_count", F.lit(1.0))
    else:
        matrices = {r["sampleID"]: r["abundance"] for r in files if r["abundance"]}
        lists = list(dict.fromkeys(r["cell_association"] for r in files if not r["abundance"] and r["cell_association"]))
        abundance = None
        if matrices:
            watches["abundance"] = Observation(f"abundance-{id(manifest)}")
            abundance = text.read_mex(spark, matrices, watch=watches["abundance"])
        cells = text.read_cell_association_isoforms(spark, lists, manifest.filter("abundance = ''")) if lists else None
        cls = E.annotate_cells_isoforms(cls, cells, abundance)
        assoc = None
    if gtf:
        cls = E.attach_ujc(cls, E.ujc_from_gtf(text.read_gtf(spark, gtf)))
    watches["barcodes"] = Observation(f"barcodes-{id(manifest)}")
    cls = text.counted(cls, watches["barcodes"], without_cell=F.col("CB").isNull(), invalid_cell=F.col("CB").isNotNull() & ~valid_cell())
    return Inputs(cls, junctions if assoc is None else explode_junction_cells(E.annotate_junction_cells(junctions, assoc)), watches)


def corrected_gtf(spark: SparkSession, manifest: DataFrame) -> list[str]:
    """The samples' corrected transcripts that lie beside their classification, as far as there are any."""
    own = manifest.select(F.regexp_replace("classification_file", "_classification.txt$", "_corrected.gtf").alias("g")).collect()  # a row for each sample
    return [f for r in own for f in text._glob(spark, r["g"]) if f.endswith(".gtf")]


def cohort_tables(summary: DataFrame) -> dict[str, DataFrame]:
    """Statistics over the samples of a summary; with two samples or more also components of their medians."""
    saved = Saved(summary.sparkSession)
    long = saved(long_form(summary))
    out = {"cohort_stats": H.cohort_stats(summary), "cohort_categories": H.category_means(summary)}
    medians = saved(H.cohort_medians(long))
    vary = saved(H.drop_constant_features(medians))
    if summary.select("sampleID").distinct().count() > 1 and not vary.isEmpty():
        scores, loadings, shares = H.cohort_pca(vary)
        top = H.top_loadings(loadings)
        out |= {"cohort_scores": scores, "cohort_loadings": top, "cohort_shares": shares, "cohort_features": H.feature_distribution(long, H.first_components(top))}
    return out | {"cohort_medians": medians}


def run_qc(
    spark: SparkSession, manifest_path: str, out_dir: str, mode: str = "reads", input_dir: str | None = None, data_dir: str | None = None, gtf=None,
    clustering: dict | None = None, cohort: bool = False, buckets: int | None = None, **options,
) -> DataFrame:
    """Write the enriched rows, the summary and the per-cell tables below ``out_dir``; returns the summary as written.

    ``run_counts`` says how many rows each input had and how many were left out: short lines, matrix entries out of range,
    rows without a cell or with an invalid one. ``clustering`` holds options of ``cluster_cells``; ``cohort`` adds tables over samples.
    Without ``gtf``, corrected transcripts beside the classifications are taken, if there are any, in reads mode.
    """
    manifest = text.read_manifest(spark, manifest_path, mode, input_dir, data_dir)
    gtf = gtf if gtf is not None else corrected_gtf(spark, manifest) if mode == "reads" else None
    made, keep = enriched(spark, manifest, mode, gtf), Buckets(spark, buckets)
    try:
        rows = keep(made.rows, "rows", ROW)
        valid = rows.filter(valid_cell())
        cells = keep(valid, "cells", KEY)
        junctions = made.junctions
        if mode != "reads":  # an isoform's junctions lie in each of its cells
            junctions = keep(junctions, "own_junctions", ROW).drop("CB").join(valid.select(*ROW, "CB").distinct(), ROW, "left")
        junctions = keep(junctions, "junctions", ROW)
        sinks.write_enriched_classification(rows, f"{out_dir}/classification")
        sinks.write_enriched_classification(junctions, f"{out_dir}/junctions")
        summary = Saved(spark)(cell_summary(cells, junctions, mode, placed=True, **options))
        sinks.write_cell_summary(summary, f"{out_dir}/cell_summary")
        sinks.write_table_csv(T.gene_counts_by_cell(cells), f"{out_dir}/gene_counts")
        sinks.write_table_csv(T.ujc_counts_by_cell(cells, junctions, placed=True, by_row=valid), f"{out_dir}/ujc_counts")
        sinks.write_table_csv(T.junction_cv_by_cell(valid, junctions), f"{out_dir}/junction_cv")
        sinks.write_table_csv(spark.createDataFrame(made.counts(), "input string, what string, n long"), f"{out_dir}/run_counts")
        if clustering is not None:
            sinks.write_table_csv(K.cluster_cells(count_matrix(cells), **clustering), f"{out_dir}/clustering")
        if cohort:
            for name, df in cohort_tables(summary).items():
                sinks.write_table_csv(df, f"{out_dir}/{name}")
        return summary
    finally:
        keep.drop()
