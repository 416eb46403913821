"""Tables behind the report's figures: bulk counts, shares within cells, and statistics over cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.operators.cell_summary import chains
from isoforge.operators.explode import KEY, ROW
from isoforge.sources.shared import Saved


def share_within(df: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    """``percent``: 100 x value over its sum in the group."""
    return df.withColumn("percent", C.safe_prop(F.col(value), F.sum(value).over(W.partitionBy(*keys))))


def complete(df: DataFrame, keys: list[str], column: str, levels, fill: dict) -> DataFrame:
    """A row for each key and level; those that were missing are filled."""
    grid = df.select(*keys).distinct().withColumn(column, F.explode(F.array(*map(F.lit, levels))))
    return grid.join(df, [*keys, column], "left").na.fill(fill)


def bulk_totals(cells: DataFrame, mode: str = "reads") -> DataFrame:
    """Weighted rows, distinct genes, and distinct chains (0 in isoforms mode)."""
    chain = F.countDistinct(F.when(C.multi_exon(), F.col("jxn_string"))) if mode == "reads" else F.lit(0).cast("long")
    return cells.agg(F.sum("_count").alias("rows"), F.countDistinct("associated_gene").alias("genes"), chain.alias("ujcs"))


def bulk_gene_classes(cells: DataFrame) -> DataFrame:
    genes = cells.filter("associated_gene IS NOT NULL").select("associated_gene").distinct()
    kind = F.when(C.starts_novel("associated_gene"), "novel").otherwise("annotated")
    return share_within(genes.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")), []).withColumn("percent", F.round("percent", 1))


def bulk_category_table(cells: DataFrame) -> DataFrame:
    """Weighted rows of each category that has any, and their percent of all rows with a known category."""
    own = cells.filter(F.col("structural_category").isin(*C.CATEGORIES)).groupBy("structural_category").agg(F.sum("_count").alias("n"))
    return share_within(own.filter("n > 0"), []).withColumn("percent", F.round("percent", 1))


def bulk_category_levels(cells: DataFrame) -> DataFrame:
    """The nine categories with their weighted rows, 0 where there are none."""
    levels = cells.sparkSession.createDataFrame([(c,) for c in C.CATEGORIES], "structural_category string")
    return levels.join(bulk_category_table(cells).select("structural_category", "n"), "structural_category", "left").na.fill(0.0, ["n"])


def _junctions(weight: str | None) -> Column:
    """Number of junctions, or the sum of their weights."""
    return F.count("*") if weight is None else F.sum(F.col(weight).cast("double"))


def bulk_junction_table(junctions: DataFrame, weight: str | None = None) -> DataFrame:
    """Junctions by type, or their weights (isoforms mode), and percents."""
    own = junctions.groupBy(C.junction_type().alias("junction_type")).agg(_junctions(weight).alias("n")).filter(F.col("junction_type").isin(*C.JUNCTION_TYPES))
    return share_within(own, []).withColumn("percent", F.round("percent", 2))


def describe_cells(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """mean, median, min, max and sample deviation of each metric, to 3 places."""
    stats = {
        "mean": F.avg("value"), "median": F.percentile("value", F.lit(0.5)), "min": F.min("value"), "max": F.max("value"), "sd": F.stddev_samp("value"),
    }
    own = long.groupBy(*(keys or []), "metric").agg(*(c.alias(n) for n, c in stats.items()))
    return own.select(*(F.round(c, 3).alias(c) if t == "double" else F.col(c) for c, t in own.dtypes))


def distribution_stats(long: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Quartiles, mean and number of values."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    own = long.groupBy(*keys).agg(q.alias("q"), F.avg(value).alias("mean"), F.count(value).alias("n"))
    return own.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "mean", "n")


def junction_type_percents(junctions: DataFrame, weight: str | None = None) -> DataFrame:
    """Percent of each junction type in each cell, by junctions or by their weights."""
    own = junctions.filter(C.valid_cell()).groupBy(*KEY, C.junction_type().alias("metric")).agg(_junctions(weight).alias("n"))
    full = complete(own, KEY, "metric", C.JUNCTION_TYPES, {"n": 0})
    return share_within(full, KEY).withColumnRenamed("percent", "value")


def gene_annotation_percent(summary: DataFrame) -> DataFrame:
    """Percent of each cell's genes that are annotated, and that are novel."""
    both = {f"{k}_genes_perc": C.safe_prop(F.col(f"{k}_genes"), F.col("Genes_in_cell")) for k in ("Annotated", "Novel")}
    return summary.select(*KEY, *(c.alias(n) for n, c in both.items()))


def reads_by_gene_annotation(cells: DataFrame) -> DataFrame:
    novel = F.col("associated_gene").isNotNull() & C.starts_novel("associated_gene")
    known = F.col("associated_gene").isNotNull() & ~C.starts_novel("associated_gene")
    total = F.sum("_count")
    part = lambda t: F.sum(F.when(t, F.col("_count")).otherwise(0.0))
    return cells.groupBy(*KEY).agg(C.safe_prop(part(known), total).alias("annotated_percent"), C.safe_prop(part(novel), total).alias("novel_percent"))


def _gene_bins(cells: DataFrame) -> DataFrame:
    """kind and bin of each cell's genes, by rows."""
    kind = F.when(C.starts_novel("associated_gene"), "novel").otherwise("annotated")
    own = cells.filter(F.col("associated_gene").isNotNull()).groupBy(*KEY, "associated_gene").agg(F.count("*").alias("rows"))
    return own.select(*KEY, kind.alias("kind"), C.report_gene_bin(F.col("rows")).alias("bin")).filter("bin IS NOT NULL")


def gene_bins_report(cells: DataFrame) -> DataFrame:
    """Share of each cell's annotated, and of its novel, genes in each bin of rows."""
    own = _gene_bins(cells).groupBy(*KEY, "kind", "bin").agg(F.count("*").alias("n"))
    return share_within(complete(own, [*KEY, "kind"], "bin", [b[0] for b in C.REPORT_GENE_BINS], {"n": 0}), [*KEY, "kind"])


def gene_bins_combined(cells: DataFrame, mode: str = "reads") -> DataFrame:
    """Share of each cell's genes in each bin of rows: of annotated ones in reads mode, of all in isoforms mode."""
    own = _gene_bins(cells)
    own = (own.filter("kind = 'annotated'") if mode == "reads" else own).groupBy(*KEY, "bin").agg(F.count("*").alias("n"))
    return share_within(complete(own, KEY, "bin", [b[0] for b in C.REPORT_GENE_BINS], {"n": 0}), KEY)


def ujc_bins_report(cells: DataFrame) -> DataFrame:
    per_gene = chains(cells).filter(F.col("associated_gene").isNotNull() & ~C.starts_novel("associated_gene")).groupBy(*KEY, "associated_gene").agg(F.count("jxn_string").alias("c"))
    own = per_gene.groupBy(*KEY, C.ujc_count_bin(F.col("c")).alias("bin")).agg(F.count("*").alias("n")).filter("bin IS NOT NULL")
    return share_within(complete(own, KEY, "bin", [b[0] for b in C.UJC_BINS], {"n": 0}), KEY)


def median_exons(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*KEY, "structural_category").agg(F.percentile("exons", F.lit(0.5)).alias("median_exons"))


def mono_exon_percent(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*KEY, "structural_category").agg(C.safe_prop(F.count(F.when(F.col("exons") == 1, 1)), F.count("*")).alias("percent"))


def exon_bin_percent(cells: DataFrame) -> DataFrame:
    own = cells.groupBy(*KEY, "structural_category", C.exon_bin().alias("bin")).agg(F.count("*").alias("n"))
    return share_within(complete(own, [*KEY, "structural_category"], "bin", ("1", "2-3", "4-5", ">=6"), {"n": 0}), [*KEY, "structural_category"])


def exon_profile(cells: DataFrame, most: int = 20, least_rows: int = 5) -> DataFrame:
    """Share of each exon count (capped) over cells with enough rows of the category, or all cells if none has."""
    keys = [*KEY, "structural_category"]
    capped = F.least(F.col("exons"), F.lit(float(most))).cast("int")
    own = cells.filter("exons IS NOT NULL").groupBy(*keys, capped.alias("exons")).agg(F.count("*").alias("n"))
    own = own.withColumn("rows", F.sum("n").over(W.partitionBy(*keys)))
    enough = own.groupBy("structural_category").agg((F.max("rows") >= least_rows).alias("any"))  # a row for each category
    own = own.join(F.broadcast(enough), "structural_category").filter(~F.col("any") | (F.col("rows") >= least_rows)).drop("rows", "any")
    full = share_within(complete(own, keys, "exons", range(1, most + 1), {"n": 0}), keys)
    return distribution_stats(full, ["structural_category", "exons"], "percent")


def junction_type_by_category(cells: DataFrame, junctions: DataFrame, weight: str | None = None) -> DataFrame:
    """Percent of each junction type in each cell and category, by junctions or by their weights; joined by isoform and cell.

    ``weight`` is a column of ``junctions``, or one of ``cells`` that all junctions of a row have. A row's junctions are one
    row with a number for each type before they are joined.
    """
    own, keys, of_row = [*ROW, "CB"], [*KEY, "structural_category"], weight is not None and weight not in junctions.columns
    named = cells.filter("structural_category IS NOT NULL").select(*own, "structural_category", *([F.col(weight).cast("double").alias("__w")] if of_row else []))
    each = F.lit(1) if weight is None or of_row else F.col(weight).cast("double")
    typed = junctions.filter(C.valid_cell()).withColumn("junction_type", C.junction_type())
    counted = typed.groupBy(*own).agg(*(F.sum(F.when(F.col("junction_type") == t, each)).alias(t) for t in C.JUNCTION_TYPES)).join(named, own)
    sums = counted.groupBy(*keys).agg(*(F.sum(F.col(t) * F.col("__w") if of_row else F.col(t)).alias(t) for t in C.JUNCTION_TYPES))
    rows = F.inline(F.array(*(F.struct(F.lit(t).alias("junction_type"), F.col(t).alias("n")) for t in C.JUNCTION_TYPES)))
    return share_within(sums.select(*keys, rows).na.fill(0, ["n"]), keys)


def label_of(junctions: DataFrame) -> Column:
    """What names a junction: its label, its place by either names of the columns, its id, or else each row itself."""
    there = set(junctions.columns)
    if "junctionLabel" in there:
        return F.col("junctionLabel")
    for start, end in (("genomic_start_coord", "genomic_end_coord"), ("genomic_start", "genomic_end")):
        if {"chrom", "strand", start, end} <= there:
            return C.junction_label(start, end)
    return F.col("junction_id").cast("string") if "junction_id" in there else F.monotonically_increasing_id().cast("string")


def rts_by_junction_type(junctions: DataFrame, unique: bool = False) -> DataFrame:
    """Share of junctions with RTS in each cell and type; of distinct ones if ``unique`` (any RTS counts)."""
    own = junctions.filter(C.valid_cell())
    own = own.select(*KEY, C.junction_type().alias("junction_type"), label_of(junctions).alias("label"), C.rts_bool("RTS_junction").alias("rts"))
    if unique:
        own = own.groupBy(*KEY, "junction_type", "label").agg(F.bool_or("rts").alias("rts"))
    return own.groupBy(*KEY, "junction_type").agg(C.safe_prop(F.count(F.when(F.col("rts"), 1)), F.count("*")).alias("percent"))


def all_canonical_by_category(cells: DataFrame) -> DataFrame:
    status = C.all_canonical_status("all_canonical").cast("string")
    own = cells.withColumn("status", status).filter("status IS NOT NULL").groupBy(*KEY, "structural_category", "status").agg(F.count("*").alias("n"))
    return share_within(complete(own, [*KEY, "structural_category"], "status", ("true", "false"), {"n": 0}), [*KEY, "structural_category"])


def feature_panel(long: DataFrame, suffix: str) -> DataFrame:
    """Rows of the metrics with ``suffix`` that are not 0 in every cell; they are saved, so that they are computed once."""
    own = Saved(long.sparkSession)(long.filter(F.col("metric").endswith(suffix)))
    there = own.groupBy("metric").agg(F.max(F.abs("value")).alias("m")).filter("m > 0").select("metric")
    return own.join(F.broadcast(there), "metric", "left_semi")


#: Ends of the names of the metrics that share a panel: fixed values.
PANELS = (
    "_prop_in_cell", "_ref_coverage_prop", "_RTS_prop", "_intrapriming_prop", "_TSSAnnotationSupport", "_CAGE_peak_support_prop", "_PolyA_motif_support_prop",
    "_srjunctions_support_prop", "_TSS_ratio_validated_prop", "_noncanon_prop", "_canon_prop", "_coding_prop", "_non_coding_prop", "_NMD_prop",
    "_length_prop", "_length_mono_prop", "_junctions_prop", "_perc", "_prop",
)


def feature_panels(long: DataFrame, suffixes: tuple[str, ...] = PANELS) -> DataFrame:
    """``panel``, the longest suffix that ends a metric's name, beside the rows of all metrics that have one and are not 0 in every cell."""
    order = sorted(suffixes, key=lambda s: (-len(s), s))
    panel = F.coalesce(*(F.when(F.col("metric").endswith(s), F.lit(s)) for s in order))
    there = long.groupBy("metric").agg(F.max(F.abs("value")).alias("m")).filter("m > 0").select("metric", panel.alias("panel")).filter("panel IS NOT NULL")
    return long.join(F.broadcast(there), "metric")  # a row for each metric of the summary


def cluster_profile(long: DataFrame, clusters: DataFrame) -> DataFrame:
    """Distribution of each metric in each cluster of cells."""
    return distribution_stats(long.join(clusters.select(*KEY, "cluster"), KEY), ["cluster", "metric"])
