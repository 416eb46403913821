"""Per-cell summary.

Weighted sums come from one narrow aggregate by cell, category and subcategory; its few rows of
each cell then become one record: a struct of totals and a map from category to a struct. Distinct
counts come from one pre-aggregate of genes, junction chains and molecules. So each table is read
once for each of the two, and the hundreds of columns are projections of one row, never aggregates.
Both shuffle rows by cell and not sums: a task sees few rows of a cell, so that its partial sums, tens of
numbers each, would be more than its rows. What a row's columns are tested for travels as the bits of one number.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.operators.explode import KEY

_BINS = tuple(C.LENGTH_BINS)


def category_sums(
    cells: DataFrame, mt_names=("MT",), ref_cov_min_pct: float = 45.0, min_cov: float = 1.0, ratio_tss: float = 2.0, placed: bool = False, only: set[str] | None = None
) -> DataFrame:
    """A record of each cell: ``total``, weighted sums of every measure, and ``by``, the same by category.

    A category's struct also has ``sub``, a map from subcategory to weight. Rows of an unknown
    category count in the totals. ``only`` names the measures to take, as ``measures_of`` some columns. ``placed``: a cell's rows lie in one partition, as in a table bucketed by cell.
    """
    measures = {
        "w": F.lit(True), "not_mono": C.not_mono(), "multi": C.multi_exon(),
        "mt": F.coalesce(F.col("chrom").isin(*mt_names), F.lit(False)), "ref_cov": C.ref_body_covered(ref_cov_min_pct),
    }
    tests = C.quality_predicates(min_cov, ratio_tss)
    measures |= tests | {f"multi_{k}": tests[k] & C.multi_exon() for k in ("canon", "noncanon")}
    mono = F.coalesce(F.col("exons") == 1, F.lit(False))
    for b in _BINS:
        measures |= {f"len_{b}": C.length_bin() == b, f"len_mono_{b}": (C.length_bin() == b) & mono}
    measures = {k: t for k, t in measures.items() if only is None or k == "w" or k in only}
    bits = sum((F.when(t, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, t in enumerate(measures.values())), F.lit(0).cast("long"))
    rows = cells.select(*KEY, "structural_category", "subcategory", "_count", bits.alias("__bits"))
    sums = [F.sum(F.when(F.col("__bits").bitwiseAND(F.lit(1 << i)) != 0, F.col("_count")).otherwise(0.0)).alias(k) for i, k in enumerate(measures)]
    fine = (rows if placed else rows.repartition(*KEY)).groupBy(*KEY, "structural_category", "subcategory").agg(*sums)
    again = [F.sum(k).alias(k) for k in measures]
    known = F.when(F.col("subcategory").isNotNull(), F.struct("subcategory", "w"))
    by_category = fine.groupBy(*KEY, "structural_category").agg(*again, F.map_from_entries(F.collect_list(known)).alias("sub"))
    one = F.struct("structural_category", F.struct(*measures, "sub"))
    named = F.when(F.col("structural_category").isNotNull(), one)
    record = by_category.groupBy(*KEY).agg(*again, F.map_from_entries(F.collect_list(named)).alias("by"))
    return record.select(*KEY, F.struct(*measures).alias("total"), "by")


# Columns of the summary are SQL texts, hundreds of which a projection takes at once.


def _of(category: str, measure: str) -> str:
    return f"coalesce(by['{category}'].{measure}, 0D)"


def _all(measure: str) -> str:
    return f"total.{measure}"


def measures_of(columns: dict[str, str]) -> set[str]:
    """The measures that some columns' texts take."""
    return {m for text in columns.values() for m in re.findall(r"(?:total|\])\.(\w+)", text)}


def safe_prop(n: str, d: str) -> str:
    """Percent, 0 without a positive denominator."""
    return f"CASE WHEN {d} > 0 THEN 100D * {n} / {d} ELSE 0D END"


def _select(record: DataFrame, columns: dict[str, str]) -> DataFrame:
    return record.selectExpr(*KEY, *(f"{text} AS `{name}`" for name, text in columns.items()))


def total_columns() -> dict[str, str]:
    return {"total_reads": _all("w"), "total_reads_no_monoexon": _all("not_mono")}


def cell_totals(cells: DataFrame, sums: DataFrame, mode: str = "reads") -> DataFrame:
    out = _select(sums, total_columns())
    if mode == "reads":
        out = out.join(cells.groupBy(*KEY).agg(F.countDistinct("UMI").alias("total_UMI")), KEY)
    return out


def category_columns() -> dict[str, str]:
    counts = {C.count_name(c): _of(c, "w") for c in C.CATEGORIES}
    return counts | {f"{k}_prop": safe_prop(v, _all("w")) for k, v in counts.items()}


def category_counts(sums: DataFrame) -> DataFrame:
    return _select(sums, category_columns())


def mt_columns() -> dict[str, str]:
    return {"MT_reads_count": _all("mt"), "MT_perc": safe_prop(_all("mt"), _all("w"))}


def mt_share(sums: DataFrame) -> DataFrame:
    return _select(sums, mt_columns())


def gene_counts(cells: DataFrame) -> DataFrame:
    """Weighted rows by cell and gene; rows without a gene are left out."""
    return cells.filter(F.col("associated_gene").isNotNull()).groupBy(*KEY, "associated_gene").agg(F.sum("_count").alias("n"))


def chains(cells: DataFrame) -> DataFrame:
    """Distinct junction chains of multi-exon rows by cell and gene."""
    own = cells.filter(C.multi_exon())
    return own.groupBy(*KEY, "associated_gene", "jxn_string").agg(F.max(~C.starts_novel("associated_transcript")).alias("annotated"))


def key_counts(cells: DataFrame, placed: bool = False) -> DataFrame:
    """Distinct genes, junction chains and molecules of each cell, and genes by the size of their counts.

    A row stands for its gene and chain and for its molecule; both are aggregated together, where the cell's rows are.
    Windows then tell the first row of each gene and of each chain.
    """
    chain = F.when(C.multi_exon(), F.col("jxn_string"))
    known = C.multi_exon() & ~C.starts_novel("associated_transcript")
    rows = cells.select(*KEY, "associated_gene", chain.alias("chain"), C.multi_exon().alias("multi"), known.alias("known"), "UMI", "_count")
    of_gene = F.struct(F.lit("g").alias("kind"), F.col("associated_gene").alias("a"), F.col("chain").alias("b"), "multi", "known", F.col("_count").alias("n"))
    of_molecule = F.struct(F.lit("u").alias("kind"), F.col("UMI").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(False).alias("multi"), F.lit(False).alias("known"), F.lit(0.0).alias("n"))
    each = (rows if placed else rows.repartition(*KEY)).select(*KEY, F.inline(F.array(of_gene, of_molecule)))
    each = each.groupBy(*KEY, "kind", "a", "b").agg(F.sum("n").alias("n"), F.max("known").alias("known"), F.max("multi").alias("multi"))
    by_a, by_b = W.partitionBy(*KEY, "kind", "a"), W.partitionBy(*KEY, "kind", "b")
    each = each.withColumns({"gene_n": F.sum("n").over(by_a), "gene_chains": F.count("b").over(by_a), "gene_multi": F.max("multi").over(by_a), "a_at": F.row_number().over(by_a.orderBy("b"))})
    each = each.withColumns({"chain_known": F.max("known").over(by_b), "b_at": F.row_number().over(by_b.orderBy("a"))})
    novel = C.starts_novel("a")
    gene = (F.col("kind") == "g") & F.col("a").isNotNull() & (F.col("a_at") == 1)
    first_chain = (F.col("kind") == "g") & F.col("b").isNotNull() & (F.col("b_at") == 1)
    molecule = (F.col("kind") == "u") & F.col("a").isNotNull() & (F.col("a_at") == 1)
    count = lambda test: F.count(F.when(test, 1))
    columns = {
        "total_UMI": count(molecule), "Genes_in_cell": count(gene), "Annotated_genes": count(gene & ~novel), "Novel_genes": count(gene & novel),
        "UJCs_in_cell": count(first_chain), "annotated_chains": count(first_chain & F.col("chain_known")),
    }
    for kind, test in (("anno", ~novel), ("novel", novel)):
        bins = C.gene_count_bin(F.col("gene_n"))
        columns |= {f"{kind}_{name}": count(gene & test & (bins == name)) for name, _, _ in C.GENE_BINS}
        several = gene & test & F.col("gene_multi")
        bins = C.ujc_count_bin(F.col("gene_chains"))
        columns |= {f"{kind}_multi_genes": count(several)} | {f"{kind}_{name}": count(several & (bins == name)) for name, _, _ in C.UJC_BINS}
    return each.groupBy(*KEY).agg(*(c.alias(k) for k, c in columns.items()))


def gene_columns() -> dict[str, str]:
    names = ("Genes_in_cell", "Annotated_genes", "Novel_genes")
    return {n: n for n in names} | {"Annotated_genes_prop_in_cell": safe_prop("Annotated_genes", "Genes_in_cell")}


def gene_metrics(keys: DataFrame) -> DataFrame:
    return _select(keys, gene_columns())


def _bin_columns(bins, total: dict[str, str]) -> dict[str, str]:
    return {f"{kind}_{name}_perc": safe_prop(f"{kind}_{name}", total[kind]) for kind in ("anno", "novel") for name, _, _ in bins}


def gene_bin_columns() -> dict[str, str]:
    return _bin_columns(C.GENE_BINS, {"anno": "Annotated_genes", "novel": "Novel_genes"})


def gene_bin_props(keys: DataFrame) -> DataFrame:
    return _select(keys, gene_bin_columns())


def ujc_bin_columns() -> dict[str, str]:
    return _bin_columns(C.UJC_BINS, {"anno": "anno_multi_genes", "novel": "novel_multi_genes"})


def ujc_bin_props(keys: DataFrame) -> DataFrame:
    """Genes of multi-exon rows by their number of chains."""
    return _select(keys, ujc_bin_columns())


def ujc_columns() -> dict[str, str]:
    return {"UJCs_in_cell": "UJCs_in_cell", "Annotated_juction_strings_prop_in_cell": safe_prop("annotated_chains", "UJCs_in_cell")}


def ujc_metrics(keys: DataFrame) -> DataFrame:
    """Distinct chains of each cell, and the share that have an annotated transcript."""
    return _select(keys, ujc_columns())


#: Names of the counts of junction types.
JUNCTION_NAMES = {t: t[0].upper() + t[1:] + "_junctions" for t in C.JUNCTION_TYPES}


def junction_columns() -> dict[str, str]:
    counts = {n: n for n in (*JUNCTION_NAMES.values(), "total_junctions")}
    return counts | {f"{n}_prop": safe_prop(n, "total_junctions") for n in JUNCTION_NAMES.values()}


def _junction_counts(junctions: DataFrame) -> DataFrame:
    own = junctions.filter(C.valid_cell()).withColumn("type", C.junction_type())
    counts = [F.count(F.when(F.col("type") == t, 1)).alias(name) for t, name in JUNCTION_NAMES.items()]
    return own.groupBy(*KEY).agg(*counts, F.count("*").alias("total_junctions"))


def junction_type_counts(junctions: DataFrame) -> DataFrame:
    """Unweighted junctions of each cell by type, and their shares of all."""
    return _select(_junction_counts(junctions), junction_columns())


def subcategory_columns() -> dict[str, str]:
    out = {}
    for category, own in C.SUBCATEGORIES.items():
        for s in own:
            part = f"coalesce(by['{category}'].sub['{s}'], 0D)"
            out[f"{C.TAGS[category]}_{s.replace('-', '_')}_prop"] = safe_prop(part, _of(category, "w"))
    return out


def subcategory_props(sums: DataFrame) -> DataFrame:
    return _select(sums, subcategory_columns())


def length_bin_columns() -> dict[str, str]:
    out = {}
    for mono in ("", "mono_"):
        out |= {f"Total_{name}_length_{mono}prop": safe_prop(_all(f"len_{mono}{b}"), _all("w")) for b, name in C.LENGTH_BINS.items()}
        for c in C.CATEGORIES:
            out |= {f"{C.TAGS[c]}_{name}_length_{mono}prop": safe_prop(_of(c, f"len_{mono}{b}"), _of(c, "w")) for b, name in C.LENGTH_BINS.items()}
    return out


def length_bin_props(sums: DataFrame) -> DataFrame:
    return _select(sums, length_bin_columns())


def ref_coverage_columns(ref_cov_min_pct: float = 45.0) -> dict[str, str]:
    out = {f"{C.TAGS[c]}_ref_coverage_prop": safe_prop(_of(c, "ref_cov"), _of(c, "w")) for c in C.CATEGORIES}
    return out | {"ref_cov_min_pct": f"{float(ref_cov_min_pct)}D"}


def ref_coverage_props(sums: DataFrame, ref_cov_min_pct: float = 45.0) -> DataFrame:
    return _select(sums, ref_coverage_columns(ref_cov_min_pct))


#: Measure, overall column, suffix of the columns by category, and whether their names are the ORF ones.
QUALITY = (
    ("rts", "RTS_prop_in_cell", "RTS_prop", False),
    ("intrapriming", "Intrapriming_prop_in_cell", "intrapriming_prop", False),
    ("tss", "TSSAnnotationSupport_prop", "TSSAnnotationSupport", False),
    ("nmd", "NMD_prop_in_cell", "NMD_prop", True),
    ("cage", "CAGE_peak_support_prop", "CAGE_peak_support_prop", False),
    ("polya", "PolyA_motif_support_prop", "PolyA_motif_support_prop", False),
    ("cov", "srjunctions_support_prop", "srjunctions_support_prop", False),
    ("ratio", "TSS_ratio_validated_prop", "TSS_ratio_validated_prop", False),
)
CANONICAL = (("noncanon", "Non_canonical_prop_in_cell", "noncanon_prop"), ("canon", "Canonical_prop_in_cell", "canon_prop"))


def quality_columns(skip_orf: bool = False, cage: bool = True, polya: bool = True) -> dict[str, str]:
    """Shares of each cell's rows, and of each category's, that pass each quality test."""
    out = {}
    for measure, overall, suffix, orf in QUALITY:
        off = measure == "cage" and not cage or measure == "polya" and not polya or orf and skip_orf
        out[overall] = "0D" if off else safe_prop(_all(measure), _all("w"))
        if not (orf and skip_orf):
            tag = C.coding_tag if orf else C.TAGS.get
            out |= {f"{tag(c)}_{suffix}": "0D" if off else safe_prop(_of(c, measure), _of(c, "w")) for c in C.CATEGORIES}
    for measure, overall, suffix in CANONICAL:
        out[overall] = safe_prop(_all(measure), _all("not_mono"))
        out |= {f"{C.TAGS[c]}_{suffix}": safe_prop(_of(c, f"multi_{measure}"), _of(c, "multi")) for c in C.CATEGORIES}
    for measure, when_skipped in (("coding", "0D"), ("non_coding", "100D")):
        out |= {f"{C.coding_tag(c)}_{measure}_prop": when_skipped if skip_orf else safe_prop(_of(c, measure), _of(c, "w")) for c in C.CATEGORIES}
    return out


def quality_props(sums: DataFrame, skip_orf: bool = False, cage: bool = True, polya: bool = True) -> DataFrame:
    return _select(sums, quality_columns(skip_orf, cage, polya))


#: Names of the written summary.
NAMES = {
    "reads": {"total_reads": "Reads_in_cell", "total_UMI": "UMIs_in_cell"},
    "isoforms": {"total_reads": "Transcripts_in_cell", "total_reads_no_monoexon": "total_transcripts_no_monoexon", "MT_reads_count": "MT_transcripts_count"},
}


def cell_summary(
    cells: DataFrame, junctions: DataFrame, mode: str = "reads", skip_orf: bool = False, cage: bool = True, polya: bool = True, ref_cov_min_pct: float = 45.0, placed: bool = False, **thresholds
) -> DataFrame:
    """One wide row for each cell, named as the mode says; what a cell lacks is 0."""
    sums = category_sums(cells, ref_cov_min_pct=ref_cov_min_pct, placed=placed, **thresholds)
    columns = total_columns() | category_columns() | mt_columns() | subcategory_columns() | length_bin_columns() | ref_coverage_columns(ref_cov_min_pct)
    columns |= quality_columns(skip_orf, cage, polya) | gene_columns() | gene_bin_columns()
    columns |= {n: f"coalesce({text}, 0)" for n, text in junction_columns().items()}
    if mode == "reads":
        columns |= {"total_UMI": "total_UMI"} | ujc_columns() | ujc_bin_columns()
    else:
        columns["Annotated_juction_strings_prop_in_cell"] = "0D"
    parts = [sums, key_counts(cells, placed), _junction_counts(junctions)]
    joined = reduce(lambda a, b: a.join(b, KEY, "left"), parts)
    return _select(joined, {NAMES[mode].get(n, n): text for n, text in columns.items()})


def long_form(summary: DataFrame) -> DataFrame:
    """``metric`` and ``value`` of each cell."""
    names = [c for c in summary.columns if c not in KEY]
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in names)
    return summary.selectExpr(*KEY, f"stack({len(names)}, {pairs}) AS (metric, value)")
