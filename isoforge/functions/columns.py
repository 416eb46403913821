"""Column expressions and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Structural categories and their tags, in report order.
TAGS = {
    "full-splice_match": "FSM",
    "incomplete-splice_match": "ISM",
    "novel_in_catalog": "NIC",
    "novel_not_in_catalog": "NNC",
    "genic": "Genic",
    "antisense": "Antisense",
    "fusion": "Fusion",
    "intergenic": "Intergenic",
    "genic_intron": "Genic_intron",
}
CATEGORIES = tuple(TAGS)

# Subcategories of each category.
SUBCATEGORIES = {
    "full-splice_match": ("alternative_3end", "alternative_3end5end", "alternative_5end", "reference_match", "mono-exon"),
    "incomplete-splice_match": ("3prime_fragment", "internal_fragment", "5prime_fragment", "intron_retention", "mono-exon"),
    "novel_in_catalog": ("combination_of_known_junctions", "combination_of_known_splicesites", "intron_retention", "mono-exon_by_intron_retention", "mono-exon"),
    "novel_not_in_catalog": ("at_least_one_novel_splicesite", "intron_retention"),
    "genic": ("mono-exon", "multi-exon"),
    "antisense": ("mono-exon", "multi-exon"),
    "fusion": ("intron_retention", "multi-exon"),
    "intergenic": ("mono-exon", "multi-exon"),
    "genic_intron": ("mono-exon", "multi-exon"),
}

JUNCTION_TYPES = ("known_canonical", "known_non_canonical", "novel_canonical", "novel_non_canonical")
LENGTH_BINS = {"two_fifty": "250b", "five_hund": "500b", "short": "short", "mid": "mid", "long": "long"}


def count_name(category: str) -> str:
    return "Genic_Genomic" if category == "genic" else TAGS[category]


def coding_tag(category: str) -> str:
    tag = TAGS[category]
    return tag if tag.isupper() else tag.lower()


def valid_cell(cb: str = "CB") -> Column:
    """A barcode that names a cell."""
    return F.col(cb).isNotNull() & ~F.col(cb).isin("", "NA", "unassigned")


def starts_novel(column: str) -> Column:
    """Null counts as annotated."""
    return F.coalesce(F.col(column), F.lit("")).startswith("novel")


def multi_exon() -> Column:
    return F.coalesce(F.col("exons") > 1, F.lit(False))


def not_mono() -> Column:
    """Unknown exon counts are not mono-exon."""
    return ~F.col("exons").eqNullSafe(F.lit(1.0))


def junction_type() -> Column:
    return F.concat_ws("_", "junction_category", "canonical")


def length_bin(column: str = "length") -> Column:
    x = F.col(column)
    return F.when(x <= 250, "two_fifty").when(x <= 500, "five_hund").when(x <= 1000, "short").when(x <= 2000, "mid").when(x > 2000, "long").otherwise("unknown")


def _binned(x: Column, bins) -> Column:
    out = None
    for name, low, high in bins:
        test = x >= low if high is None else (x >= low) & (x <= high)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


GENE_BINS = (("bin1", 1, 1), ("bin2_4", 2, 4), ("bin5_9", 5, 9), ("bin10plus", 10, None))
REPORT_GENE_BINS = (("1", 1, 1), ("2-5", 2, 5), ("6-9", 6, 9), (">=10", 10, None))
UJC_BINS = (("ujc_bin1", 1, 1), ("ujc_bin2_3", 2, 3), ("ujc_bin4_5", 4, 5), ("ujc_bin6plus", 6, None))


def gene_count_bin(x: Column) -> Column:
    return _binned(x, GENE_BINS)


def report_gene_bin(x: Column) -> Column:
    return _binned(x, REPORT_GENE_BINS)


def ujc_count_bin(x: Column) -> Column:
    return _binned(x, UJC_BINS)


def exon_bin(column: str = "exons") -> Column:
    """Null goes to the last bin."""
    x = F.col(column)
    return F.when(x <= 1, "1").when(x <= 3, "2-3").when(x <= 5, "4-5").otherwise(">=6")


def quality_predicates(min_cov: float = 1.0, ratio_tss: float = 2.0) -> dict[str, Column]:
    false = F.lit(False)
    tests = {
        "rts": F.col("RTS_stage") == "TRUE",
        "noncanon": F.col("all_canonical") == "non_canonical",
        "canon": F.col("all_canonical") == "canonical",
        "intrapriming": F.col("perc_A_downstream_TTS") >= 60,
        "tss": F.abs("diff_to_gene_TSS") <= 50,
        "nmd": F.col("predicted_NMD") == "TRUE",
        "cage": F.col("within_CAGE_peak") == "TRUE",
        "polya": F.col("polyA_motif_found") == "TRUE",
        "cov": F.col("min_cov") >= min_cov,
        "ratio": F.col("ratio_TSS") >= ratio_tss,
        "coding": F.col("coding") == "coding",
        "non_coding": F.col("coding") == "non_coding",
    }
    return {k: F.coalesce(t, false) for k, t in tests.items()}


def ref_body_covered(cutoff: float = 45.0) -> Column:
    share = F.try_divide(F.col("length").cast("double"), F.col("ref_length").cast("double")) * 100.0 >= cutoff
    return F.coalesce(share, (F.col("ref_length") == 0) & (F.col("length") > 0), F.lit(False))


def all_canonical_status(column: str) -> Column:
    x = F.lower(column)
    return F.when(x.isin("true", "canonical", "yes"), True).when(x.isin("false", "non_canonical", "no"), False)


def rts_bool(column: str) -> Column:
    return F.coalesce(F.lower(column).isin("true", "t", "1", "yes"), F.lit(False))


def junction_label(start: str = "genomic_start_coord", end: str = "genomic_end_coord", chrom: str = "chrom", strand: str = "strand") -> Column:
    """Contig, strand, start and end; other columns may be named where a table calls them otherwise."""
    return F.concat_ws("_", chrom, strand, *(F.col(c).cast("long").cast("string") for c in (start, end)))


def format_chr(column: str) -> Column:
    c = F.col(column)
    return F.when(c.startswith("chr"), c).otherwise(F.concat(F.lit("chr"), c))


def ujc_hash(column: str) -> Column:
    return F.sha2(F.col(column), 256)


def dup_primary(column: str = "isoform") -> Column:
    """The read that a ``_dupN`` name repeats; null for other names."""
    return F.nullif(F.regexp_extract(column, r"^(.+)_dup\d+$", 1), F.lit(""))


def read_type_filter(column: str, novel: bool = False, ambiguous: bool = False) -> Column:
    test = F.col(column) == "known"
    if novel:
        test = test | (F.col(column) == "novel")
    if ambiguous:
        test = test | F.col(column).contains("ambiguous")
    return F.coalesce(test, F.lit(False))


def safe_prop(n: Column, d: Column) -> Column:
    """Percent, 0 without a positive denominator."""
    return F.when(d > 0, 100.0 * n / d).otherwise(0.0)


def category_tag(column: str = "structural_category") -> Column:
    pairs = [F.lit(x) for kv in TAGS.items() for x in kv]
    return F.create_map(*pairs)[F.col(column)]


def isoform_weight(column: str = "FL") -> Column:
    """Sum of a comma list; 1 if it is null or not positive."""
    total = F.aggregate(F.split(column, ","), F.lit(0.0), lambda a, x: a + F.coalesce(x.try_cast("double"), F.lit(0.0)))
    return F.when(total > 0, total).otherwise(1.0)


def clamp(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
