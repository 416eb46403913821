"""A query for each operator that yields a table, and the SQL that gives the same rows: per-cell tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isoforge.functions import columns as C
from isoforge.operators import cell_summary as S
from isoforge.operators import cell_tables as T
from isoforge.operators.explode import explode_cells
from isoforge.plans.adapters import CLASSIFICATION, ISOFORMS, JUNCTIONS, by_row, classification, for_sql, junctions, saved_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WITH = f"""WITH cls AS ({for_sql(CLASSIFICATION)}), junc AS ({for_sql(JUNCTIONS)}), isoforms AS ({for_sql(ISOFORMS)}),
cells AS (SELECT *, CAST(1 AS DOUBLE) AS w FROM cls WHERE CB IS NOT NULL AND CB NOT IN ('', 'NA', 'unassigned')),
weighted AS (SELECT * EXCLUDE (w), CASE WHEN sum_fl > 0 THEN sum_fl ELSE 1 END AS w
  FROM (SELECT *, CAST(split_part(FL, ',', 1) AS DOUBLE) + CAST(split_part(FL, ',', 2) AS DOUBLE) AS sum_fl FROM cells))
"""


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.selectExpr(*(f"round(`{c}`, {places}) AS `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes))


def add(name: str, sql: str | None = None, places: int = 6):
    def keep(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir), places)
        if sql is not None:
            SQL[name] = WITH + sql
        return f

    return keep


def cells_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_cells(classification(spark, sf_dir))


def weighted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as of isoforms mode: each weighs the sum of its counts."""
    return cells_of(spark, sf_dir).withColumn("_count", C.isoform_weight("FL"))


def sums_of(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    """The sums that some columns of the summary need."""
    return S.category_sums(cells_of(spark, sf_dir), only=S.measures_of(columns))


def keys_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.key_counts(cells_of(spark, sf_dir))


def prop(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN round(100.0 * CAST({n} AS DOUBLE) / {d}, 6) ELSE CAST(0 AS DOUBLE) END"


def w(test: str) -> str:
    return f"sum(CASE WHEN {test} THEN w ELSE 0 END)"


def per_cell(columns: dict[str, str], source: str = "cells") -> str:
    return f"SELECT sampleID, CB, {', '.join(f'{v} AS {chr(34)}{k}{chr(34)}' for k, v in columns.items())} FROM {source} GROUP BY sampleID, CB"


def of(c: str) -> str:
    return f"structural_category = '{c}'"


ALL = "sum(w)"
NOT_MONO = w("exons IS DISTINCT FROM 1")
TESTS = {
    "rts": "RTS_stage = 'TRUE'",
    "noncanon": "all_canonical = 'non_canonical'",
    "canon": "all_canonical = 'canonical'",
    "intrapriming": "perc_A_downstream_TTS >= 60",
    "tss": "abs(diff_to_gene_TSS) <= 50",
    "nmd": "predicted_NMD = 'TRUE'",
    "cage": "within_CAGE_peak = 'TRUE'",
    "polya": "polyA_motif_found = 'TRUE'",
    "cov": "min_cov >= 1",
    "ratio": "ratio_TSS >= 2",
    "coding": "coding = 'coding'",
    "non_coding": "coding = 'non_coding'",
}
NOVEL = "coalesce(associated_gene, '') LIKE 'novel%'"
TYPE = "concat(junction_category, '_', canonical)"

TOTALS = {"total_reads": ALL, "total_reads_no_monoexon": NOT_MONO, "total_UMI": "count(DISTINCT UMI)"}


@add("a01_cell_totals", per_cell(TOTALS))
def _(spark, d):
    cells = cells_of(spark, d)
    return S.cell_totals(cells, S.category_sums(cells))


_counts = {C.count_name(c): w(of(c)) for c in C.CATEGORIES}
CATEGORY_SQL = _counts | {f"{k}_prop": prop(v, ALL) for k, v in _counts.items()}


@add("a02_category_counts", per_cell(CATEGORY_SQL))
def _(spark, d):
    return S.category_counts(sums_of(spark, d, S.category_columns()))


_annotated = f"count(DISTINCT CASE WHEN NOT {NOVEL} THEN associated_gene END)"
GENES = {
    "Genes_in_cell": "count(DISTINCT associated_gene)",
    "Annotated_genes": _annotated,
    "Novel_genes": f"count(DISTINCT CASE WHEN {NOVEL} THEN associated_gene END)",
    "Annotated_genes_prop_in_cell": prop(_annotated, "count(DISTINCT associated_gene)"),
}


@add("a03_a13_gene_metrics", per_cell(GENES))
def _(spark, d):
    return S.gene_metrics(keys_of(spark, d))


_chain = "count(DISTINCT CASE WHEN exons > 1 THEN jxn_string END)"
_known = "count(DISTINCT CASE WHEN exons > 1 AND coalesce(associated_transcript, '') NOT LIKE 'novel%' THEN jxn_string END)"
CHAINS = {"UJCs_in_cell": _chain, "Annotated_juction_strings_prop_in_cell": prop(_known, _chain)}


@add("a04_a14_ujc_metrics", per_cell(CHAINS))
def _(spark, d):
    return S.ujc_metrics(keys_of(spark, d))


MT = {"MT_reads_count": w("chrom = 'MT'"), "MT_perc": prop(w("chrom = 'MT'"), ALL)}


@add("a05_mt_share", per_cell(MT))
def _(spark, d):
    return S.mt_share(sums_of(spark, d, S.mt_columns()))


_types = {t[0].upper() + t[1:] + "_junctions": f"count(CASE WHEN {TYPE} = '{t}' THEN 1 END)" for t in C.JUNCTION_TYPES}
JUNCTION_COUNTS = _types | {"total_junctions": "count(*)"} | {f"{k}_prop": prop(v, "count(*)") for k, v in _types.items()}
JUNCTION_CELLS = "(SELECT * FROM junc WHERE CB IS NOT NULL)"


@add("a06_junction_type_counts", per_cell(JUNCTION_COUNTS, JUNCTION_CELLS))
def _(spark, d):
    return S.junction_type_counts(junctions(spark, d))


SUBCATEGORY_SQL = {
    f"{C.TAGS[c]}_{s.replace('-', '_')}_prop": prop(w(f"{of(c)} AND subcategory = '{s}'"), w(of(c))) for c, own in C.SUBCATEGORIES.items() for s in own
}


@add("a07_subcategory_props", per_cell(SUBCATEGORY_SQL))
def _(spark, d):
    return S.subcategory_props(sums_of(spark, d, S.subcategory_columns()))


def _bins_sql(bins) -> dict[str, str]:
    out = {}
    for kind, test in (("anno", f"NOT {NOVEL}"), ("novel", NOVEL)):
        for name, low, high in bins:
            inside = f"n >= {low}" + (f" AND n <= {high}" if high else "")
            out[f"{kind}_{name}_perc"] = prop(f"count(CASE WHEN {test} AND {inside} THEN 1 END)", f"count(CASE WHEN {test} THEN 1 END)")
    return out


def _by_gene(n: str, more: str = "") -> str:
    return f"""(SELECT sampleID, CB, associated_gene, {n} AS n FROM cells WHERE {more}associated_gene IS NOT NULL
    GROUP BY sampleID, CB, associated_gene)"""


GENE_BINS_SQL = per_cell(_bins_sql(C.GENE_BINS), _by_gene("sum(w)"))


@add("a08_gene_bin_props", GENE_BINS_SQL)
def _(spark, d):
    return S.gene_bin_props(keys_of(spark, d))


UJC_BINS_SQL = f"""SELECT sampleID, CB, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _bins_sql(C.UJC_BINS))} FROM (SELECT DISTINCT sampleID, CB FROM cells)
LEFT JOIN ({per_cell(_bins_sql(C.UJC_BINS), _by_gene('count(DISTINCT jxn_string)', 'exons > 1 AND '))}) USING (sampleID, CB)"""


@add("a09_ujc_bin_props", UJC_BINS_SQL)
def _(spark, d):
    return S.ujc_bin_props(keys_of(spark, d))


def quality_sql(skip_orf: bool = False) -> dict[str, str]:
    out = {}
    for measure, overall, suffix, orf in S.QUALITY:
        out[overall] = "CAST(0 AS DOUBLE)" if orf and skip_orf else prop(w(TESTS[measure]), ALL)
        if not (orf and skip_orf):
            tag = C.coding_tag if orf else C.TAGS.get
            out |= {f"{tag(c)}_{suffix}": prop(w(f"{of(c)} AND {TESTS[measure]}"), w(of(c))) for c in C.CATEGORIES}
    for measure, overall, suffix in S.CANONICAL:
        out[overall] = prop(w(TESTS[measure]), NOT_MONO)
        out |= {f"{C.TAGS[c]}_{suffix}": prop(w(f"{of(c)} AND exons > 1 AND {TESTS[measure]}"), w(f"{of(c)} AND exons > 1")) for c in C.CATEGORIES}
    for measure, skipped in (("coding", 0), ("non_coding", 100)):
        own = (lambda c, m=measure: prop(w(f"{of(c)} AND {TESTS[m]}"), w(of(c)))) if not skip_orf else lambda c, x=skipped: f"CAST({x} AS DOUBLE)"
        out |= {f"{C.coding_tag(c)}_{measure}_prop": own(c) for c in C.CATEGORIES}
    return out


@add("a10_quality_props", per_cell(quality_sql()))
def _(spark, d):
    return S.quality_props(sums_of(spark, d, S.quality_columns()))


_LENGTHS = {
    "two_fifty": "length <= 250",
    "five_hund": "length > 250 AND length <= 500",
    "short": "length > 500 AND length <= 1000",
    "mid": "length > 1000 AND length <= 2000",
    "long": "length > 2000",
}


def _length_sql() -> dict[str, str]:
    out = {}
    for mono, more in (("", ""), ("mono_", " AND exons = 1")):
        for b, name in C.LENGTH_BINS.items():
            out[f"Total_{name}_length_{mono}prop"] = prop(w(_LENGTHS[b] + more), ALL)
            out |= {f"{C.TAGS[c]}_{name}_length_{mono}prop": prop(w(f"{of(c)} AND {_LENGTHS[b]}{more}"), w(of(c))) for c in C.CATEGORIES}
    return out


@add("a11_length_bin_props", per_cell(_length_sql()))
def _(spark, d):
    return S.length_bin_props(sums_of(spark, d, S.length_bin_columns()))


_covered = "CASE WHEN ref_length = 0 THEN length > 0 ELSE length / ref_length * 100 >= 45 END"
COVERAGE_SQL = {f"{C.TAGS[c]}_ref_coverage_prop": prop(w(f"{of(c)} AND {_covered}"), w(of(c))) for c in C.CATEGORIES} | {"ref_cov_min_pct": "CAST(45 AS DOUBLE)"}


@add("a12_ref_coverage_props", per_cell(COVERAGE_SQL))
def _(spark, d):
    return S.ref_coverage_props(sums_of(spark, d, S.ref_coverage_columns()))


def _named(columns: dict[str, str], mode: str) -> dict[str, str]:
    return {S.NAMES[mode].get(k, k): v for k, v in columns.items()}


def summary_sql(mode: str = "reads", skip_orf: bool = False, source: str = "cells") -> str:
    """The whole summary: one aggregate and the parts that need others, joined."""
    totals = {k: v for k, v in TOTALS.items() if mode == "reads" or k != "total_UMI"} | MT
    columns = _named(totals, mode) | CATEGORY_SQL | SUBCATEGORY_SQL | _length_sql() | COVERAGE_SQL | quality_sql(skip_orf) | GENES
    columns |= CHAINS if mode == "reads" else {"Annotated_juction_strings_prop_in_cell": "CAST(0 AS DOUBLE)"}
    gene_bins = GENE_BINS_SQL.replace("FROM cells", f"FROM {source}")
    parts = [per_cell(columns, source), gene_bins, per_cell(JUNCTION_COUNTS, JUNCTION_CELLS), *([UJC_BINS_SQL] if mode == "reads" else [])]
    joined = " ".join(f"{'LEFT JOIN' if i else 'FROM'} ({p}) AS p{i}{' USING (sampleID, CB)' if i else ''}" for i, p in enumerate(parts))
    filled = ", ".join(f"coalesce({k}, 0) AS {k}" for k in JUNCTION_COUNTS)
    return f"SELECT * EXCLUDE ({', '.join(JUNCTION_COUNTS)}), {filled} FROM (SELECT * {joined})"


def summary_of(spark: SparkSession, sf_dir: str, mode: str = "reads", skip_orf: bool = False) -> DataFrame:
    lines = saved_lines(spark, sf_dir)
    cells = explode_cells(classification(spark, sf_dir, lines))
    if mode == "isoforms":
        cells = cells.withColumn("_count", C.isoform_weight("FL"))
    return S.cell_summary(cells, junctions(spark, sf_dir, lines), mode, skip_orf)


@add("a15_cell_summary", summary_sql())
def _(spark, d):
    return summary_of(spark, d)


@add("a15_cell_summary_skip_orf", summary_sql(skip_orf=True))
def _(spark, d):
    return summary_of(spark, d, skip_orf=True)


@add("a15_cell_summary_isoforms", summary_sql("isoforms", source="weighted"))
def _(spark, d):
    return summary_of(spark, d, "isoforms")


_off = {k: "CAST(0 AS DOUBLE)" for k in quality_sql() if "CAGE_peak" in k or "PolyA_motif" in k}


@add("a10c_quality_without_options", per_cell(quality_sql() | _off))
def _(spark, d):
    return S.quality_props(sums_of(spark, d, S.quality_columns(cage=False, polya=False)), cage=False, polya=False)


_by_category = ", ".join(f"count(CASE WHEN {of(c)} THEN 1 END) AS \"{c}\"" for c in C.CATEGORIES)


def _gene_table(chain: str) -> str:
    return f"""SELECT sampleID, associated_gene, CB, {_by_category}, count(*) AS total_read_count, count(DISTINCT {chain}) AS unique_jxnHash_counts,
  CASE WHEN {NOVEL} THEN 0 ELSE 1 END AS flag_annotated_gene
FROM cells WHERE associated_gene IS NOT NULL GROUP BY sampleID, associated_gene, CB"""


@add("a30_gene_counts_by_cell", _gene_table("jxnHash"))
def _(spark, d):
    return T.gene_counts_by_cell(cells_of(spark, d))


@add("a30_gene_counts_without_hash", _gene_table("isoform"))
def _(spark, d):
    return T.gene_counts_by_cell(cells_of(spark, d).drop("jxnHash"))


def _majority(column: str) -> str:
    return f"""(SELECT * FROM (SELECT sampleID, jxnHash, CB, {column},
    row_number() OVER (PARTITION BY sampleID, jxnHash, CB ORDER BY count(*) DESC, {column}) AS rn
    FROM cells WHERE exons > 1 AND {column} IS NOT NULL GROUP BY sampleID, jxnHash, CB, {column}) WHERE rn = 1)"""


@add("a32_majority_gene", f"SELECT sampleID, jxnHash, CB, associated_gene FROM {_majority('associated_gene')}")
def _(spark, d):
    return T.majority_value(cells_of(spark, d).filter("exons > 1"), ["sampleID", "jxnHash", "CB"], "associated_gene")


_jt = ", ".join(f"count(CASE WHEN {TYPE} = '{t}' THEN 1 END) AS {t}" for t in C.JUNCTION_TYPES)
_UJC = f""", h AS (SELECT sampleID, jxnHash, {_jt} FROM junc JOIN (SELECT DISTINCT sampleID, isoform, jxnHash FROM cells) USING (sampleID, isoform)
  GROUP BY sampleID, jxnHash),
m AS (SELECT sampleID, jxnHash, CB, count(*) AS read_count FROM cells WHERE exons > 1 GROUP BY sampleID, jxnHash, CB),
u AS (SELECT m.sampleID, m.jxnHash, m.CB, m.read_count, g.associated_gene, s.structural_category, {', '.join(f'coalesce({t}, 0) AS {t}' for t in C.JUNCTION_TYPES)}
  FROM m LEFT JOIN {_majority('associated_gene')} g USING (sampleID, jxnHash, CB)
  LEFT JOIN {_majority('structural_category')} s USING (sampleID, jxnHash, CB) LEFT JOIN h USING (sampleID, jxnHash)
  UNION ALL SELECT sampleID, jxnHash, CB, count(*), associated_gene, structural_category, 0, 0, 0, 0 FROM cells
  WHERE exons <= 1 GROUP BY sampleID, jxnHash, CB, associated_gene, structural_category)
SELECT *, CASE WHEN associated_gene IS NOT NULL THEN CAST(read_count = max(read_count) OVER (PARTITION BY sampleID, associated_gene, CB) AS INT) END AS flag_MEI,
  CASE WHEN {NOVEL} THEN 0 ELSE 1 END AS flag_annotated_gene FROM u"""


@add("a31_ujc_counts_by_cell", _UJC)
def _(spark, d):
    return T.ujc_counts_by_cell(cells_of(spark, d), junctions(spark, d))


def _cv(side: str, donor: str) -> str:
    genes = "count(DISTINCT associated_gene)"
    return f"""SELECT sampleID, chrom, strand, CAST(genomic_{side}_coord + diff_to_Ref_{side}_site AS BIGINT) AS coord,
  round(avg(d), 6) AS mean_abs_diff, round(stddev_samp(d), 6) AS std_abs_diff,
  CASE WHEN avg(d) <> 0 THEN round(stddev_pop(d) / avg(d), 6) END AS cv, count(*) AS count,
  string_agg(DISTINCT associated_gene, '|' ORDER BY associated_gene) AS associated_gene, CAST({genes} AS INT) AS gene_count,
  CAST({genes} > 1 AS INT) AS flag_multi_gene,
  CAST(count(CASE WHEN associated_gene LIKE 'novel%' THEN 1 END) = 0 AND count(associated_gene) > 0 AS INT) AS flag_annotated_gene,
  CAST(strand = '{donor}' AS INT) AS flag_donor, CAST(strand <> '{donor}' AS INT) AS flag_acceptor,
  CAST(avg(d) = 0 AS INT) AS flag_mean_0, coalesce(CAST(stddev_samp(d) = 0 AS INT), 0) AS flag_std_0, CAST(avg(d) = 0 AS INT) AS flag_ref_match,
  CAST(avg(d) <> 0 AND stddev_pop(d) = 0 AS INT) AS flag_cv_0, CAST(avg(d) <> 0 AND stddev_pop(d) > 0 AS INT) AS flag_cv_gt_0, CB
FROM (SELECT j.* EXCLUDE (CB), c.CB, c.associated_gene, CAST(abs(diff_to_Ref_{side}_site) AS DOUBLE) AS d
  FROM junc j JOIN cells c USING (sampleID, isoform) WHERE diff_to_Ref_start_site IS NOT NULL AND diff_to_Ref_end_site IS NOT NULL)
GROUP BY sampleID, chrom, strand, coord, CB"""


@add("a40_a41_junction_cv_by_cell", _cv("start", "+") + " UNION ALL " + _cv("end", "-"))
def _(spark, d):
    reads = by_row(saved_lines(spark, d, names_only=True))
    return T.junction_cv_by_cell(explode_cells(classification(spark, d, reads)), junctions(spark, d, reads))
