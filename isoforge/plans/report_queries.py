"""A query for each operator that yields a table, and its SQL: enrichment, matrices, report, cohort and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.operators import cell_summary as S
from isoforge.operators import clustering as K
from isoforge.operators import cohort as H
from isoforge.operators import embedding as G
from isoforge.operators import enrich as E
from isoforge.operators import matrix as M
from isoforge.operators import report_tables as R
from isoforge.operators import sketches as Q
from isoforge.operators import sparse as P
from isoforge.operators.explode import explode_cells
from isoforge.plans.adapters import classification, isoform_counts, junctions, saved_lines
from isoforge.plans.queries import JUNCTION_CELLS, NOVEL, SQL, TYPE, add, cells_of, prop, rounded, summary_of, summary_sql, w, weighted_cells
from isoforge.sources.shared import Saved

KEYS = "sampleID, CB"


def grid(source: str, keys: str, column: str, levels) -> str:
    """Counts ``n`` of ``source`` completed over levels, with their percent."""
    values = ", ".join(f"({repr(x)})" for x in levels)
    total = f"sum(coalesce(n, 0)) OVER (PARTITION BY {keys})"
    return f"""SELECT {keys}, {column}, coalesce(n, 0) AS n,
  CASE WHEN {total} > 0 THEN round(100.0 * CAST(coalesce(n, 0) AS DOUBLE) / {total}, 6) ELSE CAST(0 AS DOUBLE) END AS percent
FROM (SELECT DISTINCT {keys} FROM {source}) CROSS JOIN (VALUES {values}) AS l({column}) LEFT JOIN {source} AS o USING ({keys}, {column})"""


def isoform_lists(spark, d):
    """Isoform rows with parallel lists of cells and weights."""
    pairs = isoform_counts(spark, d).groupBy("sampleID", "isoform").agg(F.array_sort(F.collect_list(F.struct("CB", "n"))).alias("x"))
    weights = F.array_join(F.transform("x", lambda p: p["n"].cast("string")), ",")
    return pairs.select("sampleID", "isoform", F.array_join("x.CB", ",").alias("CB"), weights.alias("FL"))


@add("p02_isoform_lists", "SELECT sampleID, CB, CAST(sum(n) AS DOUBLE) AS weight, count(*) AS isoforms FROM isoforms GROUP BY sampleID, CB")
def _(spark, d):
    return explode_cells(isoform_lists(spark, d), "isoforms").groupBy("sampleID", "CB").agg(F.sum("_count").alias("weight"), F.count("*").alias("isoforms"))


_EXPRESSIONS = {
    "tag": "CASE structural_category " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in C.TAGS.items()) + " END",
    "weight": "CASE WHEN sum_fl > 0 THEN sum_fl ELSE 1 END",
    "clamped": "least(greatest(diff_to_gene_TSS, 0), 100)",
    "primary_id": "nullif(regexp_extract(concat(isoform, CASE WHEN exons = 2 THEN '_dup1' ELSE '' END), '^(.+)_dup[0-9]+$', 1), '')",
}


@add("p19_p22_p23_p25_expressions", f"SELECT sampleID, isoform, {', '.join(f'{v} AS {k}' for k, v in _EXPRESSIONS.items())} FROM (SELECT * FROM weighted)")
def _(spark, d):
    cells = cells_of(spark, d).withColumn("name", F.concat("isoform", F.when(F.col("exons") == 2, "_dup1").otherwise("")))
    return cells.select(
        "sampleID", "isoform", C.category_tag().alias("tag"), C.isoform_weight().alias("weight"),
        C.clamp(F.col("diff_to_gene_TSS")).alias("clamped"), C.dup_primary("name").alias("primary_id"),
    )


_TYPES = {"known": "coding = 'coding'", "novel": "coding = 'non_coding' AND exons > 3"}
_KIND = f"CASE WHEN {_TYPES['known']} THEN 'known' WHEN {_TYPES['novel']} THEN 'novel' ELSE 'known_ambiguous' END"


@add("p20_read_types", f"SELECT sampleID, k AS read_type, count(*) AS n FROM (SELECT *, {_KIND} AS k FROM cells) WHERE k IN ('known', 'novel', 'known_ambiguous') GROUP BY ALL")
def _(spark, d):
    reads = cells_of(spark, d).select("sampleID", F.expr(_KIND).alias("read_type"))
    return reads.filter(C.read_type_filter("read_type", novel=True, ambiguous=True)).groupBy("sampleID", "read_type").agg(F.count("*").alias("n"))


#: Rows of one exon have no entry of their own; those of two are duplicates of the isoform whose number of lines is three.
_NAMES = "SELECT * REPLACE (CASE WHEN exons = 2 THEN concat(isoform, '_dup1') ELSE isoform END AS isoform) FROM cls"
_ASSOC = """SELECT sampleID, isoform, CB, UMI FROM cls WHERE exons > 2
  UNION ALL SELECT sampleID, isoform, 'primary' || CB, UMI FROM cls WHERE exons = 2 AND ratio_TSS > 1
  UNION ALL SELECT sampleID, concat(isoform, '_dup1'), CB, UMI FROM cls WHERE exons = 2 AND min_cov > 1"""


def _names_and_association(spark, d):
    """Rows of new names, and an association of up to two entries of each row, by one scan each of the same lines."""
    cls = classification(spark, d, saved_lines(spark, d, names_only=True))
    name = F.when(F.col("exons") == 2, F.concat("isoform", F.lit("_dup1"))).otherwise(F.col("isoform"))
    entry = lambda isoform, cb: F.struct(isoform.alias("isoform"), cb.alias("CB"))
    own, two = entry(F.col("isoform"), F.col("CB")), F.col("exons") == 2
    each = F.array(
        F.when(F.col("exons") > 2, own), F.when(two & (F.col("ratio_TSS") > 1), entry(F.col("isoform"), F.concat(F.lit("primary"), "CB"))),
        F.when(two & (F.col("min_cov") > 1), entry(F.concat("isoform", F.lit("_dup1")), F.col("CB"))),
    )
    assoc = cls.select("sampleID", "UMI", F.explode(F.array_compact(each)).alias("e")).select("sampleID", "e.isoform", "e.CB", "UMI")
    return cls.withColumn("isoform", name), assoc


@add("j01_annotate_cells_reads", f""", a AS ({_ASSOC}), n AS ({_NAMES})
SELECT n.sampleID, n.isoform, CASE WHEN p.isoform IS NOT NULL THEN p.CB ELSE o.CB END AS CB, CASE WHEN p.isoform IS NOT NULL THEN p.UMI ELSE o.UMI END AS UMI
FROM n LEFT JOIN a o ON n.sampleID = o.sampleID AND n.isoform = o.isoform
LEFT JOIN a p ON n.sampleID = p.sampleID AND p.isoform = regexp_extract(n.isoform, '^(.+)_dup[0-9]+$', 1)""")
def _(spark, d):
    cls, assoc = _names_and_association(spark, d)
    return E.annotate_cells_reads(cls, assoc).select("sampleID", "isoform", "CB", "UMI")


@add("j02_annotate_cells_isoforms", """SELECT sampleID, isoform, structural_category, i.CB, CAST(i.n AS DOUBLE) AS _count
FROM (SELECT DISTINCT sampleID, isoform, 'genic' AS structural_category FROM isoforms) LEFT JOIN isoforms i USING (sampleID, isoform)""")
def _(spark, d):
    counts = isoform_counts(spark, d)
    cls = counts.select("sampleID", "isoform", F.lit("genic").alias("structural_category")).distinct()
    return E.annotate_cells_isoforms(cls, abundance=counts.withColumnRenamed("n", "count"))


@add("j02_annotate_cells_isoform_lists", """SELECT sampleID, isoform, i.CB, CAST(1 AS DOUBLE) AS _count
FROM (SELECT DISTINCT sampleID, isoform FROM isoforms) LEFT JOIN isoforms i USING (sampleID, isoform)""")
def _(spark, d):
    lists = isoform_lists(spark, d)
    return E.annotate_cells_isoforms(lists.select("sampleID", "isoform"), assoc=lists)


@add("j03_annotate_junction_cells", "SELECT j.sampleID, j.isoform, genomic_start_coord, a.CB FROM junc j LEFT JOIN (SELECT * FROM cls WHERE exons > 4) a USING (sampleID, isoform)")
def _(spark, d):
    assoc = classification(spark, d).filter("exons > 4")
    return E.annotate_junction_cells(junctions(spark, d), assoc).select("sampleID", "isoform", "genomic_start_coord", "CB")


@add("j04_junction_cells_fallback", "SELECT j.sampleID, j.isoform, j.genomic_start_coord, c.CB FROM junc j LEFT JOIN (SELECT DISTINCT sampleID, isoform, CB FROM cells) c USING (sampleID, isoform)")
def _(spark, d):
    return E.junction_cells_fallback(junctions(spark, d), cells_of(spark, d)).select("sampleID", "isoform", "genomic_start_coord", "CB")


_CHAIN = """CASE WHEN exons = 1 THEN concat(CASE WHEN chrom LIKE 'chr%' THEN chrom ELSE concat('chr', chrom) END, '_', strand, '_monoexon_', associated_transcript)
  ELSE jxn_string END"""


@add("j05_attach_ujc", f"SELECT sampleID, isoform, x AS jxn_string, sha256(x) AS jxnHash FROM (SELECT sampleID, isoform, {_CHAIN} AS x FROM cls)")
def _(spark, d):
    cls = classification(spark, d)
    return E.attach_ujc(cls, cls.select("sampleID", "isoform", "jxn_string")).select("sampleID", "isoform", "jxn_string", "jxnHash")


@add("j10_junction_weights", "SELECT j.sampleID, j.isoform, genomic_start_coord, coalesce(x.w, 1) AS _weight FROM junc j LEFT JOIN weighted x USING (sampleID, isoform)")
def _(spark, d):
    return E.junction_weights(junctions(spark, d), cells_of(spark, d)).select("sampleID", "isoform", "genomic_start_coord", "_weight")


_EXONS = """SELECT DISTINCT concat('S', CAST(l_suppkey % 4 AS VARCHAR(20))) AS sampleID, concat('T', CAST(l_partkey % 300 AS VARCHAR(20))) AS transcript_id,
  concat('chr', CAST(l_partkey % 300 % 22 + 1 AS VARCHAR(20))) AS chrom, '+' AS strand, l_suppkey % 50 * 1000 AS "start", l_suppkey % 50 * 1000 + 300 AS "end"
FROM lineitem"""


@add("a54_ujc_from_gtf", f""", x AS ({_EXONS}), i AS (SELECT *, lead("start") OVER (PARTITION BY sampleID, transcript_id ORDER BY "start", "end") AS nx FROM x)
SELECT sampleID, transcript_id AS isoform,
  concat(chrom, '_', strand, '_', string_agg(concat(CAST("end" + 1 AS VARCHAR), '_', CAST(nx - 1 AS VARCHAR)), '_' ORDER BY "end")) AS jxn_string
FROM i WHERE nx IS NOT NULL GROUP BY sampleID, transcript_id, chrom, strand""")
def _(spark, d):
    exons = spark.sql(_EXONS.replace('"', "`").replace("FROM lineitem", "FROM {t}"), t=spark.read.parquet(f"{d}/lineitem.parquet"))
    return E.ujc_from_gtf(exons)


_GENES = "associated_gene IS NOT NULL GROUP BY ALL"


@add("a50_count_matrix", f"SELECT sampleID, CB, associated_gene, sum(w) AS count FROM cells WHERE {_GENES}")
def _(spark, d):
    return M.count_matrix(cells_of(spark, d))


@add("a50_count_matrix_isoforms", f"SELECT sampleID, CB, associated_gene, sum(w) AS count FROM weighted WHERE {_GENES}")
def _(spark, d):
    return M.count_matrix(weighted_cells(spark, d))


@add("a51_isoform_cell_counts", """SELECT c.sampleID, c.CB, g.isoform, count(*) AS count FROM cells c
JOIN (SELECT sampleID, isoform AS molecule, jxn_string AS isoform FROM cls) g ON c.isoform = g.molecule AND c.sampleID = g.sampleID GROUP BY ALL""")
def _(spark, d):
    groups = classification(spark, d).select("sampleID", F.col("isoform").alias("molecule"), F.col("jxn_string").alias("isoform"))
    return M.isoform_cell_counts(cells_of(spark, d).select("sampleID", F.col("isoform").alias("read_name"), "CB"), groups)


@add("a52_transcript_cell_counts", f"SELECT sampleID, associated_transcript AS isoform, CB, count(*) AS count FROM (SELECT *, {_KIND} AS k FROM cells) WHERE k <> 'novel' GROUP BY ALL")
def _(spark, d):
    reads = cells_of(spark, d).select("sampleID", F.col("associated_transcript").alias("transcript"), F.col("CB").alias("barcode"), F.expr(_KIND).alias("read_type"))
    return M.transcript_cell_counts(reads, ambiguous=True)


@add("a52_transcript_features", """SELECT sampleID, associated_transcript AS transcript, associated_gene AS gene, coding AS transcript_type FROM
(SELECT *, row_number() OVER (PARTITION BY sampleID, associated_transcript ORDER BY isoform DESC) AS rn FROM cells) WHERE rn = 1""")
def _(spark, d):
    reads = cells_of(spark, d).select("sampleID", F.col("associated_transcript").alias("transcript"), F.col("associated_gene").alias("gene"), F.col("coding").alias("transcript_type"), "isoform")
    return M.transcript_features(reads, "isoform")


@add("a53_umi_dedup", """SELECT sampleID, read_name, CB, GE, UB, mapq FROM (SELECT sampleID, isoform AS read_name, CB, associated_gene AS GE, UMI AS UB, exons AS mapq,
  row_number() OVER (PARTITION BY sampleID, CB, associated_gene, UMI ORDER BY exons DESC, isoform) AS rn FROM cells) WHERE rn = 1""")
def _(spark, d):
    tags = {"associated_gene": "GE", "UMI": "UB", "exons": "mapq"}
    return M.umi_dedup(cells_of(spark, d).select("sampleID", F.col("isoform").alias("read_name"), "CB", *(F.col(c).alias(t) for c, t in tags.items())))


@add("s13_mex_triplets", """, t AS (SELECT associated_gene AS isoform, CB, count(*) AS n FROM cells WHERE sampleID = 'S1' GROUP BY ALL)
SELECT dense_rank() OVER (ORDER BY isoform) AS row, dense_rank() OVER (ORDER BY CB) AS col, n AS count FROM t""")
def _(spark, d):
    from isoforge.sources.sinks import mex_triplets

    one = cells_of(spark, d).filter("sampleID = 'S1'")  # a matrix is one sample's
    return mex_triplets(one.groupBy(F.col("associated_gene").alias("isoform"), "CB").agg(F.count("*").alias("count")))


_UJCS = "count(DISTINCT CASE WHEN exons > 1 THEN jxn_string END)"


@add("a60_bulk_totals", f'SELECT sum(w) AS "rows", count(DISTINCT associated_gene) AS genes, {_UJCS} AS ujcs FROM cells')
def _(spark, d):
    return R.bulk_totals(cells_of(spark, d))


@add("a60_bulk_totals_isoforms", 'SELECT sum(w) AS "rows", count(DISTINCT associated_gene) AS genes, CAST(0 AS BIGINT) AS ujcs FROM weighted')
def _(spark, d):
    return R.bulk_totals(weighted_cells(spark, d), "isoforms")


@add("a61_bulk_gene_classes", f"""SELECT *, round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (), 1) AS percent
FROM (SELECT CASE WHEN {NOVEL} THEN 'novel' ELSE 'annotated' END AS kind, count(DISTINCT associated_gene) AS n FROM cells GROUP BY ALL)""")
def _(spark, d):
    return R.bulk_gene_classes(cells_of(spark, d))


def _categories(source: str) -> str:
    return f"SELECT *, round(100.0 * n / sum(n) OVER (), 1) AS percent FROM (SELECT structural_category, sum(w) AS n FROM {source} GROUP BY ALL)"


@add("a62_bulk_category_table", _categories("cells"))
def _(spark, d):
    return R.bulk_category_table(cells_of(spark, d))


@add("a62_bulk_category_table_isoforms", _categories("weighted"))
def _(spark, d):
    return R.bulk_category_table(weighted_cells(spark, d))


_LEVELS = ", ".join(f"({c!r})" for c in C.CATEGORIES)


@add("j15_bulk_category_levels", f"""SELECT c AS structural_category, coalesce(n, 0) AS n FROM (VALUES {_LEVELS}) AS l(c)
LEFT JOIN (SELECT structural_category, sum(w) AS n FROM cells WHERE exons > 6 AND structural_category <> 'fusion' GROUP BY ALL) ON c = structural_category""")
def _(spark, d):
    return R.bulk_category_levels(cells_of(spark, d).filter("exons > 6 AND structural_category <> 'fusion'"))


_WEIGHTED_JUNC = "(SELECT j.*, coalesce(x.w, 1) AS weight FROM junc j LEFT JOIN weighted x USING (sampleID, isoform))"


def _bulk_junctions(n: str, source: str) -> str:
    return f"SELECT *, round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (), 2) AS percent FROM (SELECT {TYPE} AS junction_type, {n} AS n FROM {source} GROUP BY ALL)"


@add("a63_bulk_junction_table", _bulk_junctions("count(*)", "junc"))
def _(spark, d):
    return R.bulk_junction_table(junctions(spark, d))


def weighted_junctions(spark, d):
    return E.junction_weights(junctions(spark, d), cells_of(spark, d))


@add("a63_bulk_junction_table_isoforms", _bulk_junctions("sum(weight)", _WEIGHTED_JUNC))
def _(spark, d):
    return R.bulk_junction_table(weighted_junctions(spark, d), "_weight")


_SUMMARY = f""", s AS ({summary_sql()}), doubles AS (SELECT sampleID, CB, CAST(COLUMNS(* EXCLUDE (sampleID, CB)) AS DOUBLE) FROM s),
long AS (SELECT * FROM (UNPIVOT doubles ON COLUMNS(* EXCLUDE (sampleID, CB)) INTO NAME metric VALUE value))"""
_STATS = """round(avg(value), 3) AS mean, round(quantile_cont(value, 0.5), 3) AS median, round(min(value), 3) AS min, round(max(value), 3) AS max,
round(stddev_samp(value), 3) AS sd"""


def all_metrics(spark, d):
    """The whole summary, long, of values rounded as in a15."""
    return S.long_form(rounded(summary_of(spark, d)))


@add("a64_describe_cells", f"{_SUMMARY} SELECT metric, {_STATS} FROM long GROUP BY metric")
def _(spark, d):
    return R.describe_cells(all_metrics(spark, d))


def _junction_stats(n: str, source: str) -> str:
    percents = grid(f"(SELECT sampleID, CB, {TYPE} AS metric, {n} AS n FROM {source} WHERE CB IS NOT NULL GROUP BY ALL)", KEYS, "metric", C.JUNCTION_TYPES)
    percents = percents.replace("round(", "(").replace(", 6)", ")")
    return f", p AS ({percents}) SELECT metric, {_STATS} FROM (SELECT metric, percent AS value FROM p) GROUP BY metric"


@add("a65_junction_stats", _junction_stats("count(*)", "junc"))
def _(spark, d):
    return R.describe_cells(R.junction_type_percents(junctions(spark, d)))


@add("a65_junction_stats_isoforms", _junction_stats("sum(weight)", _WEIGHTED_JUNC))
def _(spark, d):
    return R.describe_cells(R.junction_type_percents(weighted_junctions(spark, d), "_weight"))


def _share_of_genes(test: str) -> str:
    return prop(f"count(DISTINCT CASE WHEN {test} THEN associated_gene END)", "count(DISTINCT associated_gene)")


@add("a66_gene_annotation_percent", f"""SELECT sampleID, CB, {_share_of_genes(f'NOT {NOVEL}')} AS Annotated_genes_perc,
  {_share_of_genes(NOVEL)} AS Novel_genes_perc FROM cells GROUP BY ALL""")
def _(spark, d):
    return R.gene_annotation_percent(S.key_counts(cells_of(spark, d)))


@add("a67_reads_by_gene_annotation", f"""SELECT sampleID, CB, {prop(w(f'associated_gene IS NOT NULL AND NOT {NOVEL}'), 'sum(w)')} AS annotated_percent,
{prop(w(NOVEL), 'sum(w)')} AS novel_percent FROM cells GROUP BY ALL""")
def _(spark, d):
    return R.reads_by_gene_annotation(cells_of(spark, d))


_GENE_BIN = "CASE WHEN count(*) = 1 THEN '1' WHEN count(*) <= 5 THEN '2-5' WHEN count(*) <= 9 THEN '6-9' ELSE '>=10' END"
_GENE_ROWS = f"(SELECT sampleID, CB, CASE WHEN {NOVEL} THEN 'novel' ELSE 'annotated' END AS kind, {_GENE_BIN} AS bin FROM cells GROUP BY sampleID, CB, associated_gene)"
_GENE_LEVELS = ("1", "2-5", "6-9", ">=10")


@add("a68_gene_bins_report", grid(f"(SELECT sampleID, CB, kind, bin, count(*) AS n FROM {_GENE_ROWS} GROUP BY ALL)", f"{KEYS}, kind", "bin", _GENE_LEVELS))
def _(spark, d):
    return R.gene_bins_report(cells_of(spark, d))


def _combined(test: str) -> str:
    return grid(f"(SELECT sampleID, CB, bin, count(*) AS n FROM {_GENE_ROWS} WHERE {test} GROUP BY ALL)", KEYS, "bin", _GENE_LEVELS)


@add("a68_gene_bins_combined", _combined("kind = 'annotated'"))
def _(spark, d):
    return R.gene_bins_combined(cells_of(spark, d))


@add("a68_gene_bins_combined_isoforms", _combined("true"))
def _(spark, d):
    return R.gene_bins_combined(cells_of(spark, d), "isoforms")


_UJC_BIN = f"""CASE WHEN {_UJCS} = 1 THEN 'ujc_bin1' WHEN {_UJCS} <= 3 THEN 'ujc_bin2_3' WHEN {_UJCS} <= 5 THEN 'ujc_bin4_5' ELSE 'ujc_bin6plus' END"""
_UJC_N = f"""(SELECT sampleID, CB, bin, count(*) AS n
  FROM (SELECT sampleID, CB, {_UJC_BIN} AS bin FROM cells WHERE exons > 1 AND NOT {NOVEL} GROUP BY sampleID, CB, associated_gene) GROUP BY ALL)"""


@add("a69_ujc_bins_report", grid(_UJC_N, KEYS, "bin", [b[0] for b in C.UJC_BINS]))
def _(spark, d):
    return R.ujc_bins_report(cells_of(spark, d))


_CAT = f"{KEYS}, structural_category"


@add("a70_median_exons", f"SELECT {_CAT}, quantile_cont(exons, 0.5) AS median_exons FROM cells GROUP BY ALL")
def _(spark, d):
    return R.median_exons(cells_of(spark, d))


@add("a71_mono_exon_percent", f"SELECT {_CAT}, {prop('count(CASE WHEN exons = 1 THEN 1 END)', 'count(*)')} AS percent FROM cells GROUP BY ALL")
def _(spark, d):
    return R.mono_exon_percent(cells_of(spark, d))


_EXON_BIN = "CASE WHEN exons <= 1 THEN '1' WHEN exons <= 3 THEN '2-3' WHEN exons <= 5 THEN '4-5' ELSE '>=6' END"


@add("a72_exon_bin_percent", grid(f"(SELECT {_CAT}, {_EXON_BIN} AS bin, count(*) AS n FROM cells GROUP BY ALL)", _CAT, "bin", ("1", "2-3", "4-5", ">=6")))
def _(spark, d):
    return R.exon_bin_percent(cells_of(spark, d))


_PROFILE = grid("o", _CAT, "exons", range(1, 21)).replace("round(100.0", "(100.0").replace(", 6)", ")")


@add("a73_exon_profile", f""", r AS (SELECT *, sum(n) OVER (PARTITION BY {_CAT}) AS t
  FROM (SELECT {_CAT}, CAST(least(exons, 20) AS INT) AS exons, count(*) AS n FROM cells GROUP BY ALL)),
o AS (SELECT * EXCLUDE (t, m) FROM (SELECT *, max(t) OVER (PARTITION BY structural_category) AS m FROM r) WHERE m < 5 OR t >= 5), g AS ({_PROFILE})
SELECT structural_category, exons, round(quantile_cont(percent, 0.25), 6) AS q1, round(quantile_cont(percent, 0.5), 6) AS median,
  round(quantile_cont(percent, 0.75), 6) AS q3, round(avg(percent), 6) AS mean, count(*) AS n FROM g GROUP BY ALL""")
def _(spark, d):
    return R.exon_profile(cells_of(spark, d))


def _by_category(n: str, source: str) -> str:
    own = f"(SELECT {_CAT}, {TYPE} AS junction_type, {n} AS n FROM {source} j JOIN (SELECT sampleID, isoform, CB, structural_category FROM cells) c USING (sampleID, isoform, CB) GROUP BY ALL)"
    return grid(own, _CAT, "junction_type", C.JUNCTION_TYPES)


@add("a74_junction_type_by_category", _by_category("count(*)", "junc"))
def _(spark, d):
    return R.junction_type_by_category(cells_of(spark, d), junctions(spark, d))


@add("a74_junction_type_by_category_weighted", _by_category("sum(weight)", _WEIGHTED_JUNC))
def _(spark, d):
    return R.junction_type_by_category(E.row_weights(cells_of(spark, d)), junctions(spark, d), "_weight")


_RTS = "count(CASE WHEN RTS_junction = 'true' THEN 1 END)"


@add("a75_rts_by_junction_type", f"SELECT sampleID, CB, {TYPE} AS junction_type, {prop(_RTS, 'count(*)')} AS percent FROM {JUNCTION_CELLS} GROUP BY ALL")
def _(spark, d):
    return R.rts_by_junction_type(junctions(spark, d))


@add("a76_rts_unique_junctions", f"""SELECT sampleID, CB, junction_type, {prop('count(CASE WHEN r THEN 1 END)', 'count(*)')} AS percent
FROM (SELECT sampleID, CB, {TYPE} AS junction_type, bool_or(RTS_junction = 'true') AS r FROM {JUNCTION_CELLS}
  GROUP BY sampleID, CB, junction_type, chrom, strand, genomic_start_coord, genomic_end_coord) GROUP BY ALL""")
def _(spark, d):
    return R.rts_by_junction_type(junctions(spark, d), unique=True)


_CANON = f"""(SELECT {_CAT}, CASE WHEN all_canonical = 'canonical' THEN 'true' ELSE 'false' END AS status, count(*) AS n
  FROM cells WHERE all_canonical IS NOT NULL GROUP BY ALL)"""


@add("a77_all_canonical_by_category", grid(_CANON, _CAT, "status", ("true", "false")))
def _(spark, d):
    return R.all_canonical_by_category(cells_of(spark, d))


@add("a78_feature_panel", f"{_SUMMARY} SELECT * FROM long WHERE metric LIKE '%prop' AND metric IN (SELECT metric FROM long GROUP BY metric HAVING max(abs(value)) > 0)")
def _(spark, d):
    return R.feature_panel(all_metrics(spark, d), "prop").select("sampleID", "CB", "metric", "value")


@add("a78_feature_panels", f"""{_SUMMARY}, p AS (SELECT metric, arg_max(suffix, len(suffix)) AS panel FROM (SELECT DISTINCT metric FROM long)
  JOIN (VALUES {", ".join(f"('{x}')" for x in R.PANELS)}) AS s(suffix) ON ends_with(metric, suffix) GROUP BY metric)
SELECT panel, sampleID, CB, metric, value FROM long JOIN p USING (metric) WHERE metric IN (SELECT metric FROM long GROUP BY metric HAVING max(abs(value)) > 0)""")
def _(spark, d):
    return R.feature_panels(Saved(spark)(all_metrics(spark, d))).select("panel", "sampleID", "CB", "metric", "value")


_QUART = """round(quantile_cont(value, 0.25), 9) AS q1, round(quantile_cont(value, 0.5), 9) AS median, round(quantile_cont(value, 0.75), 9) AS q3,
round(avg(value), 9) AS mean, count(*) AS n"""


@add("a79_distribution_stats", f"{_SUMMARY} SELECT sampleID, metric, {_QUART} FROM long GROUP BY ALL", places=9)
def _(spark, d):
    return R.distribution_stats(all_metrics(spark, d), ["sampleID", "metric"])


@add("a80_cluster_profile", f"""{_SUMMARY}, k AS (SELECT sampleID, CB, row_number() OVER (PARTITION BY sampleID ORDER BY Reads_in_cell DESC, CB) % 5 AS cluster FROM s)
SELECT CAST(cluster AS INT) AS cluster, metric, {_QUART} FROM long JOIN k USING (sampleID, CB) GROUP BY ALL""", places=9)
def _(spark, d):
    summary = Saved(spark)(rounded(summary_of(spark, d)))  # used twice
    from pyspark.sql import Window as W

    by_size = F.row_number().over(W.partitionBy("sampleID").orderBy(F.desc("Reads_in_cell"), "CB"))
    return R.cluster_profile(S.long_form(summary), summary.select("sampleID", "CB", (by_size % 5).alias("cluster")))


_COHORT_NAMES = ("Reads_in_cell", "UMIs_in_cell", "Genes_in_cell", "UJCs_in_cell")
_COHORT = ", ".join(f"round(avg({n}), 6) AS mean_{n}, CAST(quantile_cont({n}, 0.5) AS DOUBLE) AS median_{n}" for n in _COHORT_NAMES)


@add("a90_cohort_stats", f"{_SUMMARY} SELECT sampleID, count(DISTINCT CB) AS cells, {_COHORT}, round(avg(MT_perc), 6) AS mean_MT_perc FROM s GROUP BY sampleID")
def _(spark, d):
    return H.cohort_stats(rounded(summary_of(spark, d)))


_SHARES = ", ".join(f"'{C.count_name(c)}_prop'" for c in C.CATEGORIES)


@add("a91_category_means", f"{_SUMMARY} SELECT sampleID, metric AS category, round(avg(value), 9) AS mean_percent FROM long WHERE metric IN ({_SHARES}) GROUP BY ALL", places=9)
def _(spark, d):
    return H.category_means(rounded(summary_of(spark, d)))


_MEDIANS = f"{_SUMMARY}, m AS (SELECT sampleID, metric, round(quantile_cont(value, 0.5), 9) AS median FROM long GROUP BY ALL)"


@add("a92_cohort_medians", f"{_MEDIANS} SELECT * FROM m", places=9)
def _(spark, d):
    return H.cohort_medians(all_metrics(spark, d))


@add("a93_varying_features", f"{_MEDIANS} SELECT * FROM m WHERE metric IN (SELECT metric FROM m GROUP BY metric HAVING max(median) > min(median))", places=9)
def _(spark, d):
    return H.drop_constant_features(H.cohort_medians(all_metrics(spark, d))).select("sampleID", "metric", "median")


_SCALED = f"""{_SUMMARY}, r AS (SELECT metric, max(value) AS top, min(value) AS low FROM long GROUP BY metric),
scaled AS (SELECT sampleID, CB, metric,
  CASE WHEN top <= 1.5 AND (low >= 0 OR regexp_matches(lower(metric), 'prop|perc|pct|ratio|fraction')) THEN value * 100 ELSE value END AS value
  FROM long JOIN r USING (metric))"""


@add("p24_scale_to_percent", f"{_SCALED} SELECT sampleID, CB, metric, round(value, 6) AS value FROM scaled")
def _(spark, d):
    return H.scale_to_percent(Saved(spark)(all_metrics(spark, d))).select("sampleID", "CB", "metric", "value")


@add("a94_feature_distribution", f"""{_SCALED} SELECT sampleID, metric, round(avg(value), 11) AS mean, round(quantile_cont(value, 0.5), 11) AS median,
count(DISTINCT value) AS different FROM scaled GROUP BY ALL""", places=11)
def _(spark, d):
    long = Saved(spark)(all_metrics(spark, d))
    return H.feature_distribution(long, long.select("metric").distinct())


@add("a94_top_features")
def _(spark, d):
    """Of the metrics with the largest loadings alone."""
    long = Saved(spark)(all_metrics(spark, d))
    return H.feature_distribution(long, H.top_loadings(H.cohort_pca(H.drop_constant_features(H.cohort_medians(long)))[1]))


@add("a92_sketched_medians", f"{_SUMMARY} SELECT sampleID, metric, round(quantile_disc(value, 0.5), 6) AS median FROM long GROUP BY ALL")
def _(spark, d):
    return Q.sketched_medians(Q.metric_sketches(all_metrics(spark, d)))


@add("t05_cohort_union", f"""{_SUMMARY} SELECT sampleID, CB, metric, round(CASE WHEN sampleID = 'S2' AND metric IN ('UJCs_in_cell', 'MT_perc', 'FSM_prop') THEN 0 ELSE value END, 6) AS value FROM long""")
def _(spark, d):
    """All samples and columns; one sample lacks three of them."""
    own = Saved(spark)(rounded(summary_of(spark, d)))
    samples = [r[0] for r in own.select("sampleID").distinct().orderBy("sampleID").collect()]
    each = [own.filter(F.col("sampleID") == s) for s in samples]
    return S.long_form(H.cohort_union([x.drop("UJCs_in_cell", "MT_perc", "FSM_prop") if s == "S2" else x for s, x in zip(samples, each, strict=True)]))


#: Stand-ins for loadings: each metric's mean over cells and share of the sum, in two components.
_LOADINGS = f"""{_SUMMARY}, l AS (SELECT metric, 'PC' || p AS pc, CASE WHEN p = '1' THEN round(avg(value), 6) ELSE -round(max(value), 6) END AS loading
  FROM long JOIN (VALUES ('1'), ('2')) AS c(p) ON true GROUP BY metric, p),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY pc ORDER BY abs(loading) DESC, metric) AS INT) AS rank FROM l)"""


def _loadings(spark, d):
    each = all_metrics(spark, d).groupBy("metric").agg(F.round(F.avg("value"), 6).alias("a"), (-F.round(F.max("value"), 6)).alias("b"))
    return each.select("metric", F.inline(F.array(F.struct(F.lit("PC1").alias("pc"), F.col("a").alias("loading")), F.struct(F.lit("PC2").alias("pc"), F.col("b").alias("loading")))))


@add("w03_t03_top_loadings", f"{_LOADINGS} SELECT *, CAST(sign(loading) AS INT) AS sign FROM t WHERE rank <= 10")
def _(spark, d):
    return H.top_loadings(_loadings(spark, d))


@add("t07_first_components", f"""{_LOADINGS} SELECT * EXCLUDE (rn) FROM (SELECT *, CAST(sign(loading) AS INT) AS sign,
  row_number() OVER (PARTITION BY metric ORDER BY pc, rank) AS rn FROM t WHERE rank <= 10) WHERE rn = 1""")
def _(spark, d):
    return H.first_components(H.top_loadings(_loadings(spark, d)))


@add("w04_running_shares", """SELECT CAST(exons AS INT) AS pc, round(CAST(n AS DOUBLE) / t, 6) AS share,
  round(sum(CAST(n AS DOUBLE) / t) OVER (ORDER BY exons), 6) AS running
FROM (SELECT exons, count(*) AS n, sum(count(*)) OVER () AS t FROM cells GROUP BY exons)""")
def _(spark, d):
    cells = cells_of(spark, d)
    n = cells.groupBy(F.col("exons").cast("int").alias("pc")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    return H.running_shares(n.join(F.broadcast(total)).select("pc", (F.col("n") / F.col("t")).alias("share")))


_M = "(SELECT sampleID, CB, associated_gene, sum(w) AS n FROM cells WHERE associated_gene IS NOT NULL GROUP BY ALL)"
_LOG = f"SELECT sampleID, CB, associated_gene, ln(1 + n / sum(n) OVER (PARTITION BY sampleID, CB) * 10000) AS x FROM {_M}"


@add("m01_normalize_log1p", f"SELECT sampleID, CB, associated_gene, round(x, 6) AS x FROM ({_LOG})")
def _(spark, d):
    return K.normalize_log1p(M.count_matrix(cells_of(spark, d)))


@add("m02_normalize_sqrt", f"SELECT sampleID, CB, associated_gene, round(sqrt(n), 6) AS x FROM {_M}")
def _(spark, d):
    return K.normalize_sqrt(M.count_matrix(cells_of(spark, d)))


_GRID = f"""g AS (SELECT c.sampleID, c.CB, a.associated_gene FROM (SELECT DISTINCT sampleID, CB FROM {_M}) c CROSS JOIN (SELECT DISTINCT associated_gene FROM {_M}) a)"""


@add("m03_normalize_pearson", f""", {_GRID}, f AS (SELECT g.*, coalesce(n, 0) AS n FROM g LEFT JOIN {_M} USING (sampleID, CB, associated_gene)),
z AS (SELECT *, sum(n) OVER (PARTITION BY sampleID, CB) * sum(n) OVER (PARTITION BY associated_gene) / sum(n) OVER () AS mu,
  sqrt((SELECT count(DISTINCT (sampleID, CB)) FROM g)) AS most FROM f)
SELECT sampleID, CB, associated_gene, round(greatest(least((n - mu) / sqrt(mu + mu * mu / 100), most), -most), 6) AS x FROM z""")
def _(spark, d):
    m = M.count_matrix(cells_of(spark, d))
    return K.normalize_pearson(m, m.select("associated_gene").distinct())


_HVG = f""", x AS ({_LOG}), c AS (SELECT count(DISTINCT (sampleID, CB)) AS n FROM x),
s AS (SELECT associated_gene, sum(x) / any_value(n) AS mean, (sum(x * x) / any_value(n) - (sum(x) / any_value(n)) ** 2) * any_value(n) / (any_value(n) - 1) / (sum(x) / any_value(n)) AS d
  FROM x, c GROUP BY associated_gene),
b AS (SELECT *, least(floor((mean - min(mean) OVER ()) / ((max(mean) OVER () - min(mean) OVER ()) / 20)), 19) AS bin FROM s)
SELECT associated_gene, round(coalesce((d - avg(d) OVER (PARTITION BY bin)) / nullif(stddev_samp(d) OVER (PARTITION BY bin), 0), 0), 6) AS score FROM b"""


@add("m04_highly_variable_genes", _HVG)
def _(spark, d):
    return K.highly_variable_genes(K.normalize_log1p(M.count_matrix(cells_of(spark, d))))


@add("m05_scale_clip", f""", {_GRID}, f AS (SELECT g.*, coalesce(x, 0) AS x FROM g LEFT JOIN ({_LOG}) USING (sampleID, CB, associated_gene))
SELECT sampleID, CB, associated_gene, round(least(coalesce((x - avg(x) OVER (PARTITION BY associated_gene)) / nullif(stddev_samp(x) OVER (PARTITION BY associated_gene), 0), 0), 10), 6) AS x FROM f""")
def _(spark, d):
    x = K.normalize_log1p(M.count_matrix(cells_of(spark, d)))
    return K.scale_clip(K.dense(x, x.select("associated_gene").distinct()))


@add("m03_residual_moments", f""", {_GRID}, f AS (SELECT g.*, coalesce(n, 0) AS n FROM g LEFT JOIN {_M} USING (sampleID, CB, associated_gene)),
z AS (SELECT *, sum(n) OVER (PARTITION BY sampleID, CB) * sum(n) OVER (PARTITION BY associated_gene) / sum(n) OVER () AS mu,
  sqrt((SELECT count(DISTINCT (sampleID, CB)) FROM g)) AS most FROM f)
SELECT associated_gene, round(avg(x), 6) AS mean, round(var_samp(x), 6) AS variance FROM (
  SELECT associated_gene, greatest(least((n - mu) / sqrt(mu + mu * mu / 100), most), -most) AS x FROM z) GROUP BY associated_gene""")
def _(spark, d):
    return P.residual_moments(M.count_matrix(cells_of(spark, d)))


@add("m06_m08_m10_clusters")
def _(spark, d):
    return K.cluster_cells(M.count_matrix(cells_of(spark, d)), method="kmeans")


@add("m06_components")
def _(spark, d):
    x = Saved(spark)(K.normalize_log1p(M.count_matrix(cells_of(spark, d))))  # read several times
    return P.pca_sparse(x, K.highly_variable_genes(x))[1]


def _embedded_cells(spark, d):
    """Embeddings stand for cells' components."""
    own = spark.read.parquet(f"{d}/embeddings.parquet").filter("embedding IS NOT NULL")
    return own.select(F.concat(F.lit("S"), F.col("vec_id") % 4).alias("sampleID"), F.col("vec_id").cast("string").alias("CB"), F.col("embedding").cast("array<double>").alias("pcs"))


_NEAR = """SELECT sampleID, CB, other, rank, round(distance, 6) AS distance FROM (SELECT concat('S', CAST(a.vec_id % 4 AS VARCHAR)) AS sampleID, CAST(a.vec_id AS VARCHAR) AS CB,
  CAST(b.vec_id AS VARCHAR) AS other, distance, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY distance, b.vec_id % 4, CAST(b.vec_id AS VARCHAR)) AS INT) AS rank
  FROM (SELECT a, b, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)) WHERE rank <= 15"""


@add("m07_knn_cells", _NEAR)
def _(spark, d):
    near = K.knn_cells(_embedded_cells(spark, d))
    return near.select("sampleID", "CB", F.col("neighbour.CB").alias("other"), "rank", "distance")


@add("m09_cluster_graph")
def _(spark, d):
    return K.cluster_graph(K.knn_cells(_embedded_cells(spark, d)))


#: Scales by halving, 64 times, as a recursion: the interval of each cell's scale.
_FUZZY = f"""WITH RECURSIVE near AS ({_NEAR.replace("round(distance, 6) AS distance", "distance")}), top AS (SELECT CB, list(distance ORDER BY rank) AS d, coalesce(min(CASE WHEN distance > 0 THEN distance END), 0) AS low FROM near GROUP BY CB),
beyond AS (SELECT CB, d, list_transform(d, lambda x: greatest(x - low, 0)) AS e, log2(len(d)) AS target FROM top),
halves AS (SELECT CB, e, target, CAST(0 AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b, CAST(1 AS DOUBLE) AS s, 0 AS i FROM beyond
  UNION ALL SELECT CB, e, target, CASE WHEN more THEN a ELSE s END, CASE WHEN more THEN s ELSE b END,
    CASE WHEN more THEN (a + s) / 2 WHEN b IS NOT NULL THEN (s + b) / 2 ELSE s * 2 END, i + 1
  FROM (SELECT *, list_sum(list_transform(e, lambda x: exp(-x / s))) > target AS more FROM halves WHERE i < 64)),
scales AS (SELECT h.CB, low, greatest(s, 0.001 * list_avg(d)) AS s FROM halves h JOIN top USING (CB) WHERE i = 64),
directed AS (SELECT CB, other, exp(-greatest(distance - low, 0) / s) AS w FROM near JOIN scales USING (CB)),
pairs AS (SELECT least(CB, other) AS one, greatest(CB, other) AS other, list(w) AS w FROM (
  SELECT concat('S', CAST(CAST(CB AS BIGINT) % 4 AS VARCHAR), ':', CB) AS CB, concat('S', CAST(CAST(other AS BIGINT) % 4 AS VARCHAR), ':', other) AS other, w FROM directed) GROUP BY 1, 2)
SELECT one, other, round(CASE WHEN len(w) > 1 THEN w[1] + w[2] - w[1] * w[2] ELSE w[1] END, 4) AS w FROM pairs"""


@add("m10_fuzzy_graph", places=4)
def _(spark, d):
    name = lambda c: F.concat_ws(":", f"{c}.sampleID", f"{c}.CB").alias(c)
    return G.fuzzy_graph(K.knn_cells(_embedded_cells(spark, d))).select(name("one"), name("other"), "w")


SQL["m10_fuzzy_graph"] = _FUZZY


@add("m11_m12_cohort_loadings")
def _(spark, d):
    medians = H.drop_constant_features(H.cohort_medians(all_metrics(spark, d)))
    return H.top_loadings(H.cohort_pca(medians)[1])
