"""Classification and junction rows from order tables, the same columns for Spark and for the checking engine.

``{name}`` stands for a table. Only this module knows the order tables. For Spark an order line is joined with its order and part
before it becomes rows of samples, so that neither copies nor names of rows are shuffled for it; ``saved_lines`` keeps them for
queries that read them several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.functions.columns import CATEGORIES, SUBCATEGORIES
from isoforge.sources.shared import Saved

_T = "CAST({} AS VARCHAR(20))".format
_CATEGORY = "CASE l_partkey % 9 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CATEGORIES)) + " END"
_SUB = ", ".join(f"({c}, {i}, {len(own)}, '{name}')" for c, own in enumerate(SUBCATEGORIES.values()) for i, name in enumerate(own))
_CENT = "CAST(floor(l_extendedprice) AS BIGINT)"


def _lines(more: str = "") -> str:
    """Order lines as reads of a sample. Every fifth order's lines are reads of the next sample too, with the same
    names and barcodes but other genes, so that a join that forgets the sample gives wrong rows."""
    return f"""(SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS part_id, l_partkey + 3 * u.again AS l_partkey, l_extendedprice, l_quantity, l_tax,
    l_discount, l_linestatus, l_returnflag, {more}concat('S', {_T('(l_suppkey + u.again) % 4')}) AS sampleID,
    concat('r', {_T('l_orderkey')}, '/', {_T('l_linenumber')}, '/', {_T('l_partkey')}, '/', {_T('l_suppkey')}, '/',
      {_T('CAST(round(l_extendedprice * 100) AS BIGINT)')}) AS isoform
  FROM {{lineitem}} JOIN (VALUES (0), (1)) AS u(again) ON u.again = 0 OR l_orderkey % 5 = 0) AS l"""


_CB = f"CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE concat('CB', {_T('l_suppkey')}) END AS CB"
_CHROM = f"CASE WHEN l_partkey % 20 = 0 THEN 'MT' ELSE concat('chr', {_T('l_partkey % 22 + 1')}) END AS chrom"
_STRAND = "CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand"


def _classification(lines: str) -> str:
    return f"""
SELECT isoform, sampleID, {_CB}, {_CHROM}, {_STRAND}, concat('U', {_T('l_orderkey % 400')}) AS UMI,
  {_CATEGORY} AS structural_category, s.name AS subcategory,
  CASE WHEN l_partkey % 7 = 0 THEN concat('novelGene_', {_T('l_partkey % 35')}) ELSE concat('GENE', {_T('l_partkey % 400')}) END AS associated_gene,
  CASE WHEN l_partkey % 9 IN (0, 1) THEN concat('TX', {_T('l_partkey % 90')}) ELSE 'novel' END AS associated_transcript,
  CAST(l_linenumber AS DOUBLE) AS exons, CAST(CAST(l_quantity * 60 AS INT) AS DOUBLE) AS length, CAST(p_size * 60 AS DOUBLE) AS ref_length,
  CASE WHEN l_returnflag = 'R' THEN 'TRUE' ELSE 'FALSE' END AS RTS_stage,
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_returnflag = 'A' THEN 'non_canonical' ELSE 'canonical' END AS all_canonical,
  CAST(l_tax * 1000 AS DOUBLE) AS perc_A_downstream_TTS, CAST(CAST(round(l_discount * 1000) AS INT) - 20 AS DOUBLE) AS diff_to_gene_TSS,
  concat('J', {_T('l_partkey % 60')}, '_', {_T('l_linenumber')}) AS jxn_string, concat('H', {_T('l_partkey % 60')}, '_', {_T('l_linenumber')}) AS jxnHash,
  CASE WHEN l_orderkey % 3 = 0 THEN 'non_coding' ELSE 'coding' END AS coding,
  CASE WHEN {_CENT} % 6 = 1 THEN 'TRUE' ELSE 'FALSE' END AS predicted_NMD,
  CASE WHEN l_suppkey % 4 = 1 OR l_linenumber = 2 THEN 'TRUE' ELSE 'FALSE' END AS within_CAGE_peak,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber % 3 = 0 THEN 'TRUE' ELSE 'FALSE' END AS polyA_motif_found,
  CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_orderkey % 4 AS DOUBLE) END AS min_cov,
  CASE WHEN l_orderkey % 8 = 0 THEN NULL ELSE CAST({_CENT} % 5 AS DOUBLE) END AS ratio_TSS,
  CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE concat({_T('l_linenumber')}, ',', {_T('l_orderkey % 6')}) END AS FL
FROM {lines}
LEFT JOIN (VALUES {_SUB}) AS s(c, i, n, name) ON s.c = l_partkey % 9 AND s.i = l_orderkey % s.n
"""


CLASSIFICATION = _classification(f"{_lines()} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON part_id = p_partkey")

_D, _E = "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE (l_orderkey + k) % 5 - 2 END", "(l_suppkey + k) % 3 - 1"
_AT = "(l_partkey % 60) * 10000 + k * 500"


def _junctions(lines: str) -> str:
    return f"""
SELECT isoform, sampleID, {_CB}, {_CHROM}, {_STRAND},
  {_AT} - coalesce({_D}, 0) AS genomic_start_coord, {_AT} + 200 - ({_E}) AS genomic_end_coord,
  {_D} AS diff_to_Ref_start_site, {_E} AS diff_to_Ref_end_site,
  CASE WHEN {_D} = 0 THEN 'known' ELSE 'novel' END AS junction_category,
  CASE WHEN (l_orderkey + k) % 13 = 0 THEN 'non_canonical' ELSE 'canonical' END AS canonical,
  CASE WHEN l_returnflag = 'R' AND k % 2 = 0 THEN 'true' ELSE 'false' END AS RTS_junction
FROM {lines} JOIN (VALUES (1), (2), (3), (4), (5), (6)) AS t(k) ON k < l_linenumber
"""


JUNCTIONS = _junctions(f"{_lines()} JOIN {{orders}} ON l_orderkey = o_orderkey")

#: Isoforms mode: an isoform of each sample in each cell, weighted.
ISOFORMS = f"""
SELECT sampleID, concat('i', {_T('l_partkey % 500')}) AS isoform, concat('CB', {_T('l_suppkey')}) AS CB, count(*) AS n
FROM {_lines()} GROUP BY sampleID, concat('i', {_T('l_partkey % 500')}), concat('CB', {_T('l_suppkey')})
"""


def for_sql(template: str) -> str:
    return template.format(lineitem="lineitem", orders="orders", part="part")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.expr("l_orderkey = o_orderkey"))


#: What only some queries need of a line, and the columns that are made of it.
_OF_LINE = {
    "l_quantity": ["length"], "l_tax": ["perc_A_downstream_TTS"], "l_discount": ["diff_to_gene_TSS"], "l_returnflag": ["RTS_stage", "all_canonical", "RTS_junction"],
    "l_extendedprice": ["predicted_NMD", "ratio_TSS"],
}


def saved_lines(spark: SparkSession, sf_dir: str, names_only: bool = False) -> DataFrame:
    """Order lines with their order and ``parts``, a list of what their part gives, empty for none: joined and written once.

    ``names_only`` leaves out what names, genes and junctions are not made of; columns made of it are then missing too.
    """
    parts = _table(spark, sf_dir, "part").groupBy("p_partkey").agg(F.collect_list(F.struct("p_size")).alias("parts"))
    columns = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_linestatus", *(["l_extendedprice"] if names_only else _OF_LINE)]
    return Saved(spark)(_with_orders(spark, sf_dir).join(parts, F.expr("l_partkey = p_partkey"), "left").select(*columns, "o_custkey", "parts"))


def _of_lines(lines: DataFrame, template: str) -> DataFrame:
    missing = {c: made for c, made in _OF_LINE.items() if c not in lines.columns}
    lines = lines.withColumns({c: F.lit(None).cast("string" if c == "l_returnflag" else "double") for c in missing})
    return lines.sparkSession.sql(template, lineitem=lines).drop(*missing, *(x for made in missing.values() for x in made))


def by_row(lines: DataFrame) -> DataFrame:
    """Lines as reads of samples, shuffled by their names: joins of what is made of them by name shuffle nothing more. Their price is left out.

    The counts need all columns, so that each use takes the same ones and Spark shuffles once for all uses.
    """
    own = _of_lines(lines, f"SELECT * FROM {_lines('o_custkey, parts, ')}").drop("part_id", "l_extendedprice").repartition("sampleID", "isoform")
    return own.observe("reads", *(F.count(c).alias(c) for c in own.columns))


def classification(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """``lines``: those of ``saved_lines``, else they are joined anew."""
    if lines is None:
        lines = _with_orders(spark, sf_dir).join(_table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.expr("l_partkey = p_partkey"))
    else:
        lines = lines.select("*", F.inline("parts"))
    return _of_lines(lines, _classification(_lines("o_custkey, p_size, ") if "sampleID" not in lines.columns else "{lineitem}"))


def junctions(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = _with_orders(spark, sf_dir) if lines is None else lines
    return _of_lines(lines, _junctions(_lines("o_custkey, ") if "sampleID" not in lines.columns else "{lineitem}"))


def isoform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ISOFORMS, lineitem=_table(spark, sf_dir, "lineitem"))
