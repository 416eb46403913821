"""Hand-computed cases of the per-cell operators."""

import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.operators import cell_summary as S
from isoforge.operators import cell_tables as T
from isoforge.operators import clustering as K
from isoforge.operators import cohort as H
from isoforge.operators import enrich as E
from isoforge.operators import matrix as M
from isoforge.operators import report_tables as R
from isoforge.operators.explode import explode_cells, unequal_lists
from isoforge.plans.run import enriched, run_qc
from isoforge.plans.tables import Buckets
from isoforge.sources import sinks, text
from test_bam import record, write_bam

JUNCTIONS = "sampleID string, isoform string, chrom string, strand string, genomic_start_coord long, genomic_end_coord long, diff_to_Ref_start_site double, diff_to_Ref_end_site double"
BASE = {"sampleID": "S", "CB": "C1", "UMI": "U", "chrom": "chr1", "strand": "+", "structural_category": "genic"}


def classification(spark, rows):
    df = spark.createDataFrame([{"isoform": f"i{n}"} | {k: str(v) for k, v in (BASE | r).items() if v is not None} for n, r in enumerate(rows)], ", ".join(f"{c} string" for c in ["sampleID", *text.STRINGS, *text.NUMBERS]))
    return text.conform(df, text.STRINGS, text.NUMBERS)


def test_isoform_lists_keep_weights(spark):
    cls = classification(spark, [{"CB": "CELL1,CELL2", "FL": "3,5"}, {"CB": "CELL2", "FL": "2"}, {"CB": "A,B", "FL": None}, {"CB": "A,B", "FL": "1"}])
    got = {r["CB"]: r["w"] for r in explode_cells(cls, "isoforms").groupBy("CB").agg(F.sum("_count").alias("w")).collect()}
    assert got == {"CELL1": 3, "CELL2": 7, "A": 1, "B": 1}
    assert unequal_lists(cls).count() == 1
    odd = classification(spark, [{"CB": "A,B", "FL": "1"}, {"CB": "c1,, c2,unassigned,NA"}, {"CB": None}, {"CB": "A", "FL": "x"}])
    watch = Observation("lists")
    got = [(r["CB"], r["_count"]) for r in explode_cells(odd, "isoforms", watch).collect()]
    assert sorted(got) == [("A", 1), ("c1", 1), ("c2", 1)]
    assert watch.get == {"rows": 8, "unequal": 1, "without_cell": 1, "invalid_cell": 3}


def test_no_valid_barcode_gives_no_cells(spark):
    cells = explode_cells(classification(spark, [{"CB": ""}, {"CB": "NA"}, {"CB": "unassigned"}]))
    assert cells.count() == 0
    assert S.cell_summary(cells, text.read_junctions(spark)).count() == 0


def test_edges_of_bins_and_cutoffs(spark):
    rows = [{"length": x} for x in (250, 251, 500, 501, 1000, 1001, 2000, 2001)]
    cells = explode_cells(classification(spark, rows))
    got = S.length_bin_props(S.category_sums(cells)).first()
    assert [got[f"Total_{n}_length_prop"] for n in ("250b", "500b", "short", "mid", "long")] == [12.5, 25.0, 25.0, 25.0, 12.5]
    at = classification(spark, [{"perc_A_downstream_TTS": 60, "diff_to_gene_TSS": -50, "min_cov": 1, "ratio_TSS": 2.0, "length": 45, "ref_length": 100}, {"ref_length": 0, "length": 5}])
    tests = C.quality_predicates()
    first, second = at.select(*(tests[k].alias(k) for k in ("intrapriming", "tss", "cov", "ratio")), C.ref_body_covered().alias("r")).collect()
    assert all(first) and second["r"] and not second["tss"]


def test_unknown_exons_are_not_mono(spark):
    cells = explode_cells(classification(spark, [{"exons": None}, {"exons": 1}, {"exons": 2}]))
    assert S.cell_totals(cells, S.category_sums(cells)).first()["total_reads_no_monoexon"] == 2


def test_majority_tie_takes_the_smaller(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("l", "c"), ("l", "c"), ("l", None)], "k string, v string")
    assert {r["k"]: r["v"] for r in T.majority_value(df, ["k"], "v").collect()} == {"k": "a", "l": "c"}


def test_variation_of_single_and_equal_junctions(spark):
    cells = explode_cells(classification(spark, [{"associated_gene": "g"}, {"associated_gene": "novel1"}]))
    rows = [("S", "i0", "chr1", "+", 100, 200, 2.0, 0.0), ("S", "i1", "chr1", "+", 100, 300, 2.0, 1.0), ("T", "i0", "chr1", "+", 100, 200, 9.0, 9.0)]
    junctions = spark.createDataFrame(rows, JUNCTIONS).withColumn("CB", F.lit(None).cast("string"))
    got = {(r["coord"], r["flag_donor"]): r for r in T.junction_cv_by_cell(cells, junctions).collect()}
    both, zero = got[102, 1], got[200, 0]
    assert (both["cv"], both["flag_cv_0"], both["flag_multi_gene"], both["flag_annotated_gene"], both["associated_gene"]) == (0.0, 1, 1, 0, "g|novel1")
    assert (zero["cv"], zero["std_abs_diff"], zero["flag_ref_match"], zero["flag_std_0"]) == (None, None, 1, 0)


def test_duplicates_take_their_primary(spark):
    """The primary counts when it is in the association, whether or not it is in the table; samples are apart."""
    names = [("S", n) for n in ("r", "r_dup1", "q_dup1", "p_dup2", "o_dup1")] + [("T", "r_dup1")]
    cls = spark.createDataFrame([(*n, "x", "u") for n in names], "sampleID string, isoform string, CB string, UMI string")
    rows = [("S", "r", "c1", "u1"), ("S", "q_dup1", "c2", "u2"), ("S", "q", "c3", "u3"), ("S", "p_dup2", "c4", "u4"), ("S", "o", None, None), ("S", "o_dup1", "c5", "u5"), ("T", "r_dup1", "c6", "u6")]
    assoc = spark.createDataFrame(rows, "sampleID string, isoform string, CB string, UMI string")
    got = {(r["sampleID"], r["isoform"]): r["CB"] for r in E.annotate_cells_reads(cls, assoc).collect()}
    assert got == {("S", "r"): "c1", ("S", "r_dup1"): "c1", ("S", "q_dup1"): "c3", ("S", "p_dup2"): "c4", ("S", "o_dup1"): None, ("T", "r_dup1"): "c6"}


def test_two_samples_with_the_same_names_stay_apart(spark):
    rows = [
        {"sampleID": s, "associated_gene": f"g{s}", "jxn_string": "j", "jxnHash": "h", "exons": 2, "structural_category": c, "FL": fl}
        for s, c, fl in (("S", "genic", "2"), ("T", "fusion", "5"))
    ]
    cls = classification(spark, rows).withColumn("isoform", F.lit("PB.1"))
    cells = explode_cells(cls)
    made = [(s, "PB.1", "chr1", "+", 100, 200, 0.0, 0.0) for s in ("S", "T", "T")]
    junctions = spark.createDataFrame(made, JUNCTIONS).withColumns({"CB": F.lit("C1"), "junction_category": F.lit("known"), "canonical": F.lit("canonical"), "RTS_junction": F.lit("F")})
    by_sample = lambda df, *c: sorted(tuple(r[x] for x in ("sampleID", *c)) for r in df.collect())
    assert by_sample(T.ujc_counts_by_cell(cells, junctions), "associated_gene", "known_canonical") == [("S", "gS", 1), ("T", "gT", 2)]
    assert by_sample(T.junction_cv_by_cell(cells, junctions), "count") == [("S", 1), ("S", 1), ("T", 2), ("T", 2)]
    assert by_sample(R.junction_type_by_category(cells, junctions).filter("n > 0"), "structural_category", "n") == [("S", "genic", 1), ("T", "fusion", 2)]
    assert by_sample(E.junction_cells_fallback(junctions, cells), "CB") == [("S", "C1"), ("T", "C1"), ("T", "C1")]
    assert by_sample(E.junction_weights(junctions, cls), "_weight") == [("S", 2.0), ("T", 5.0), ("T", 5.0)]
    assert by_sample(E.attach_ujc(cls, cls.select("sampleID", "isoform", "jxn_string")), "jxn_string") == [("S", "j"), ("T", "j")]
    m = M.count_matrix(cells)
    assert by_sample(K.normalize_log1p(m), "associated_gene") == [("S", "gS"), ("T", "gT")]
    assert by_sample(K.dense(m, m.select("associated_gene"), "count"), "count") == [("S", 0.0), ("S", 1.0), ("T", 0.0), ("T", 1.0)]
    long = S.long_form(S.cell_summary(cells, junctions).select("sampleID", "CB", "Reads_in_cell", "total_junctions"))
    clusters = spark.createDataFrame([("S", "C1", 0), ("T", "C1", 1)], "sampleID string, CB string, cluster int")
    got = {(r["cluster"], r["metric"]): (r["mean"], r["n"]) for r in R.cluster_profile(long, clusters).collect()}
    assert got[0, "total_junctions"] == (1.0, 1) and got[1, "total_junctions"] == (2.0, 1)


def test_summary_names_by_mode(spark):
    cells = explode_cells(classification(spark, [{"exons": 2, "jxn_string": "j", "associated_gene": "g"}]))
    junctions = text.read_junctions(spark)
    reads, isoforms = S.cell_summary(cells, junctions), S.cell_summary(cells, junctions, "isoforms", skip_orf=True)
    assert {"Reads_in_cell", "UMIs_in_cell", "UJCs_in_cell", "total_reads_no_monoexon", "MT_reads_count"} <= set(reads.columns)
    assert {"Transcripts_in_cell", "total_transcripts_no_monoexon", "MT_transcripts_count"} <= set(isoforms.columns)
    assert not {"UMIs_in_cell", "UJCs_in_cell", "FSM_NMD_prop"} & set(isoforms.columns) and isoforms.first()["FSM_non_coding_prop"] == 100


def test_readers(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("#note\nid\tcell_barcode\tumi\nr1\tA\tx\nr1\tB\ty\nr2\tC\tz\n")
    assert {r["isoform"]: (r["CB"], r["UMI"]) for r in text.read_cell_association_reads(spark, str(tmp_path / "a.tsv")).collect()} == {"r1": ("B", "y"), "r2": ("C", "z")}
    (tmp_path / "bad.tsv").write_text("id\tother\nr\tx\n")
    with pytest.raises(ValueError):
        text.read_cell_association_reads(spark, str(tmp_path / "bad.tsv"))
    (tmp_path / "lists.tsv").write_text("isoform_id\tCBs\ni1\tA,B\ni1\tC\ni2\t\n")
    (tmp_path / "bare.tsv").write_text("i1\tA,B\ni2\tC\n")
    assert [tuple(r)[1:] for r in text.read_cell_association_isoforms(spark, str(tmp_path / "lists.tsv")).collect()] == [("i1", "C")]
    assert {tuple(r)[1:] for r in text.read_cell_association_isoforms(spark, str(tmp_path / "bare.tsv")).collect()} == {("i1", "A,B"), ("i2", "C")}
    tags = spark.createDataFrame([("S", "r1", "A", "x", None), ("S", "r2", "B", None, "y"), ("S", "r1", "C", "z", None), ("S", "r3", None, "x", None)], "sampleID string, read_name string, CB string, XM string, UB string").coalesce(1)
    assert [tuple(r)[1:] for r in text.read_tagged_reads(tags).collect()] == [("r1", "C", "z")]
    assert {r["isoform"] for r in text.read_tagged_reads(tags, ("XM", "UB")).collect()} == {"r1", "r2"}
    (tmp_path / "reads.sam").write_text("@HD\tVN\n" + "\t".join(["read1", *["x"] * 10, "NM:i:0", "CB:Z:AAA", "CB:Z:BBB"]) + "\nread2\tx\n")
    assert [tuple(r)[1:] for r in text.read_sam_text(spark, str(tmp_path / "reads.sam")).collect()] == [("read1", "AAA")]
    (tmp_path / "g.gtf").write_text('chr1\ts\texon\t10\t20\t.\t+\t.\tgene_id "g"; transcript_id "t";\nchr1\ts\texon\t31\t40\t.\t+\t.\tgene_id "g"; transcript_id "t";\n')
    got = E.ujc_from_gtf(text.read_gtf(spark, str(tmp_path / "g.gtf"))).first()
    assert (got["sampleID"], got["jxn_string"]) == ("g", "chr1_+_21_30")
    (tmp_path / "groups.txt").write_text("i1\tm1,m2\ni2\tm2\nshort\n")
    assert {tuple(r)[1:] for r in text.read_group_file(spark, str(tmp_path / "groups.txt")).collect()} == {("m1", "i1"), ("m2", "i2")}
    fields = ["read", "gene", "x", "bc", *["x"] * 5, "known", "x", "tx"]
    (tmp_path / "S7.UMI_filtered.ED4.allinfo").write_text("\t".join(fields) + "\n" + "\t".join([*fields, "coding"]) + "\nshort\n")
    assert sorted((r["sampleID"], r["transcript"], r["transcript_type"]) for r in text.read_allinfo(spark, str(tmp_path / "S7.UMI_filtered.ED4.allinfo")).collect()) == [("S7", "tx", "coding"), ("S7", "tx", "unknown")]


def test_last_rows_follow_the_order_of_files(spark, tmp_path):
    """Large files come first in Spark's partitions; a repeated id takes the last row all the same."""
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.tsv").write_text("id\tcell_barcode\n" + "".join(f"r{i}\told\n" for i in range(5000)))
    (folder / "b.tsv").write_text("id\tcell_barcode\nr7\tnew\n")
    manifest = spark.createDataFrame([("S", str(folder / "a.tsv")), ("S", str(folder / "b.tsv"))], "sampleID string, cell_association string")
    got = text.read_cell_association_reads(spark, str(folder), manifest).filter("isoform IN ('r7', 'r8')").collect()
    assert {r["isoform"]: r["CB"] for r in got} == {"r7": "new", "r8": "old"}


def test_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text("sampleID,file_acc\ns,f\n")
    with pytest.raises(ValueError, match="s: no cell association"):
        text.read_manifest(spark, str(tmp_path / "m.csv"))
    (tmp_path / "f_cell_association.txt").write_text("id\tcell_barcode\n")
    row = text.read_manifest(spark, str(tmp_path / "m.csv"), input_dir=str(tmp_path), out_dir="/d").first()
    assert row["cell_association"].endswith("f_cell_association.txt") and row["classification_file"] == "/d/f/s_classification.txt"
    (tmp_path / "n.csv").write_text("sampleID\ns\n")
    with pytest.raises(ValueError, match="file_acc"):
        text.read_manifest(spark, str(tmp_path / "n.csv"))


def _write_sample(folder, sample, gene, mode):
    (folder / f"acc{sample}").mkdir(parents=True)
    own = folder / f"acc{sample}"
    extra = "" if sample == "S1" else "\tRTS_stage"
    names = ["PB.1", "PB.1_dup1", "PB.2"]
    lines = [f"{n}\tchr1\t+\t{gene}\tgenic\t{e}\tj{n[3]}\th{n[3]}" + ("" if sample == "S1" else "\tTRUE") for n, e in zip(names, (2, 2, 1), strict=True)]
    (own / f"{sample}_classification.txt").write_text(f"isoform\tchrom\tstrand\tassociated_gene\tstructural_category\texons\tjxn_string\tjxnHash{extra}\n" + "\n".join(lines) + "\n")
    (own / f"{sample}_junctions.txt").write_text(
        "isoform\tchrom\tstrand\tgenomic_start_coord\tgenomic_end_coord\tjunction_category\tcanonical\tdiff_to_Ref_start_site\tdiff_to_Ref_end_site\n"
        "PB.1\tchr1\t+\t100\t200\tknown\tcanonical\t0\t0\n"
    )
    path = folder / f"acc{sample}_cell_association.txt"
    path.write_text("id\tcell_barcode\tumi\nPB.1\tC1\tu1\nPB.2\tC2\tu2\n" if mode == "reads" else "pbid\tcell_barcodes\nPB.1\tC1,C2\nPB.2\tC2\n")


@pytest.mark.parametrize("mode", ["reads", "isoforms"])
def test_a_run_from_files(spark, tmp_path, mode):
    for sample, gene in (("S1", "gA"), ("S2", "novel_1")):
        _write_sample(tmp_path, sample, gene, mode)
    (tmp_path / "design.csv").write_text("sampleID,file_acc\nS1,accS1\nS2,accS2\n")
    run_qc(spark, str(tmp_path / "design.csv"), str(tmp_path / "out"), mode, str(tmp_path), str(tmp_path))
    got = {(r["sampleID"], r["CB"]): r for r in text.read_cell_summaries(spark, str(tmp_path / "out/cell_summary")).collect()}
    assert set(got) == {(s, c) for s in ("S1", "S2") for c in ("C1", "C2")}
    if mode == "reads":
        assert [got["S1", c]["Reads_in_cell"] for c in ("C1", "C2")] == [2, 1] and got["S1", "C1"]["UMIs_in_cell"] == 1
        assert got["S2", "C1"]["RTS_prop_in_cell"] == 100 and got["S1", "C1"]["RTS_prop_in_cell"] == 0
    else:
        assert [got["S1", c]["Transcripts_in_cell"] for c in ("C1", "C2")] == [1, 2]
        assert got["S1", "C2"]["total_junctions"] == 1
    assert got["S2", "C1"]["Novel_genes"] == 1 and got["S1", "C1"]["Known_canonical_junctions"] == 1
    genes = spark.read.option("header", True).csv(str(tmp_path / "out/gene_counts")).collect()
    assert {(r["sampleID"], r["associated_gene"]) for r in genes} == {("S1", "gA"), ("S2", "novel_1")}
    back = text.read_classification(spark, str(tmp_path / "out/classification")).collect()
    assert {r["CB"] for r in back if r["isoform"] == "PB.1_dup1"} == ({"C1"} if mode == "reads" else {None})
    assert spark.read.option("header", True).csv(str(tmp_path / "out/junction_cv")).count() == (4 if mode == "reads" else 8)


def run_counts(spark, folder):
    return {(r["input"], r["what"]): int(r["n"]) for r in spark.read.option("header", True).csv(f"{folder}/run_counts").collect()}


def test_a_run_leaves_out_invalid_cells_and_says_so(spark, tmp_path):
    """Isoforms of lists and of matrices: blank, empty and unassigned barcodes are no cells; lines too short and entries out of range are counted."""
    for sample in ("S1", "S2"):
        _write_sample(tmp_path, sample, "gA", "isoforms")
    (tmp_path / "accS1_cell_association.txt").write_text("pbid\tcell_barcodes\nPB.1\tc1,, c2,unassigned,NA\nPB.2\tc2\n")
    with (tmp_path / "accS1/S1_classification.txt").open("a") as f:
        f.write("PB.9\tchr1\n")
    folder = tmp_path / "matrix"
    folder.mkdir()
    (folder / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n%\n2 2 4\n1 1 3\n1 2 4\n2 2 5\n7 1 9\n")
    (folder / "features.tsv").write_text("PB.1\tx\nPB.2\ty\n")
    (folder / "barcodes.tsv").write_text("c1\nunassigned\n")
    (tmp_path / "design.csv").write_text(f"sampleID,file_acc,abundance\nS1,accS1,\nS2,accS2,{folder}\n")
    summary = run_qc(spark, str(tmp_path / "design.csv"), str(tmp_path / "out"), "isoforms", str(tmp_path), str(tmp_path), buckets=3)
    assert {(r["sampleID"], r["CB"]): r["Transcripts_in_cell"] for r in summary.collect()} == {("S1", "c1"): 1, ("S1", "c2"): 2, ("S2", "c1"): 3}
    counts = run_counts(spark, tmp_path / "out")
    assert counts["classification", "rows"] == 7 and counts["classification", "short"] == 1
    assert counts["abundance", "rows"] == 4 and counts["abundance", "out_of_range"] == 1
    assert counts["junctions", "rows"] == 2


def test_a_run_with_bam_clusters_and_cohort(spark, tmp_path, monkeypatch):
    """Reads of BAM and of text associations in one run; each text input is scanned once, whatever the number of samples."""
    for sample, gene in (("S1", "gA"), ("S2", "novel_1")):
        _write_sample(tmp_path, sample, gene, "reads")
    write_bam(tmp_path / "accS1.bam", [record(n, [("CB", "Z", c), ("XM", "Z", "u")]) for n, c in (("PB.1", "C1"), ("PB.2", "C2"))], [500])
    (tmp_path / "accS1/S1_corrected.gtf").write_text("".join(f'chr1\ts\texon\t{a}\t{b}\t.\t+\t.\tgene_id "g"; transcript_id "PB.1";\n' for a, b in ((10, 20), (31, 40))))
    (tmp_path / "design.csv").write_text("sampleID,file_acc\nS1,accS1\nS2,accS2\n")
    own = text.read_manifest(spark, str(tmp_path / "design.csv"), "reads", str(tmp_path), str(tmp_path))
    plan = enriched(spark, own, "reads").rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("classification.txt") <= 1 or plan.count("Relation [value") <= 4
    summary = run_qc(spark, str(tmp_path / "design.csv"), str(tmp_path / "out"), "reads", str(tmp_path), str(tmp_path), cohort=True, clustering={"n_pc": 2, "n_neighbours": 2})
    got = {(r["sampleID"], r["CB"]): r["Reads_in_cell"] for r in summary.collect()}
    assert got == {("S1", "C1"): 2, ("S1", "C2"): 1, ("S2", "C1"): 2, ("S2", "C2"): 1}
    table = lambda name: spark.read.option("header", True).csv(str(tmp_path / "out" / name))
    assert table("clustering").count() == 4 and {"cohort_stats", "cohort_scores", "cohort_features"} <= {p.name for p in (tmp_path / "out").iterdir()}
    assert table("cohort_scores").count() == 2 and table("cohort_medians").count() > 300
    back = text.read_classification(spark, str(tmp_path / "out/classification")).collect()
    assert {r["jxn_string"] for r in back if r["sampleID"] == "S1" and r["isoform"] == "PB.1"} == {"chr1_+_21_30"}


def test_bucketed_tables_are_joined_and_grouped_in_place(spark):
    rows = [{"associated_gene": f"g{i % 3}", "jxn_string": "j", "jxnHash": f"h{i % 4}", "exons": 2, "CB": f"C{i % 5}"} for i in range(40)]
    cells = explode_cells(classification(spark, rows))
    made = [("S", f"i{i}", "chr1", "+", 100, 200, 0.0, 0.0) for i in range(40)]
    junctions = spark.createDataFrame(made, JUNCTIONS).withColumns({"CB": F.lit("C1"), "junction_category": F.lit("known"), "canonical": F.lit("canonical"), "RTS_junction": F.lit("F")})
    keep = Buckets(spark, 3)
    by_cell, by_row, own = keep(cells, "cells", ["sampleID", "CB"]), keep(cells, "rows", ["sampleID", "isoform"]), keep(junctions, "junctions", ["sampleID", "isoform"])

    def exchanges(df):
        df.collect()
        return re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = {tuple(r) for r in S.cell_summary(cells, junctions).collect()}
        assert {tuple(r) for r in S.cell_summary(by_cell, own, placed=True).collect()} == plain
        assert exchanges(S.category_sums(by_cell, placed=True)) == exchanges(S.key_counts(by_cell, placed=True)) == exchanges(T.gene_counts_by_cell(by_cell)) == []
        for df in (T.ujc_counts_by_cell(by_cell, own, placed=True, by_row=by_row), T.junction_cv_by_cell(by_row, own)):
            # Chains, genes and coordinates are keys of their own; neither rows by name nor cells are shuffled.
                assert not any("isoform" in keys or re.match(r"sampleID#\d+, CB#\d+, \d+$", keys) for keys in exchanges(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        keep.drop()


def test_matrix_round_trip(spark, tmp_path):
    counts = spark.createDataFrame([("b", "y", 2.0), ("a", "x", 1.0), ("b", "x", 3.0)], "isoform string, CB string, count double")
    sinks.write_mex(counts.repartition(3), str(tmp_path / "m"))
    assert {tuple(r)[1:] for r in text.read_mex(spark, str(tmp_path / "m")).collect()} == {("b", "y", 2.0), ("a", "x", 1.0), ("b", "x", 3.0)}
    assert (tmp_path / "m/matrix.mtx").read_text().split("\n")[1:3] == ["2 2 3", "1 1 1"] and (tmp_path / "m/features.tsv").read_text() == "a\nb\n"
    large = spark.range(3000).select(F.format_string("i%04d", F.col("id")).alias("isoform"), F.concat(F.lit("c"), F.col("id") % 7).alias("CB"), (F.col("id") + 1.0).alias("count"))
    large.repartition(5).createOrReplaceTempView("large")
    sinks.write_mex(spark.table("large"), str(tmp_path / "n"))
    assert {tuple(r)[1:] for r in text.read_mex(spark, {"S": str(tmp_path / "n"), "T": str(tmp_path / "m")}).filter("sampleID = 'S'").collect()} == {tuple(r) for r in large.collect()}
    broken = counts.withColumn("count", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        sinks.write_mex(broken, str(tmp_path / "broken"))
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("broken")]


def test_junction_labels(spark):
    frame = lambda names: spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"{n} string" for n in names))
    for names, label in ((["junctionLabel"], "1"), (["chrom", "strand", "genomic_start", "genomic_end"], "1_1_1_1"), (["junction_id"], "1"), (["x"], None)):
        df = frame(names)
        got = df.select(R.label_of(df).alias("l")).first()["l"]
        assert got == label or label is None and got.isdigit()


def test_long_tables_are_computed_once(spark):
    """The rows that a panel or the varying medians come from are read from saved files, not made again for each use."""
    seen = spark.sparkContext.accumulator(0)
    rows = [(f"S{i % 2}", f"C{i}", m, float(i)) for i in range(10) for m in ("a_prop", "b")]

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    long = spark.createDataFrame(rows, "sampleID string, CB string, metric string, value double")
    watched = long.mapInArrow(counted, long.schema)
    assert R.feature_panel(watched, "prop").count() == 10 and seen.value == 20
    medians = watched.groupBy("sampleID", "metric").agg(F.percentile("value", F.lit(0.5)).alias("median"))
    kept = H.drop_constant_features(medians)
    assert kept.count() == 4 and kept.select("metric").distinct().count() == 2 and seen.value == 40


def test_rows_are_shuffled_by_cell_before_sums(spark):
    """One exchange by cell for each, of rows and not of partial sums."""
    cells = explode_cells(classification(spark, [{}, {"CB": "C2"}]))
    for made in (S.category_sums(cells), S.key_counts(cells)):
        plan = made._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("Exchange") == 1
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_junctions_are_counted_before_they_are_joined(spark):
    """One join, of one row for each read; weights of rows or of their junctions give the same."""
    cells = spark.createDataFrame([("S", "r1", "C1", "genic", 2.0), ("S", "r2", "C1", "genic", 3.0)], "sampleID string, isoform string, CB string, structural_category string, _weight double")
    own = spark.createDataFrame([("S", f"r{i}", "C1", k, "canonical") for i, k in ((1, "known"), (1, "known"), (1, "novel"), (2, "novel"), (2, "odd"))], "sampleID string, isoform string, CB string, junction_category string, canonical string")
    want = {"known_canonical": 4.0, "novel_canonical": 5.0, "known_non_canonical": 0.0, "novel_non_canonical": 0.0}
    for junctions in (own, own.join(cells.select("isoform", "_weight"), "isoform")):
        out = R.junction_type_by_category(cells, junctions, "_weight")
        assert {r["junction_type"]: r["n"] for r in out.collect()} == want
    assert R.junction_type_by_category(cells, own, "_weight")._jdf.queryExecution().sparkPlan().toString().count("Join") == 1


def exchanges(df):
    return len(re.findall(r"(?m)^[\s:+\-*()\d]*Exchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_chains_are_shuffled_by_cell_once(spark):
    """Cells go by cell and by row, a read's counted junctions by row, chains' sums and chains to each other by chain."""
    cells = explode_cells(classification(spark, [{"exons": 2, "jxnHash": "h", "associated_gene": "g"}]))
    own = spark.createDataFrame([], JUNCTIONS + ", CB string, junction_category string, canonical string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(T.ujc_counts_by_cell(cells, own)) <= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mono_and_multi_rows_of_a_chain_stay_apart(spark):
    rows = [{"exons": 2, "associated_gene": "a"}, {"exons": 2, "associated_gene": "b"}, {"exons": 2, "associated_gene": "b"}, {"exons": 1, "associated_gene": "a"}, {"exons": 1, "associated_gene": "c"}, {"exons": 1}]
    cells = explode_cells(classification(spark, [{"jxnHash": "h"} | r for r in rows]))
    own = spark.createDataFrame([("S", "i1", "known", "canonical"), ("S", "i3", "known", "canonical")], "sampleID string, isoform string, junction_category string, canonical string")
    got = sorted((r["associated_gene"], r["read_count"], r["known_canonical"], r["flag_MEI"]) for r in T.ujc_counts_by_cell(cells, own).collect())
    assert got == [("a", 1, 0, 1), ("b", 3, 2, 1), ("c", 1, 0, 1)]


def test_junction_ends_are_shuffled_as_one_row(spark):
    """Joined rows are shuffled once, before they become two ends, and no sets are merged between sorts."""
    cells = explode_cells(classification(spark, [{"associated_gene": "g"}]))
    plan = T.junction_cv_by_cell(cells, spark.createDataFrame([], JUNCTIONS + ", CB string"))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and plan.index("Generate") < plan.index("REPARTITION_BY_NUM")
