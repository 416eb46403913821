"""What queries over the order tables shuffle."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest

from isoforge.functions import columns as C
from isoforge.operators import cell_summary as S
from isoforge.operators import enrich as E
from isoforge.operators.explode import explode_cells
from isoforge.plans import report_queries  # noqa: F401  it adds to the queries
from isoforge.plans.adapters import classification
from isoforge.plans.queries import QUERIES
from test_cells import exchanges

SF = "/root/testdata/sf0.001"
if not Path(SF).exists():
    pytest.skip("no test tables", allow_module_level=True)


@contextmanager
def large_tables(spark):
    """Joins as of tables too large to be sent to all tasks, other than a few fixed values; plans are final before they run."""
    new = {"spark.sql.autoBroadcastJoinThreshold": "2000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_reads_are_shuffled_by_name_once(spark):
    """Reads and their junctions are made of the same lines, shuffled once by name; joined junctions are shuffled by cell."""
    with large_tables(spark):
        assert exchanges(QUERIES["a40_a41_junction_cv_by_cell"](spark, SF)) == 2


@pytest.mark.parametrize(("name", "more"), [("a15_cell_summary_skip_orf", 0), ("a79_distribution_stats", 1), ("a64_describe_cells", 1)])
def test_summaries_shuffle_each_part_once(spark, name, more):
    """Tests' bits, keys and junction counts go by cell once; what is made of lines is not joined anew for each of them."""
    with large_tables(spark):
        assert exchanges(QUERIES[name](spark, SF)) == 3 + more


def test_measures_travel_as_one_number(spark):
    """What is shuffled for the sums has one number beside the keys, however many measures there are; the sums are those of the tests."""
    cells = explode_cells(classification(spark, SF))
    with large_tables(spark):
        lines = S.category_sums(cells)._jdf.queryExecution().executedPlan().toString().splitlines()
    sent = next(below for line, below in zip(lines, lines[1:], strict=False) if "REPARTITION_BY_COL" in line)
    assert re.search(r"Project \[sampleID#\d+, CB#\d+, structural_category#\d+, subcategory#\d+, \(.* AS __bits#\d+L\]$", sent)
    got = S.category_sums(cells).selectExpr("sampleID", "CB", "total.*").collect()
    tests = C.quality_predicates()
    for name in ("rts", "coding", "ratio"):
        assert sum(r[name] for r in got) == cells.filter(tests[name]).count() > 0


def test_reads_and_entries_are_shuffled_once(spark):
    """Rows and the association's entries go by the primary's name once each."""
    with large_tables(spark):
        assert exchanges(QUERIES["j01_annotate_cells_reads"](spark, SF)) == 2


def test_duplicates_of_duplicates_and_missing_primaries(spark):
    """Every name looks for its primary's entry and then for its own, whatever other duplicates the primary has."""
    names = ["a", "a_dup1", "a_dup2", "a_dup1_dup3", "b_dup1", "b_dup2", "c", "c_dup1", "d_dup1", "d_dup1_dup2", None]
    cls = spark.createDataFrame([(s, n, i) for s in ("S", "T") for i, n in enumerate(names * 2)], "sampleID string, isoform string, row int")
    entries = [("S", "a", "Ca"), ("S", "a_dup1", "Ca1"), ("S", "b_dup1", "Cb1"), ("S", "b_dup2", None), ("S", "c_dup1", "Cc1"), ("S", "d_dup1_dup2", "Cd"), ("T", "c", "Tc"), ("T", None, "x")]
    assoc = spark.createDataFrame([(*e, "U" + e[2] if e[2] else None) for e in entries], "sampleID string, isoform string, CB string, UMI string")
    got = sorted((r["sampleID"], r["row"], r["CB"], r["UMI"]) for r in E.annotate_cells_reads(cls, assoc).collect())
    own = {(s, n): cb for s, n, cb in entries if n}
    primary = lambda n: m[1] if (m := re.fullmatch(r"(.+)_dup\d+", n or "")) else n
    want = [(s, i, cb := own.get((s, primary(n)), own.get((s, n))), cb and "U" + cb) for s in ("S", "T") for i, n in enumerate(names * 2)]
    assert got == sorted(want, key=lambda r: r[:2])
