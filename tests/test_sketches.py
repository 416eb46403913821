"""Statistics from sketches that are stored and merged."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoforge.operators import report_tables as R
from isoforge.operators import sketches as Q


def cells(spark, sample, n, seed):
    rng = np.random.default_rng(seed)
    rows = [(sample, f"c{i}", "skewed", float(v)) for i, v in enumerate(rng.lognormal(size=n))] + [(sample, f"c{i}", "ties", float(i % 3)) for i in range(n)]
    return spark.createDataFrame([*rows, (sample, "x", "ties", None), (sample, "y", "ties", float("nan"))], "sampleID string, CB string, metric string, value double")


def test_ranks_stay_within_the_bound(spark):
    long = cells(spark, "S", 20_000, 1).repartition(7)
    values = np.sort([r["value"] for r in long.filter("metric = 'skewed'").collect()])
    for k in (200, 2000):
        sketch = Q.metric_sketches(long, k=k)
        for q in (0.01, 0.25, 0.5, 0.9):
            got = sketch.filter("metric = 'skewed'").select(Q.sketched_quantile(q).alias("v")).first()["v"]
            assert abs(np.searchsorted(values, got) / len(values) - q) <= Q.rank_error(k) + 1e-4
    assert {r["metric"]: r["median"] for r in Q.sketched_medians(sketch).collect()}["ties"] == 1.0


def test_a_second_sample_is_added_without_the_first(spark, tmp_path):
    path = str(tmp_path / "sketches")
    first, second = cells(spark, "S", 900, 2), cells(spark, "T", 1100, 3)
    Q.add_to_sketches(first, path)
    before = sorted(p.name for p in (tmp_path / "sketches").glob("part-*"))
    Q.add_to_sketches(second.filter("CB < 'c5'"), path)
    Q.add_to_sketches(second.filter("CB >= 'c5'"), path)
    assert set(before) < {p.name for p in (tmp_path / "sketches").glob("part-*")}
    own = Q.stored_sketches(spark, path)
    assert {(r["sampleID"], r["metric"]): r["n"] for r in own.collect()} == {("S", "skewed"): 900, ("S", "ties"): 900, ("T", "skewed"): 1100, ("T", "ties"): 1100}
    both = first.unionByName(second).filter("NOT isnan(value) AND value IS NOT NULL")
    exact = {r["metric"]: r for r in R.describe_cells(both).collect()}
    for r in Q.sketched_stats(own).collect():
        e = exact[r["metric"]]
        assert [r[c] for c in ("mean", "min", "max", "sd")] == pytest.approx([e[c] for c in ("mean", "min", "max", "sd")], abs=1.1e-3)
        assert r["median"] == pytest.approx(e["median"], abs=0.02)
    for r in Q.sketched_medians(own).collect():
        values = sorted(x["value"] for x in both.filter((F.col("sampleID") == r["sampleID"]) & (F.col("metric") == r["metric"])).collect())
        assert r["median"] == values[(len(values) - 1) // 2]
    assert Q.metric_sketches(first.filter("false")).count() == 0
