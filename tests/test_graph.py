"""Neighbours, communities, the neighbour graph's weights and coordinates, and components, against plain versions."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isoforge.operators import clustering as K
from isoforge.operators import communities as C
from isoforge.operators import embedding as G
from isoforge.operators import neighbours as N
from isoforge.operators import sparse as P


def frame(spark, x):
    return spark.createDataFrame([(f"S{i % 3}", f"c{i:05}", row.tolist()) for i, row in enumerate(x)], "sampleID string, CB string, pcs array<double>")


def clustered(n, groups=20, width=8, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, width))[rng.integers(0, groups, n)] + 0.15 * rng.normal(size=(n, width))


@pytest.mark.parametrize("list_cells,block_cells", [(10**6, 10**6), (100, 90), (40, 16)])
def test_neighbours_are_exact_with_any_lists(spark, list_cells, block_cells):
    x = clustered(1500)
    x[:200] = x[0]  # equal cells are told apart by name
    got = {}
    for r in N.knn_cells(frame(spark, x), 15, list_cells=list_cells, block_cells=block_cells).collect():
        got.setdefault((r["sampleID"], r["CB"]), []).append((r["rank"], r["neighbour"]["sampleID"], r["neighbour"]["CB"]))
    names = [(f"S{i % 3}", f"c{i:05}") for i in range(len(x))]
    order = sorted(range(len(x)), key=names.__getitem__)
    for i in [*range(0, 200, 40), *range(200, 1500, 50)]:
        d = np.sqrt(((x[order] - x[i]) ** 2).sum(1))
        d[order.index(i)] = np.inf
        assert [n[1:] for n in sorted(got[names[i]])] == [names[order[j]] for j in np.argsort(d, kind="stable")[:15]]


def test_neighbours_grow_with_the_cells_and_probes_bound_them(spark, monkeypatch):
    visited = {}
    real = N._ranked

    for n in (1500, 3000):
        x = frame(spark, clustered(n))
        counted = []
        monkeypatch.setattr(N, "_ranked", lambda pairs, k: counted.append(pairs.count()) or real(pairs, k))
        exact = N.knn_cells(x, 10, list_cells=100, block_cells=200)
        truth = {(r["CB"], r["neighbour"]["CB"]) for r in exact.collect()}
        few = {(r["CB"], r["neighbour"]["CB"]) for r in N.knn_cells(x, 10, probes=3, list_cells=100, block_cells=200).collect()}
        assert len(truth) == 10 * n and len(few & truth) >= 0.9 * len(truth)
        visited[n] = counted[0]
    assert visited[3000] < 2.6 * visited[1500]


def test_neighbours_of_few_and_odd_cells(spark):
    odd = spark.createDataFrame([("S", "a", [0.0, 0.0]), ("S", "b", [1.0, 0.0]), ("S", "c", None), ("T", "a", [float("nan"), 1.0])], "sampleID string, CB string, pcs array<double>")
    assert [(r["CB"], r["neighbour"]["CB"], r["distance"]) for r in N.knn_cells(odd).orderBy("CB").collect()] == [("a", "b", 1.0), ("b", "a", 1.0)]
    assert N.knn_cells(odd.filter("false")).count() == 0


def planted(seed, groups=6, size=30, inside=0.35, between=0.01):
    rng = np.random.default_rng(seed)
    own = np.repeat(np.arange(groups), size)
    return own, [(int(i), int(j), 1.0) for i, j in itertools.combinations(range(len(own)), 2) if rng.random() < (inside if own[i] == own[j] else between)]


def q_of(edges, label, resolution):
    m, inside, degree = 0.0, 0.0, {}
    for a, b, w in edges:
        m += w
        inside += w * (label[a] == label[b])
        for x in (a, b):
            degree[label[x]] = degree.get(label[x], 0) + w
    return inside / m - resolution * sum(d * d for d in degree.values()) / (2 * m) ** 2


@pytest.mark.parametrize("few_edges", [C.FEW_EDGES, 500])
def test_planted_communities_are_found(spark, few_edges):
    own, edges = planted(1)
    df = spark.createDataFrame(edges, "a long, b long, w double")
    out = C.modularity_communities(df, few_edges=few_edges)
    label = {r["node"]: r["community"] for r in out.labels.collect()}
    assert len({(own[n], c) for n, c in label.items()}) == len(set(label.values())) == 6
    assert all(b >= a - 1e-9 for a, b in itertools.pairwise(out.modularity))
    assert out.modularity[-1] == pytest.approx(q_of(edges, label, 1.0)) == pytest.approx(C.modularity(df, out.labels))
    assert all(c == min(n for n in label if label[n] == c) for c in set(label.values()))


def test_resolution_loops_repeats_and_parts(spark):
    own, edges = planted(2)
    df = spark.createDataFrame(edges, "a long, b long, w double")
    count = {r: C.modularity_communities(df, r).labels.select("community").distinct().count() for r in (0.1, 1.0, 6.0)}
    assert count[0.1] < count[1.0] < count[6.0]
    odd = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0), (3, 3, 2.0), (4, 5, 0.0), (6, 7, 1.0)], "a long, b long, w double")
    assert {r["node"]: r["community"] for r in C.modularity_communities(odd).labels.collect()} == {1: 1, 2: 1, 3: 3, 6: 6, 7: 6}
    assert C.modularity_communities(df.filter("false")).labels.count() == 0
    split = np.array([0, 0, 1, 1, 0])
    assert C._parts(split, np.array([0, 1, 2, 3]), np.array([1, 0, 3, 2])).tolist() == [0, 0, 2, 2, 4]
    from isoforge.sources.shared import Saved

    nodes = spark.createDataFrame([(n, 1.0, c) for n, c in ((1, 1), (2, 1), (3, 1), (4, 1), (5, 1))], "node long, degree double, community long")
    parts = C.connected_labels(Saved(spark), nodes, spark.createDataFrame([(1, 2), (2, 1), (3, 4), (4, 3), (4, 5), (5, 4)], "a long, b long"))
    assert {r["node"]: r["community"] for r in parts.collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3}


def test_graph_clusters_are_no_worse_than_labels(spark):
    near = N.knn_cells(frame(spark, clustered(400, 7)), 10).cache()
    nodes, edges = G.numbered_graph(G.fuzzy_graph(near))
    edges = edges.cache()
    quality = {}
    for name, made in (("modularity", K.cluster_graph(near)), ("labels", K.cluster_labels(near))):
        own = made.select(F.struct("sampleID", "CB").alias("cell"), "cluster").join(nodes, "cell")
        assert own.count() == 400
        quality[name] = C.modularity(edges, own.select("node", F.xxhash64("cluster").alias("community")))
    assert quality["modularity"] >= quality["labels"] - 1e-9
    assert {r["cluster"] for r in K.cluster_graph(near).collect()} >= {"0", "1"}


def scales(d):
    rho = min((x for x in d if x > 0), default=0.0)
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        if sum(np.exp(-max(x - rho, 0) / mid) for x in d) > np.log2(len(d)):
            high = mid
        else:
            low = mid
    return rho, max(mid, 1e-3 * np.mean(d))


def test_graph_weights_equal_plain_ones(spark):
    near = N.knn_cells(frame(spark, clustered(120, 5)), 8).cache()
    w = {}
    by = {}
    for r in near.collect():
        by.setdefault(r["CB"], []).append((r["rank"], r["neighbour"]["CB"], r["distance"]))
    for cb, own in by.items():
        rho, s = scales([d for _, _, d in sorted(own)])
        w |= {(cb, o): np.exp(-max(d - rho, 0) / s) for _, o, d in own}
    got = {(r["one"]["CB"], r["other"]["CB"]): r["w"] for r in G.fuzzy_graph(near).collect()}
    pairs = {tuple(sorted(p, key=lambda c: (f"S{int(c[1:]) % 3}", c))) for p in w}
    assert set(got) == pairs
    for a, b in pairs:
        x, y = w.get((a, b), 0.0), w.get((b, a), 0.0)
        assert got[a, b] == pytest.approx(x + y - x * y, abs=1e-6)


def test_coordinates_are_eigenvectors(spark):
    _, edges = planted(5, groups=4, size=25)
    found = G.spectral(spark.createDataFrame(edges, "a long, b long, w double"), residual=1e-4)
    n = 100
    adjacency = np.zeros((n, n))
    for a, b, w in edges:
        adjacency[a, b] = adjacency[b, a] = w
    root = np.sqrt(adjacency.sum(1))
    s = adjacency / root[:, None] / root[None]
    truth = np.sort(np.linalg.eigvalsh(s))[::-1][1:3]
    assert np.allclose(found.values, truth, atol=1e-4) and (found.residuals <= 1e-4).all()
    rows = {r["node"]: r for r in found.vectors.collect()}
    u = np.array([[rows[i]["u1"], rows[i]["u2"]] for i in range(n)])
    assert np.linalg.norm(s @ u - u * found.values, axis=0).max() < 2e-4 and np.allclose(u.T @ u, np.eye(2), atol=1e-6)
    two = G.embed_cells(N.knn_cells(frame(spark, clustered(60, 3)), 5))
    assert two.count() == 60 and two.columns == ["sampleID", "CB", "UMAP_1", "UMAP_2"]


def counts(spark, cells=60, genes=25, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(f"S{i % 2}", f"c{i:03}", f"g{j:02}", int(v)) for i in range(cells) for j, v in enumerate(rng.poisson(0.5 + np.arange(genes) % 3 / 2 * (1 + i % 4))) if v]
    return spark.createDataFrame(rows, "sampleID string, CB string, associated_gene string, count long")


def test_sparse_components_span_the_dense_ones(spark):
    m = counts(spark)
    x = K.normalize_log1p(m).cache()
    genes = x.select("associated_gene").distinct()
    scores, shares = P.pca_sparse(x, genes, 5)
    full = K.scale_clip(K.dense(x, genes))
    dense = {(r["sampleID"], r["CB"]): r["pcs"] for r in K.pca_cells(full, 5).collect()}
    got = {(r["sampleID"], r["CB"]): r["pcs"] for r in scores.collect()}
    assert set(got) == set(dense)
    a, b = np.array([got[c] for c in sorted(got)]), np.array([dense[c] for c in sorted(got)])
    assert np.allclose(a.mean(0), 0, atol=1e-9)
    b = b - b.mean(0)
    assert np.allclose(a * np.sign((a * b).sum(0)), b, atol=1e-3)
    rows = shares.orderBy("pc").collect()
    assert np.allclose([r["variance"] for r in rows], a.var(0, ddof=1), rtol=1e-6)
    z = full.groupBy("associated_gene").agg(F.var_samp("x")).agg(F.sum("var_samp(x)")).first()[0]
    assert [r["ratio"] for r in rows] == pytest.approx((a.var(0, ddof=1) / z).tolist(), rel=1e-6)
    assert P.pca_sparse(x.filter("false"), genes, 5)[0].count() == 0


def test_residuals_of_zeros_follow_sums(spark):
    m = counts(spark, 40, 15)
    dense = {(r["CB"], r["associated_gene"]): r["x"] for r in K.normalize_pearson(m, m.select("associated_gene").distinct()).collect()}
    rows, cells, genes, total, most = P.pearson_parts(m)
    got = {(r["CB"], r["associated_gene"]): r["x"] for r in rows.collect()}
    assert len(got) == m.count()
    zeros = cells.crossJoin(genes).select("CB", "associated_gene", P.zero_residual(F.col("r"), F.col("c"), total, 100.0, most).alias("x"))
    whole = {(r["CB"], r["associated_gene"]): r["x"] for r in zeros.collect()} | got
    assert whole.keys() == dense.keys() and all(whole[k] == pytest.approx(dense[k]) for k in dense)
    for r in P.residual_moments(m).collect():
        own = [v for (_, g), v in dense.items() if g == r["associated_gene"]]
        assert (r["mean"], r["variance"]) == (pytest.approx(np.mean(own), abs=1e-9), pytest.approx(np.var(own, ddof=1)))


@pytest.mark.parametrize("normalization,method", [("sqrt", "leiden"), ("pearson", "kmeans")])
def test_cells_get_clusters_and_coordinates(spark, normalization, method):
    out = K.cluster_cells(counts(spark), normalization, 20, 5, 6, method, n_clusters=3)
    assert out.columns == ["sampleID", "Barcode", "Cluster", "UMAP_1", "UMAP_2"] and out.count() == 60


def test_products_of_a_large_batch_need_little_memory():
    import tracemalloc
    from types import SimpleNamespace

    rng, cells, each = np.random.default_rng(5), 4000, 200
    genes = np.sort(rng.random((cells, 435)).argsort(1)[:, :each].astype(np.int32), 1)
    d, v, s = rng.normal(size=(cells, each)), rng.normal(size=(435, 40)), rng.normal(size=40)
    lists = lambda x: pa.ListArray.from_arrays(np.arange(cells + 1, dtype=np.int32) * each, pa.array(x.ravel()))
    batch = pa.RecordBatch.from_arrays([lists(genes), lists(d)], names=["genes", "d"]).slice(10)
    tracemalloc.start()
    out = next(P._multiplied([batch], SimpleNamespace(value=v), SimpleNamespace(value=s)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    dense = np.zeros((cells, 435))
    np.put_along_axis(dense, genes.astype(int), d, 1)
    y = dense[10:] @ v - s
    assert np.allclose(np.array(out.column(1).to_pylist()), np.vstack([y.sum(0)[None], dense[10:].T @ y]))
    assert peak < 50e6


def test_components_read_their_counts_once(spark, monkeypatch):
    from isoforge.plans import report_queries as Q
    from isoforge.plans.queries import QUERIES

    seen = spark.sparkContext.accumulator(0)
    rows = [("S", f"C{i}", f"g{j}", float((i * j) % 5 + 1)) for i in range(12) for j in range(6)]
    cells = spark.createDataFrame(rows, "sampleID string, CB string, associated_gene string, _count double")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(Q, "cells_of", lambda *_: cells.mapInArrow(counted, cells.schema))
    assert QUERIES["m06_components"](spark, "").count() == 6
    assert seen.value == len(rows)


def test_cells_travel_to_blocks_of_many_lists(spark, monkeypatch):
    """On data without clusters, where nearly all lists are visited, a cell is sent once to each block and not once to each list."""
    x = np.random.default_rng(3).normal(size=(1200, 8)) + 1000.0
    sent, real = spark.sparkContext.accumulator(0), N._visits

    def counted(*args):
        for batch in real(*args):
            sent.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(N, "_visits", counted)
    monkeypatch.setattr(N, "SLICE_CELLS", 400, raising=False)
    got = {}
    for r in N.knn_cells(frame(spark, x), 5, list_cells=20).collect():
        got.setdefault(r["CB"], set()).add(r["neighbour"]["CB"])
    for i in range(0, 1200, 40):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        assert got[f"c{i:05}"] == {f"c{j:05}" for j in np.argsort(d)[:5]}
    assert sent.value < 10 * len(x)


def test_residuals_are_made_without_shuffling_zeros(spark):
    m = spark.createDataFrame([("S", "a", "g1", 3.0), ("S", "a", "g2", 1.0), ("T", "b", "g3", 2.0), ("T", "c", "g1", 1.0)], "sampleID string, CB string, associated_gene string, count double")
    out = K.normalize_pearson(m, m.filter("associated_gene != 'g3'").select("associated_gene"))
    assert "hashpartitioning(sampleID" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["CB"], r["associated_gene"]): r["x"] for r in out.collect()}
    z = lambda n, mu: max(min((n - mu) / (mu + mu * mu / 100) ** 0.5, 3**0.5), -(3**0.5))
    want = {("a", "g1"): z(3, 3.2), ("a", "g2"): z(1, 0.8), ("b", "g1"): 0.0, ("b", "g2"): 0.0, ("c", "g1"): z(1, 0.8), ("c", "g2"): z(0, 0.2)}
    assert got == pytest.approx(want)


def test_a_round_of_moves_shuffles_edges_by_node_alone(spark):
    from isoforge.operators import communities

    edges = communities.undirected(spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 3, 2.0), (3, 4, 0.5), (4, 4, 1.0)], "a long, b long, w double"))
    nodes = spark.createDataFrame([(1, 3.0, 1), (2, 2.0, 1), (3, 3.5, 3), (4, 2.5, 4)], "node long, degree double, community long")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        made = communities._round(nodes, edges, 11.0, 1.0)
        plan = made._jdf.queryExecution().executedPlan().toString()
        got = {r["node"]: (r["own"], r["best"], r["gain"]) for r in made.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "Exchange hashpartitioning" in plan
    assert not any("Exchange hashpartitioning(" in line and ", c#" in line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines())
    # Node 1: weight 2 into 3's community of total 3.5; 1 stays worth 1 - 3 * 2 / 11.
    assert got[1][:2] == (1.0, 3) and abs(got[1][2] - ((2 - 3 * 3.5 / 11) - (1 - 3 * 2 / 11))) < 1e-12
    assert got[4][:2] == (0.0, 3) and abs(got[4][2] - (0.5 - 2.5 * 3.5 / 11)) < 1e-12
