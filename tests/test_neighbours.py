"""Nearest neighbours of both kinds against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skylattice.operators import neighbours, pivot_tree, projections


def brute(points, refs, k, exclude_self):
    out = set()
    for i, p in points.items():
        near = sorted((float(np.sqrt(((p - r) ** 2).sum())), j) for j, r in refs.items() if not (exclude_self and i == j))
        out |= {(i, j, n + 1) for n, (_, j) in enumerate(near[:k])}
    return out


def make(spark, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in vectors.items()]
    return spark.createDataFrame(rows, "id long, features array<double>")


@pytest.mark.parametrize("dims", [1, 2, 6])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_cells_and_broadcast_agree_with_brute_force(spark, dims, exclude_self):
    rng = np.random.default_rng(dims)
    points = rng.normal(size=(300, dims)).round(3)
    points[:100] = points[0]  # a third of all rows at one place
    refs = dict(enumerate(points))
    df = make(spark, refs)
    want = brute(refs, refs, 3, exclude_self)
    for bound in (0, 1000):
        got = neighbours.nearest(df, df, 3, exclude_self, max_broadcast=bound, cell_rows=20)
        assert {(r.id, r.neighbour, r["rank"]) for r in got.collect()} == want


def test_other_points_than_refs(spark):
    rng = np.random.default_rng(9)
    refs = {i: rng.normal(size=2) for i in range(200)}
    points = {i: rng.normal(size=2) * 5 for i in range(1000, 1040)}
    got = neighbours.nearest(make(spark, points), make(spark, refs), 4, max_broadcast=0, cell_rows=16)
    assert {(r.id, r.neighbour, r["rank"]) for r in got.collect()} == brute(points, refs, 4, False)


def test_fewer_refs_than_k(spark):
    refs = {i: np.array([float(i), 0.0]) for i in range(3)}
    got = neighbours.nearest(make(spark, refs), make(spark, refs), 5, max_broadcast=0)
    assert got.count() == 9


def test_vote_prefers_exact_match(spark):
    refs = make(spark, {1: [0.0], 2: [1.0], 3: [1.1]}).withColumn("label", F.when(F.col("id") == 1, 5).otherwise(6))
    points = make(spark, {10: [0.0], 11: [0.9]})
    got = {r.id: r.prediction for r in neighbours.predict_by_neighbours(points, refs, "label", 3).collect()}
    assert got == {10: 5, 11: 6}
    mean = neighbours.predict_by_neighbours(points, refs, "label", 3, classify=False)
    assert {r.id: r.prediction for r in mean.collect()}[10] == 5.0


def test_smote_stays_between_neighbours(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(60), "label": [1] * 12 + [0] * 48})
    pdf["features"] = [list(map(float, rng.normal(size=3) + 10 * c)) for c in pdf.label]
    df = spark.createDataFrame(pdf)
    new = neighbours.smote(df, "label", 4, 1).collect()
    assert len(new) == 36 and {r.label for r in new} == {1}
    minority = np.array(pdf.features[pdf.label == 1].tolist())
    for r in new:
        x = np.array(r.features)
        gaps = [
            abs(np.linalg.norm(a - x) + np.linalg.norm(b - x) - np.linalg.norm(a - b)) for a in minority for b in minority if not np.array_equal(a, b)
        ]
        assert min(gaps) < 1e-9


def test_edges_and_messages(spark):
    nodes = make(spark, {0: [0.0, 0.0], 1: [1.0, 0.0], 2: [5.0, 0.0]}).withColumn("load", F.col("id") + 1.0)
    removed = spark.createDataFrame([(2, 1)], "src long, dst long")
    edge = neighbours.edges(nodes, 2, removed)
    assert {(r.src, r.dst, r.weight) for r in edge.collect()} == {(0, 1, 1.0), (1, 0, 1.0)}
    got = {r.id: r.sum_load for r in neighbours.sum_messages(edge, nodes, ["load"]).collect()}
    assert got == {0: 2.0, 1: 1.0, 2: 0.0}


def clustered(n, dims, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims)) * 4
    return centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims)) * 0.3


def brute_pairs(points, refs, k):
    d = np.sqrt(((points[:, None, :] - refs[None, :, :]) ** 2).sum(axis=2))
    return {(i, int(j), n + 1) for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, :k]) for n, j in enumerate(row)}


def test_tree_in_many_dimensions(spark):
    """64 dimensions: exact, few cells visited, no cell above its size."""
    rows = clustered(3000, 64, 60, 1)
    rows[:300] = rows[0]  # a crowded place
    df = make(spark, dict(enumerate(rows))).withColumn("node", F.lit("all"))
    tree = pivot_tree.grow(df, 5, 60)
    sizes = [r["count"] for r in tree.cells.groupBy("node").count().collect()]
    assert max(sizes) <= 60 and len(sizes) > 40 and tree.depth > 1
    asked = make(spark, dict(enumerate(rows[::5]))).withColumn("node", F.lit("all"))
    got = {(r.id, r.neighbour, r["rank"]) for r in pivot_tree.search(tree, asked, 5).collect()}
    assert got == brute_pairs(rows[::5], rows, 5)
    assert tree.visited < 0.1 * tree.possible
    print(tree.visited, tree.possible, tree.rounds)


def test_bounds_never_rule_out_a_nearer_row():
    rng = np.random.default_rng(2)
    for dims in (1, 2, 16):
        refs, points = rng.normal(size=(400, dims)), rng.normal(size=(50, dims)) * 2
        pivots = refs[:9]
        own = pivot_tree.distances(refs, pivots)
        child = own.argmin(axis=1)
        low, high = (np.array([f(own[child == j, j]) for j in range(9)]) for f in (np.min, np.max))
        _, bound = pivot_tree.lower_bounds(points, pivots, low, high)
        true = pivot_tree.distances(points, refs)
        for j in range(9):
            assert (bound[:, j] <= true[:, child == j].min(axis=1)).all()
        assert (bound > 0).any()


def test_neighbours_within_a_class(spark):
    rng = np.random.default_rng(3)
    rows, label = rng.normal(size=(400, 3)), rng.integers(0, 3, 400)
    df = make(spark, dict(enumerate(rows))).join(spark.createDataFrame([(i, int(x) if i % 50 else None) for i, x in enumerate(label)], "id long, c int"), "id")
    want = set()
    for c in range(3):
        at = [i for i in range(400) if label[i] == c and i % 50]
        want |= {(at[i], at[j], n) for i, j, n in brute_pairs(rows[at], rows[at], 4)}
    for bound in (0, 1000):
        got = neighbours.nearest(df, df, 4, max_broadcast=bound, cell_rows=25, within="c")
        assert {(r.id, r.neighbour, r["rank"]) for r in got.collect()} == want


def test_wide_references_are_not_sent_to_all_tasks(spark, monkeypatch):
    """The bound is on bytes too."""
    monkeypatch.setattr(neighbours, "MAX_BROADCAST_BYTES", 100 * 8 * 8 - 1)
    monkeypatch.setattr(neighbours, "_by_broadcast", None)
    rows = clustered(100, 8, 5, 4)
    got = neighbours.nearest(make(spark, dict(enumerate(rows))), make(spark, dict(enumerate(rows))), 2, cell_rows=30)
    assert {(r.id, r.neighbour, r["rank"]) for r in got.collect()} == brute_pairs(rows, rows, 2)


@pytest.mark.parametrize("dims", [2, 64])
def test_hashed_neighbours(spark, dims):
    """Recall against the exact search, true distances, bounded cells."""
    rows = clustered(1500, dims, 30, 5)
    rows[:200] = rows[0]
    df = make(spark, dict(enumerate(rows)))
    exact = {(i, j) for i, j, _ in brute_pairs(rows, rows, 5)}
    got = neighbours.nearest(df, df, 5, method="hashed", cell_rows=50).collect()
    assert len(exact & {(r.id, r.neighbour) for r in got}) >= 0.9 * len(exact)
    for r in got[::50]:
        assert r.distance == pytest.approx(np.linalg.norm(rows[r.id] - rows[r.neighbour]))
    assert len({(r.id, r.neighbour) for r in got}) == len(got) and max(r["rank"] for r in got) == 5
    with pytest.raises(ValueError):
        neighbours.nearest(df, df, 5, method="other")
    assert neighbours.nearest(df, df.limit(0), 5, method="hashed").count() == 0


def test_probes_are_the_nearest_cells():
    tool = projections.Projections(3, 0.7, 2, 4, 0)
    rows = np.random.default_rng(0).normal(size=(20, 3))
    places, probes = tool.places(rows), tool.probes(rows, 3)
    assert probes.shape == (20, 2, 4, 4)
    for i in range(20):
        for t in range(2):
            own = np.floor(places[i, t])
            steps = sorted((abs(places[i, t, p] - own[p] - (side > 0)), p, side) for p in range(4) for side in (-1, 1))[:3]
            want = {tuple(own + np.eye(4)[p] * side) for _, p, side in steps} | {tuple(own)}
            assert {tuple(x) for x in probes[i, t]} == want


def test_products_give_the_distances_themselves():
    """Near ties and copies keep the order of the refs; far from 0 the products are off by far more than the gaps."""
    rng = np.random.default_rng(3)
    for refs in (rng.normal(size=(700, 9)), 1e6 + 1e-4 * rng.normal(size=(700, 9)), np.repeat(rng.integers(0, 3, (70, 2)).astype(float), 10, axis=0)):
        points = np.vstack([refs[::7], refs[:5] + 0.5])
        got = pivot_tree.nearest_pairs(np.arange(len(points)), points, np.arange(len(refs)), refs, 6)
        d = pivot_tree.distances(points, refs)
        at = np.argsort(d, axis=1, kind="stable")[:, :6]
        assert got["neighbour"].tolist() == at.ravel().tolist()
        assert got["distance"].tolist() == np.take_along_axis(d, at, axis=1).ravel().tolist()


def test_even_vectors_meet_in_blocks(spark, monkeypatch):
    """Where nothing is ruled out, all rows meet all in blocks and no cell is visited again."""
    monkeypatch.setattr(pivot_tree, "BLOCK_BYTES", 100 * 8 * 24)
    v = np.random.default_rng(5).normal(size=(400, 24))
    df = spark.createDataFrame([(i, r.tolist(), "all") for i, r in enumerate(v)], "id long, features array<double>, node string")
    tree = pivot_tree.grow(df, 3, 50)
    got = sorted((r.id, r["rank"], r.neighbour) for r in pivot_tree.search(tree, df, 3).collect())
    near = np.argsort(pivot_tree.distances(v, v), axis=1, kind="stable")[:, :3]
    assert got == [(i, k + 1, int(near[i, k])) for i in range(400) for k in range(3)]
    assert not tree.rounds
