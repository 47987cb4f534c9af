"""Batched k-means and Euclidean silhouettes against brute force."""

import hashlib
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchantry.operators import distances, kmeans, segment, silhouette


@pytest.fixture
def store(spark, tmp_path):
    def save(name, df):
        path = f"{tmp_path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return save


def _blobs(n, seed, spread=0.3):
    r = np.random.Generator(np.random.PCG64(seed))
    middles = r.normal(size=(4, 3)) * 2
    x = np.round(middles[r.integers(0, 4, n)] + r.normal(size=(n, 3)) * spread, 2)
    return np.concatenate([x, np.repeat(x[:1], n // 3, axis=0)])  # one row is a quarter of all


def _lloyd(x, centres, max_iter=300):
    for turn in range(max_iter):
        d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        at = np.round(d, 9).argmin(axis=1)
        new = np.array([x[at == i].mean(axis=0) if (at == i).any() else c for i, c in enumerate(centres)])
        moved = ((new - centres) ** 2).sum()
        centres = new
        if moved <= 1e-4:
            break
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    return centres, d.min(axis=1).sum()


def _frame(spark, x):
    return spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "CustomerID long, a double, b double, c double")


def test_all_runs_at_once_are_single_runs(spark):
    x = _blobs(240, 1)
    df = _frame(spark, x).union(spark.createDataFrame([(9999, None, 1.0, 1.0)], "CustomerID long, a double, b double, c double"))
    runs = kmeans.fit(df, ["a", "b", "c"], range(2, 6), starts=(1, 2, 3))
    assert [(r.k, r.start) for r in runs] == [(k, s) for k in range(2, 6) for s in (1, 2, 3)]
    first = kmeans.starting_rows(df, ["a", "b", "c"], "CustomerID", 5, (1, 2, 3))
    for r in runs:
        centres, cost = _lloyd(x, first[r.start][: r.k])
        assert r.centres == pytest.approx(centres, abs=1e-9) and r.cost == pytest.approx(cost, rel=1e-9)
    found = kmeans.best(runs)
    assert all(found[k].cost == pytest.approx(min(r.cost for r in runs if r.k == k)) for k in found)


def test_few_rows(spark):
    df = _frame(spark, np.array([[0.0, 0, 0], [1, 1, 1]]))
    assert [len(r.centres) for r in kmeans.fit(df, ["a", "b", "c"], [2, 5], starts=(1,))] == [2, 2]
    assert kmeans.fit(df.limit(0), ["a", "b", "c"], [2], starts=(1,)) == []
    still = kmeans.fit(_frame(spark, np.zeros((5, 3))), ["a", "b", "c"], [3], starts=(1,))
    assert still[0].cost == 0 and still[0].centres.tolist() == np.zeros((3, 3)).tolist()


def _silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        others = [d[i, labels == c].mean() for c in set(labels) if c != labels[i]]
        if own.sum() == 1 or not others:
            out.append(0.0)
            continue
        a, b = d[i, own].sum() / (own.sum() - 1), min(others)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize(("error", "leaf", "spread"), [(1e-6, 16, 0.3), (1e-2, 8, 0.05), (1e-3, 4, 1.0)])
def test_silhouettes_are_within_their_bound(spark, store, error, leaf, spread):
    x = _blobs(240, 2, spread)
    groups = (2, 3, 7, 1)
    centres = [np.random.Generator(np.random.PCG64(k)).normal(size=(k, 3)) * 2 for k in groups]
    labels = np.stack([((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1) for c in centres], axis=1)
    rows = [(i, *map(float, v), c.tolist()) for i, (v, c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, lab array<int>")
    got = silhouette.silhouettes(df, ["a", "b", "c"], F.col("lab"), groups, error=error, leaf=leaf, store=store)
    for g in range(len(groups)):
        assert got[g] == pytest.approx(_silhouette(x, labels[:, g]), abs=error)


def test_far_nodes_stand_for_their_rows(spark, store):
    """With two tight groups far apart only the own group is met row by row."""
    r = np.random.Generator(np.random.PCG64(3))
    x = np.concatenate([r.normal(size=(64, 3)) * 0.01, r.normal(size=(64, 3)) * 0.01 + 9])
    df = spark.createDataFrame([(*map(float, v), [int(i >= 64)], 1.0) for i, v in enumerate(x)], "x0 double, x1 double, x2 double, c array<int>, w double")
    placed, nodes = silhouette.tree(df, 3, 16, store)
    assert nodes.filter("leaf").agg(F.max("n"), F.sum("n")).first() == (16, 128)
    far, near = silhouette.meetings(nodes, 3, 1e-6, store)
    top = lambda c: F.floor(F.col(c) / F.pow(F.lit(2), F.floor(F.log2(c)) - 1))
    assert near.filter(top("query") != top("node")).isEmpty() and not far.isEmpty()
    assert silhouette.silhouettes(df.limit(0), ["x0"], F.col("c"), (2,), store=store)[0] != 0


def test_sums_by_kind_and_weight():
    """Kinds with weights give what their rows give, and a box without length in a side meets others by few points."""
    r = np.random.Generator(np.random.PCG64(5))
    x = np.stack([r.random(4000) * 3, r.integers(0, 4, 4000) * 2.0, r.random(4000)], axis=1)
    other = np.concatenate([x[::2] + [2.0, 0, 0], np.repeat(x[:1], 500, axis=0)])
    kind, weight = r.integers(0, 5, len(other)), r.integers(1, 9, len(other)).astype(float)
    values = (r.random((5, 7)) < 0.4) * 1.0
    sums = distances.Sums(x, 7, 5e-7)
    sums.add(other, values, kind, weight)
    assert distances.GRID**2 in {len(v) for v in sums.at_points.values()}
    want = np.sqrt(((x[:60, None] - other[None]) ** 2).sum(axis=2)) @ (values[kind] * weight[:, None])
    assert sums.totals()[:60] == pytest.approx(want, rel=5e-7)


def test_few_distances_row_by_row(monkeypatch):
    """Flat boxes apart meet by points, so most pairs of rows don't meet one by one."""
    r = np.random.Generator(np.random.PCG64(6))
    x = np.stack([r.random(30000), np.zeros(30000), r.random(30000)], axis=1)
    met = []
    plain = distances._distances
    monkeypatch.setattr(distances, "_distances", lambda a, b, *rest: met.append(len(a) * len(b)) or plain(a, b, *rest))
    sums = distances.Sums(x, 2, 5e-7)
    sums.add(x, np.eye(2), (x[:, 0] > 0.5).astype(int))
    assert sum(met) < 0.5 * len(x) ** 2


def test_nearest_places_and_ties():
    r = np.random.Generator(np.random.PCG64(7))
    x = np.concatenate([r.integers(-3, 4, (3000, 3)).astype(float), r.normal(size=(500, 3)) * 100])
    for centres in (np.array([[0.0, 0, 0], [1, 1, 0], [1, 1, 0], [-1, 0, 2]]), x[3000:3010], x[:1], np.zeros((2, 3))):
        near = kmeans.Places(x).nearest(centres)
        assert (near.sum(axis=0) == 1).all() and (near.argmax(axis=0) == kmeans.nearest(x, centres)[0]).all()


def test_starting_rows_are_those_of_the_smallest_hashes(spark):
    rows = [(str(i) if i % 50 else None, float(i), 1.0) for i in range(1, 300)] + [("7", None, 1.0)]
    df = spark.createDataFrame(rows, "id string, a double, b double").repartition(5)
    found = kmeans.starting_rows(df, ["a", "b"], "id", 4, (1, 20))
    for s in (1, 20):
        text = lambda i: str(s) if i is None else f"{s}:{i}"
        keyed = sorted((hashlib.md5(text(i).encode()).hexdigest(), a) for i, a, _ in rows if a is not None)
        want = [h for h, _ in keyed[:4]]
        number = {a: hashlib.md5(text(i).encode()).hexdigest() for i, a, _ in rows}
        assert [number[a] for a, _ in found[s].tolist()] == want


def test_index_of_several_clusterings_in_one_pass(spark):
    x = _blobs(90, 8)
    rows = [(*map(float, v), [i % 2, i % 5, 0]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "Recency double, Frequency double, Monetary double, c array<int>")
    every = segment.davies_bouldin(df.select(*segment.FEATURES, F.posexplode("c").alias("place", "Cluster")), by=("place",))
    got = {r["place"]: r["DaviesBouldin"] for r in every.collect()}
    for i in range(3):
        [one] = segment.davies_bouldin(df.select(*segment.FEATURES, F.col("c")[i].alias("Cluster"))).collect()
        assert got[i] == (one[0] if one[0] is None else pytest.approx(one[0]))


def test_numbers_of_centres_with_nulls(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (None, 5.0), (4.0, 6.0)], "a double, b double")
    runs = [np.array([[0.0, 0.0], [5.0, 5.0]]), np.array([[9.0, 9.0], [1.0, 1.0], [5.0, 5.0]])]
    got = [tuple(r) for r in kmeans.numbered(df, ["a", "b"], runs).collect()]
    assert got == [(0.0, 0.0, [0, 1]), (5.0, 5.0, [1, 2]), (None, 5.0, [0, 0]), (4.0, 6.0, [1, 2])]
