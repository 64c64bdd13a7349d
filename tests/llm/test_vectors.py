"""Indexes that prune, and vectors of any size: searches and links against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from layercake.llm import ann, vector_dedup

SCHEMA = "vec_id long, embedding array<double>, label int"


def _table(spark, x):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)


def _best(x, queries, k=20):
    """(query, rank, vec_id, score) by brute force, summed in the order of components."""
    out = []
    for q in queries:
        score = np.zeros(len(x))
        for d in range(x.shape[1]):
            score += x[q, d] * x[:, d]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:k]
        out += [(q, r + 1, int(i), float(score[i])) for r, i in enumerate(order)]
    return out


def _clustered(n, centres, dim=64, noise=0.35):
    rng = np.random.default_rng(21)
    c = rng.normal(size=(centres, dim))
    x = c[rng.integers(0, centres, size=n)] + noise * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize("size", ["1e-9 apart", "1e150", "1e200", "1e-200"])
def test_doubles_are_ranked_as_they_are(spark, size):
    """Vectors that single precision cannot tell apart, and ones whose squares over- or underflow."""
    rng = np.random.default_rng(20)
    x = rng.normal(size=(400, 8))
    if size == "1e-9 apart":
        x = np.ones((400, 8)) + 1e-9 * x
    else:
        x = (np.abs(x) if size == "1e200" else x) * float(size)
    got = ann.nearest(_table(spark, x), _table(spark, x).where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    with np.errstate(over="ignore", invalid="ignore"):
        want = _best(x, range(0, 400, 20))
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == want


def test_clustered_vectors_are_searched_by_a_small_radius(spark, monkeypatch):
    x = _clustered(20_000, 400)
    rows = _table(spark, x).repartition(8).cache()
    seen = []
    products = ann.products
    monkeypatch.setattr(ann, "products", lambda *a: seen.append((a[2], products(*a))) or seen[-1][1])
    got = ann.nearest(rows, rows.where("vec_id % 200 = 0"))
    hits, want = set(), _best(x, range(0, 20_000, 200))
    for r in got.collect():
        hits.add((r["query_id"], r["vec_id"]))
    recall = np.mean([(q, i) in hits for q, _, i, _ in want])
    assert seen and seen[-1][0] < 31 and seen[-1][1] <= 0.5, seen
    assert recall >= 0.98


def test_vectors_without_clusters_are_searched_once(spark):
    """Where the eight indexes would multiply more pairs than there are, one index compares all: exactly."""
    x = np.random.default_rng(22).normal(size=(2000, 64))
    rows = _table(spark, x)
    got = ann.nearest(rows, rows.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == _best(x, range(0, 2000, 100))


def _partners(rng, x, cosine):
    """For each unit vector another one at exactly that cosine, in any direction."""
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    return cosine * x + np.sqrt(1 - cosine**2) * away


def test_cells_prune_and_keep_the_links(spark, monkeypatch):
    """Partners just above the threshold, in cells of few vectors: hardly a link is lost, and most cells are not met."""
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", 200)
    rng = np.random.default_rng(23)
    x = _clustered(5000, 300, noise=0.8)
    x = np.concatenate([x, _partners(rng, x[:1000], 0.9005)])
    rows = _table(spark, x)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1)
    exact = {r["vec_id"]: r["n_links"] for r in vector_dedup.near_duplicates(rows, recall=1.0).collect()}
    assert [exact[i] for i in range(len(x))] == want.tolist()
    got = {r["vec_id"]: r["n_links"] for r in vector_dedup.near_duplicates(rows).collect()}
    assert sum(got.values()) >= 0.998 * want.sum() and all(got[i] <= want[i] for i in got)
    centres = vector_dedup.spherical_kmeans(x[:5000], 30)
    factor = vector_dedup.border_factor(x[:5000], centres, 0.9, vector_dedup.RECALL)
    assert 0 < factor < 1
    assert vector_dedup.cells_met(x, centres, 0.9, factor) < 0.6 * vector_dedup.cells_met(x, centres, 0.9, 1.0)


def test_odd_ids_and_repeated_vectors(spark):
    """NULL and repeated ids, repeated vectors, columns named like the inner ones."""
    v, w = [1.0, 0.0], [0.0, 1.0]
    rows = spark.createDataFrame(
        [(None, v, 1, 1.0), (4, v, 2, 2.0), (4, v, 3, 3.0), (2, v, 4, 4.0), (9, w, 5, 5.0), (9, None, 6, 6.0)],
        "vec_id long, embedding array<double>, cell int, weight double",
    )
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in vector_dedup.near_duplicates(rows).collect())
    assert got == [("2", 2, "2", True), ("4", 2, "2", False), ("4", 2, "2", False), ("9", 0, "9", True), ("9", 0, "9", True), ("None", 0, "None", False)]
