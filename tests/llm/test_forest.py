"""The random-projection forest: it splits, it finds the planted links, and it compares a small share of the pairs."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from placemetrics.llm import embedding_dedup


def vectors(n, dims, clusters, dense, planted=500, seed=1):
    """Unit vectors with a dense group first, and planted pairs just above the threshold among the others."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    if clusters:
        x = rng.normal(size=(clusters, dims))[rng.integers(clusters, size=n)] + 0.5 * x
    if dense:
        g = rng.normal(size=dims)
        x[:dense] = g / np.linalg.norm(g) + rng.normal(size=(dense, dims)) * 0.135 / np.sqrt(dims)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i = dense + rng.permutation(n - dense)[: 2 * planted]
    a, b = i[:planted], i[planted:]
    o = rng.normal(size=(planted, dims))
    o -= (o * x[a]).sum(1, keepdims=True) * x[a]
    x[b] = 0.981 * x[a] + np.sqrt(1 - 0.981**2) * o / np.linalg.norm(o, axis=1, keepdims=True)
    if dense:
        k = rng.integers(dense, size=(4000, 2))
        k = k[(k[:, 0] != k[:, 1]) & ((x[k[:, 0]] * x[k[:, 1]]).sum(1) >= 0.98)]
        a, b = np.concatenate((a, k[:, 0])), np.concatenate((b, k[:, 1]))
    return x, a, b


@pytest.mark.parametrize(("n", "dims", "clusters", "dense"), [(12000, 64, 0, 0), (12000, 768, 0, 0), (12000, 64, 0, 5000), (8000, 768, 20, 5000), (60000, 64, 300, 50000)])
def test_recall_of_the_forest(n, dims, clusters, dense):
    x, a, b = vectors(n, dims, clusters, dense)
    sample = np.random.default_rng(2).permutation(n)[: embedding_dedup.SAMPLE]
    trees = embedding_dedup.forest(x[sample], np.zeros(len(sample), dtype=int), n, 0.98)
    met = np.zeros(len(a), dtype=bool)
    for t in trees:
        assert len(t.cuts) > 0
        leaves = [set(found) for found in t.leaves(x)]
        met |= np.array([not leaves[i].isdisjoint(leaves[j]) for i, j in zip(a, b, strict=True)])
    assert met.mean() >= 0.99


def test_a_tenth_of_the_pairs_of_clustered_vectors_at_most():
    n = 100_000
    x, _, _ = vectors(n, 64, 300, 0)
    sample = np.random.default_rng(2).permutation(n)[: embedding_dedup.SAMPLE]
    pairs = 0
    for t in embedding_dedup.forest(x[sample], np.zeros(len(sample), dtype=int), n, 0.98):
        held = Counter(leaf for found in t.leaves(x) for leaf in found)
        pairs += sum(k * k for k in held.values())
    assert pairs < 0.1 * n * n


def test_links_over_several_trees_are_counted_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF", 60)
    x, _, _ = vectors(1500, 32, 0, 0, planted=300, seed=3)
    df = spark.createDataFrame([(i, v.tolist(), "one" if i % 3 else "two") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r.n_links for r in embedding_dedup.link(df).collect()}
    two = np.arange(len(x)) % 3 == 0
    want = ((x @ x.T >= 0.98) & (two[:, None] == two)).sum(axis=1) - 1
    assert all(got[i] <= want[i] for i in range(len(x)))
    assert want.sum() > 200 and sum(got.values()) >= 0.99 * want.sum()
