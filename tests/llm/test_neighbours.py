"""Collision counting against brute force: uneven norms, outliers, ties, repeated ids, odd vectors."""

from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>"


def recall(x, queries, k=20):
    rows = np.arange(len(x))
    hit = 0
    for q, (got, score) in zip(queries, neighbours.search(rows, rows, x, queries, x[queries], k), strict=True):
        s = x @ x[q]
        assert np.allclose(score, s[got], rtol=1e-12) and q not in got and (np.diff(score) <= 0).all()
        s[q] = -np.inf
        hit += len(set(got.tolist()) & set(np.argsort(-s)[:k].tolist()))
    return hit / k / len(queries)


@pytest.mark.parametrize("kind", ["even", "lognormal", "outlier", "clusters", "huge"])
def test_recall(kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lognormal":
        x *= rng.lognormal(0, 0.5, (4000, 1))
    elif kind == "outlier":
        x[7] *= 3
    elif kind == "clusters":
        x = x[rng.integers(0, 40, 4000)] + 0.05 * rng.standard_normal((4000, 64))
    elif kind == "huge":
        x *= 1e120
    assert recall(x, np.arange(0, 4000, 40)) >= 0.9


def test_ties_repeats_and_odd_vectors(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, -1.0]),
            (40, None), (60, []), (80, [0.0, 0.0]), (100, [float("inf"), 1.0]), (None, [9.0, 9.0]), (120, [1.0])]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    first = [(1, 1, 2.0), (2, 2, 2.0), (3, 2, 2.0), (4, 3, 0.0), (5, 20, 0.0)]
    second = [(1, 1, 0.0), (2, 2, 0.0), (3, 2, 0.0), (4, 20, 0.0), (5, 3, -1.0)]
    assert set(got) == {20} and sorted(got[20]) == sorted(first + second)
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_verified_rows_grow_slower_than_the_table(monkeypatch):
    """Four times the rows: a query verifies twice as many (before: four times), at the same recall."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((16000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    plain, seen = np.einsum, []
    monkeypatch.setattr(neighbours.np, "einsum", lambda how, a, *rest: seen.append(len(a)) or plain(how, a, *rest))
    verified = []
    for n in (4000, 16000):
        seen.clear()
        assert recall(x[:n], np.arange(0, n, n // 50)) >= 0.98
        verified.append(sum(seen) / 50)
    assert verified[1] < 2.6 * verified[0]


@pytest.mark.parametrize("kind", ["common mean", "anisotropic", "anisotropic unit"])
def test_recall_of_uneven_directions(kind):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((6000, 64))
    if kind == "common mean":
        x += 1.5
    else:
        x *= np.arange(1, 65) ** -0.7
    if kind != "anisotropic":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert recall(x, np.arange(0, 6000, 60)) >= 0.9


def test_many_copies_give_the_smallest_ids():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 16))
    x[2000:5500] = x[1] * 1.5
    ids = rng.permutation(6000)
    rows = np.arange(6000)
    own = [1, 2000, int(2000 + np.argmin(ids[2000:5500])), 5999]
    for q, (got, score) in zip(own, neighbours.search(rows, ids, x, np.array(own), x[own], 20, total=24000), strict=True):
        s = np.einsum("ij,j->i", x, x[q])
        s[q] = -np.inf
        if q < 5500:
            best = np.lexsort((ids, -s))[:20]
            assert got.tolist() == ids[best].tolist() and score.tolist() == s[best].tolist()
        assert len(got) == 20 and ids[q] not in got
