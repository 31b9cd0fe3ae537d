"""The Jaccard join's index: linked sets meet, unrelated ones that share common grams don't."""

import numpy as np
import pytest

from sluice.llm import components, jaccard_join


@pytest.mark.parametrize(("n", "t", "per_cent"), [(4, 0.85, 85), (5, 0.8, 80)])
def test_unrelated_texts_of_few_words_are_not_indexed_together(spark, monkeypatch, n, t, per_cent):
    """Every gram of these texts is in several others, as in a large corpus; only the planted copies are near."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 10 if n == 4 else 7, 160)) for _ in range(500)]
    for i in range(0, 60, 3):  # a word near the end replaced, and a chain of two
        texts[i + 1] = texts[i].rsplit(" ", 2)[0] + " x y"
        texts[i + 2] = "z " + texts[i + 1].split(" ", 1)[1]
    staged = {}

    def counted(df, name, stage=jaccard_join.stage):
        out = stage(df, name)
        staged[name] = staged.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stage", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, n, t).collect()}
    sets = [jaccard_join.grams(x, n) for x in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= per_cent * (len(sets[i]) + len(sets[j]) - common) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert got == dict(enumerate(root)) and len(set(root)) == 460
    assert staged["involved"] < 120 and staged["pairs"] + staged["rest"] < 300, staged


@pytest.mark.parametrize("t", [0.8, 0.85, 0.5])
def test_linked_sets_share_a_key(t):
    """Pairs just at the threshold, of equal sizes, of the most different ones and across size classes."""
    rng = np.random.default_rng(4)
    per_cent = round(100 * t)
    weights = rng.integers(0, 256, jaccard_join.CLASSES)
    for trial in range(1500):
        n = int(rng.integers(3, 40)) if trial % 3 else int(rng.integers(40, 1200))
        m = int(rng.integers(n, 100 * n // per_cent + 1)) if trial % 2 else n
        common = -(-per_cent * (n + m) // (100 + per_cent))  # the fewest
        if common > n or common == n == m:
            continue
        g = np.unique(rng.integers(0, 1 << 63, 2 * m + 8).astype(np.uint64))
        g = rng.permutation(g)[: n + m - common]
        a, b = np.sort(g[:n]), np.sort(g[n - common:])
        assert len(b) == m and 100 * common >= per_cent * (n + m - common)
        assert len(np.intersect1d(jaccard_join.index_keys(a, weights, t), jaccard_join.index_keys(b, weights, t))), (n, m)


def test_parts_of_frequent_grams_come_last():
    """Texts of 150 grams of their own and a line of 20 that all have: few are indexed under the line's grams alone."""
    rng = np.random.default_rng(6)
    line = rng.integers(0, 1 << 63, 20).astype(np.uint64)
    sets = [np.unique(np.concatenate([line, rng.integers(0, 1 << 63, 150).astype(np.uint64)])) for _ in range(400)]
    counts = np.zeros(jaccard_join.CLASSES, np.int64)
    for g in sets:
        np.add.at(counts, (g >> np.uint64(48)).astype(np.int64), 1)
    weights = jaccard_join.gram_weights(counts)
    keys, sizes = np.unique(np.concatenate([jaccard_join.index_keys(g, weights, 0.85) for g in sets]), return_counts=True)
    assert sizes.max() <= 4, np.sort(sizes)[-5:]


def test_components_by_the_driver_and_by_jobs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    ids = rng.permutation(1 << 40 | np.arange(300)) * rng.choice([-1, 1], 300)
    chain = [(int(a), int(b)) for a, b in zip(ids[:60], ids[1:61])]
    rest = [(int(a), int(b)) for a, b in rng.choice(ids[61:], (120, 2))]
    edges = spark.createDataFrame([*chain, *rest, (7, 7), chain[0]], "a long, b long")
    found = {}
    for few in (0, 1 << 18):
        monkeypatch.setattr(components, "FEW", few)
        found[few] = sorted(map(tuple, components.components(edges).collect()))
    assert found[0] == found[1 << 18] and (int(ids[:61].max()), int(ids[:61].min())) in found[0]
    monkeypatch.setattr(components, "FEW", 1 << 18)
    assert components.components(edges.limit(0)).columns == ["node", "root"]
    assert components.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1 << 15, 1 << 26])
def test_few_other_texts_pass_the_bitmap(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "MOST_MARKS", most)
    rng = np.random.default_rng(10)
    h = np.unique(rng.integers(-1 << 63, (1 << 63) - 1, 6000))
    rows = spark.createDataFrame([(i, f"t{i}", int(x)) for i, x in enumerate(h)], "doc_id long, text string, h long")
    involved = rows.filter("doc_id % 2 = 0").select(jaccard_join.F.col("h").alias("text_hash"))
    got = {r.doc_id for r in jaccard_join._marked(rows, involved).collect()}
    assert {i for i in range(len(h)) if i % 2 == 0} <= got and len(got) < 3000 + (400 if most > 1 << 15 else 600)
